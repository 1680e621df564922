"""Contacts between users: pair scores, profiles, the contact fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from postlens.functions.scoring import contact_weight, intimacy
from postlens.operators.skew import heavy_keys, salted_join

PAIR = ["user_lo", "user_hi"]


def _with_pair(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"user_lo": F.least("user1_id", "user2_id"), "user_hi": F.greatest("user1_id", "user2_id")}
    )


def _two_rows(df: DataFrame, names: list[str], first: list, second: list) -> DataFrame:
    """Two rows named ``names`` from every row, in one scan."""

    def row(values: list) -> Column:
        columns = [F.col(v) if isinstance(v, str) else v for v in values]
        return F.struct(*[c.alias(n) for n, c in zip(names, columns)])

    return df.select(F.inline(F.array(row(first), row(second))))


def pair_weight(contacts: DataFrame) -> DataFrame:
    """``[user_lo, user_hi, weight]``: weighted contacts of every unordered pair."""
    return (
        _with_pair(contacts)
        .groupBy(*PAIR)
        .agg(F.sum(contact_weight(F.col("kind"))).alias("weight"))
    )


def pair_scores(weights: DataFrame) -> DataFrame:
    """``[user1_id, user2_id, intimacy_score]`` in both directions."""
    score = intimacy(F.col("weight"))
    return _two_rows(
        weights,
        ["user1_id", "user2_id", "intimacy_score"],
        ["user_lo", "user_hi", score],
        ["user_hi", "user_lo", score],
    )


def dedupe_contacts(contacts: DataFrame) -> DataFrame:
    """One row per ``(user1_id, user2_id, text)`` with the latest time."""
    return contacts.groupBy("user1_id", "user2_id", "text").agg(
        F.max("created_at").alias("created_at")
    )


def score_contacts(contacts: DataFrame, cut_heavy: bool = True) -> DataFrame:
    """``[user1_id, user2_id, text, created_at, intimacy_score]``.

    The weight of a pair counts every post, the texts are listed once. Weights serve as
    row counts to find the heavy pairs: a contact adds 1 or 2. ``cut_heavy=False`` spares
    that where few contacts come in, such as those of one user.
    """
    return score_texts(dedupe_contacts(contacts), pair_weight(contacts), cut_heavy)


def score_texts(texts: DataFrame, weights: DataFrame, cut_heavy: bool = True) -> DataFrame:
    """Contact texts with the score of their pair."""
    scores = weights.select(*PAIR, intimacy(F.col("weight")).alias("intimacy_score"))
    heavy = heavy_keys(weights, PAIR, "weight") if cut_heavy else None
    return salted_join(_with_pair(texts), scores, PAIR, heavy, spread_by=["text"]).select(
        "user1_id", "user2_id", "text", "created_at", "intimacy_score"
    )


def profiles_seen(contacts: DataFrame) -> DataFrame:
    """Every profile shown by a contact post, stamped with the time of the post.

    The author and the re-shared author come from one scan; a reply target shows none.
    """
    seen = _two_rows(
        contacts,
        ["id", "screen_name", "description", "created_at"],
        ["user1_id", "screen_name", "description", "created_at"],
        ["reshared_user_id", "reshared_screen_name", "reshared_description", "created_at"],
    )
    return seen.where(
        "id is not null and ((screen_name is not null and screen_name <> '') "
        "or (description is not null and description <> ''))"
    )


def latest_profile(seen: DataFrame) -> DataFrame:
    """``[id, screen_name, description]``: the latest profile of every user."""
    return latest_seen(seen).drop("created_at")


def latest_seen(seen: DataFrame) -> DataFrame:
    """``[id, screen_name, description, created_at]``: the latest profile with the time it was seen.

    Asking for row number 1 lets every task keep one row per user before the shuffle.
    """
    latest_first = Window.partitionBy("id").orderBy(
        F.desc("created_at"), F.desc_nulls_last("screen_name"), F.desc_nulls_last("description")
    )
    return (
        seen.withColumn("rn", F.row_number().over(latest_first))
        .where("rn = 1")
        .select("id", "screen_name", "description", "created_at")
    )


def mirror_contacts(scored: DataFrame) -> DataFrame:
    """Every contact under both of its users, from one scan."""
    rest = [c for c in scored.columns if c not in ("user1_id", "user2_id")]
    names = ["user1_id", "user2_id", *rest]
    return _two_rows(scored, names, names, ["user2_id", "user1_id", *rest])


def heavy_users(weights: DataFrame, key: str) -> DataFrame:
    """The users with the most contacts, from the pair weights, for a join on ``key``."""
    per_user = _two_rows(weights, [key, "rows"], ["user_lo", "weight"], ["user_hi", "weight"])
    return heavy_keys(per_user.groupBy(key).agg(F.sum("rows").alias("rows")), [key], "rows")


def attach_profiles(
    mirrored: DataFrame, profiles: DataFrame, heavy: DataFrame | None = None
) -> DataFrame:
    """Add name and description of the counterpart; both stay null where unknown.

    ``heavy`` names the counterparts to cut into slices, ``[user2_id, slices]``.
    """
    known = profiles.select(
        F.col("id").alias("user2_id"),
        F.col("screen_name").alias("user2_screen_name"),
        F.col("description").alias("user2_desc"),
    )
    return salted_join(mirrored, known, ["user2_id"], heavy, ["user1_id", "text"], "left").select(
        *mirrored.columns, "user2_screen_name", "user2_desc"
    )


def contact_fact(
    scored: DataFrame, profiles: DataFrame, heavy: DataFrame | None = None
) -> DataFrame:
    """The serving table, flat: one row per user, counterpart and text."""
    return attach_profiles(mirror_contacts(scored), profiles, heavy)


def of_user(contacts: DataFrame, user_id: int) -> DataFrame:
    """The contacts a user takes part in, on either side."""
    return contacts.where((F.col("user1_id") == user_id) | (F.col("user2_id") == user_id))


def contacts_of(facts: DataFrame, user_id: int) -> DataFrame:
    """Point lookup in the serving table."""
    return facts.where(F.col("user1_id") == user_id)
