"""Which contacts of a user matter most for a phrase: one request, or a table of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from postlens.functions.arguments import contact_arguments, whole_number_column
from postlens.functions.scoring import contact_score
from postlens.functions.text import phrase_count
from postlens.operators.contacts import contacts_of
from postlens.operators.skew import greatest, heavy_keys, salted_join, top_per_group, top_rows
from postlens.operators.texts import TEXT_ID, with_texts
from postlens.sources.schema import CONTACT_RANKING
from postlens.sources.staging import stage


def _best_first() -> list[Column]:
    return [F.desc("score"), F.asc("user2_id")]


def _hits_per_contact(facts: DataFrame, hits: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """``[*by, user2_id, phrase_hits, score]``: numbers only, so no text is shuffled."""
    counted = facts.select(*by, "user2_id", "intimacy_score", hits.alias("hits"))
    per_contact = counted.groupBy(*by, "user2_id").agg(
        F.max("intimacy_score").alias("intimacy_score"), F.sum("hits").alias("phrase_hits")
    )
    score = contact_score(F.col("intimacy_score"), F.col("phrase_hits")).alias("score")
    return per_contact.select(*by, "user2_id", "phrase_hits", score)


def _with_shown_text(
    ranked: DataFrame, facts: DataFrame, phrase: str | Column, by: tuple[str, ...] = (), counted: DataFrame | None = None
) -> DataFrame:
    """Add screen_name, description and text to ranked contacts, from their facts alone.

    The text has the most hits; then the latest counts, then the greatest text. Each task
    keeps one row per contact before the shuffle. ``counted`` holds the hits where texts are numbers.
    """
    best_first = Window.partitionBy(*by, "user2_id").orderBy(
        F.desc("hits"), F.desc("created_at"), F.desc("text"), F.desc("screen_name"), F.desc("description")
    )
    keys = [c for c in by if c in facts.columns]
    shown = facts.select(
        *keys, "user2_id", "created_at", "text",
        F.coalesce("user2_screen_name", F.lit("")).alias("screen_name"),
        F.coalesce("user2_desc", F.lit("")).alias("description"),
    ).join(ranked, [*keys, "user2_id"])
    return (
        _with_hits(shown, phrase, counted)
        .withColumn("best", F.row_number().over(best_first))
        .where("best = 1")
        .drop("hits", "created_at", "best")
    )


def _with_hits(rows: DataFrame, phrase: str | Column, counted: DataFrame | None) -> DataFrame:
    """Add ``hits``: from the texts themselves, or from ``counted`` where rows hold the numbers of texts."""
    if counted is None:
        return rows.withColumn("hits", phrase_count(F.col("text"), phrase))
    return rows.join(counted, ["text", "phrase"], "left").withColumn("hits", F.coalesce("hits", F.lit(0)))


def _hits_of_texts(pairs: DataFrame, texts: DataFrame, staging_folder: str | None) -> DataFrame:
    """``[text, phrase, hits]`` of the numbered texts that hold a phrase asked of them: each pair is counted once."""
    asked = pairs.select("text", "phrase").distinct()
    listed = texts.select(F.col(TEXT_ID).alias("text"), F.col("text").alias("text_"))
    hits = phrase_count(F.col("text_"), F.col("phrase")).alias("hits")
    return stage(asked.join(listed, "text").select("text", "phrase", hits).where("hits > 0"), "hits", staging_folder)


def contact_rank(facts: DataFrame, user_id: object, phrase: object, n: object) -> DataFrame:
    """The first n contacts of a user by score, then by id."""
    arguments = contact_arguments(user_id, phrase, n)
    if arguments is None:
        return facts.sparkSession.createDataFrame([], CONTACT_RANKING)
    user, literal, count = arguments
    own = contacts_of(facts, user)
    ranked = top_rows(_hits_per_contact(own, phrase_count(F.col("text"), literal)), _best_first(), count)
    return _with_shown_text(ranked, own, literal).select(
        "rank", "user2_id", "screen_name", "description", "text", "phrase_hits", "score"
    )


def valid_contact_requests(requests: DataFrame) -> DataFrame:
    """``[request_id, user_id, phrase, n]`` without the requests whose answer is empty."""
    return requests.select(
        "request_id",
        whole_number_column(F.col("user_id"), "bigint").alias("user_id"),
        F.col("phrase").cast("string").alias("phrase"),
        whole_number_column(F.col("n"), "int").alias("n"),
    ).where("user_id is not null and phrase <> '' and n > 0")


def contact_requests(
    requests: DataFrame, facts: DataFrame, heavy: DataFrame | None = None, cut_heavy: bool = True,
    texts: DataFrame | None = None, staging_folder: str | None = None,
) -> DataFrame:
    """Ranked contacts for every request of a table.

    Requests for the same user and phrase share one computation with the largest n. The
    user with very many texts is cut into slices for the join, and contacts are reduced to
    their counts before any ranking. ``heavy`` names such users, ``[user_id, slices]``; they
    are counted from the facts where it is not given. ``cut_heavy=False`` joins by user alone,
    for facts without such users that lie in buckets of ``user1_id``.

    With ``texts`` the facts hold the numbers of texts (``number_texts``): a phrase is counted once in
    every text asked for it, and only the shown texts are fetched.
    """
    valid = valid_contact_requests(requests)
    asked = valid.groupBy("user_id", "phrase").agg(F.max("n").alias("n_max"))
    by_user = facts.withColumnRenamed("user1_id", "user_id")
    if heavy is None and cut_heavy:
        counts = by_user.groupBy("user_id").agg(F.count("*").alias("n"))
        heavy = heavy_keys(counts, ["user_id"], "n")
    pairs = salted_join(by_user, asked, ["user_id"], heavy, ["user2_id", "text"])
    by = ("user_id", "phrase", "n_max")
    counted = None if texts is None else _hits_of_texts(pairs, texts, staging_folder)
    per_contact = _hits_per_contact(_with_hits(pairs, F.col("phrase"), counted), F.col("hits"), by)
    ranked = top_per_group(
        per_contact, ["user_id", "phrase"], _best_first(), F.col("n_max"), ["user2_id"], most=greatest(valid, "n")
    )
    shown = _with_shown_text(ranked.drop("n_max"), by_user, F.col("phrase"), ("user_id", "phrase"), counted)
    answers = valid.join(shown, ["user_id", "phrase"]).where("rank <= n").select(
        "request_id", "rank", "user2_id", "screen_name", "description", "text", "phrase_hits", "score"
    )
    return answers if texts is None else with_texts(answers, texts)
