"""Contact tables that take new posts in, instead of being made again from all posts.

Pair weights add up, contact texts and profiles keep the latest. A post that comes again counts
once, as in one run over everything: the copy that comes first in the order of ``dedupe_posts``. Where a new
copy takes the place of one counted before, its share is taken back: subtracted from the weight;
what kept the latest of something is looked up anew, for the keys concerned alone.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from postlens.operators.clean import dedupe_posts
from postlens.operators.contacts import PAIR, dedupe_contacts, latest_seen, pair_weight, profiles_seen

TEXT = ["user1_id", "user2_id", "text"]


class ContactState(NamedTuple):
    """``contacts``: one row per post; ``weights``: per pair; ``texts``: per pair and text, with the
    latest time; ``profiles``: per user, with the time it was seen.
    """

    contacts: DataFrame
    weights: DataFrame
    texts: DataFrame
    profiles: DataFrame


def contact_state(contacts: DataFrame) -> ContactState:
    """The state after one run over cleaned contact posts, copies included."""
    own = dedupe_posts(contacts)
    return ContactState(own, pair_weight(own), dedupe_contacts(own), latest_seen(profiles_seen(own)))


def changed_posts(state: ContactState, fresh: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(contacts, added, removed)``: the contacts with the fresh ones taken in, the rows that are new
    among them, and the rows that these replace. Only posts that come again are compared.
    """
    columns = state.contacts.columns
    new = dedupe_posts(fresh.select(*columns))
    known = state.contacts.join(new.select("post_id"), "post_id", "left_semi")
    chosen = dedupe_posts(known.unionByName(new))
    sides = chosen.select("post_id", F.struct(*columns).alias("now")).join(
        known.select("post_id", F.struct(*columns).alias("before")), "post_id", "left"
    ).where(~F.col("now").eqNullSafe(F.col("before")))
    contacts = state.contacts.join(new.select("post_id"), "post_id", "left_anti").unionByName(chosen)
    return contacts, sides.select("now.*"), sides.where("before is not null").select("before.*")


def merge_contacts(state: ContactState, fresh: DataFrame) -> ContactState:
    """The state after more cleaned contact posts: the same as after one run over all of them."""
    contacts, added, removed = changed_posts(state, fresh)
    taken_back = pair_weight(removed).withColumn("weight", -F.col("weight"))
    weights = (
        state.weights.unionByName(pair_weight(added)).unionByName(taken_back)
        .groupBy(*PAIR).agg(F.sum("weight").alias("weight")).where("weight > 0")
    )
    texts = _latest_unless(
        dedupe_contacts(state.texts.unionByName(dedupe_contacts(added))),
        removed.select(*TEXT).distinct(), TEXT, lambda keys: dedupe_contacts(contacts.join(keys, TEXT, "left_semi")),
    )
    users = profiles_seen(removed).select("id").distinct()
    profiles = _latest_unless(
        latest_seen(state.profiles.unionByName(profiles_seen(added).select(*state.profiles.columns))),
        users, ["id"], lambda keys: latest_seen(profiles_seen(contacts).join(keys, "id", "left_semi")),
    )
    return ContactState(contacts, weights, texts, profiles)


def _latest_unless(latest: DataFrame, replaced: DataFrame, key: list[str], again) -> DataFrame:
    """``latest`` but for the keys of replaced rows, which are made again."""
    return latest.join(replaced, key, "left_anti").unionByName(again(replaced))
