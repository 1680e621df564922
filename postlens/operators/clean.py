"""Cleaning of raw posts: required fields, languages, contacts, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from postlens.functions.posts import (
    CONTACT_LANGS,
    TOPIC_LANGS,
    has_hashtag,
    parse_post_time,
    resolve_id,
)


def flatten_posts(raw: DataFrame) -> DataFrame:
    """Nested posts as flat rows, ids filled in from their text form."""
    return raw.select(
        F.col("id").alias("post_id"),
        resolve_id(F.col("user.id"), F.col("user.id_str")).alias("user_id"),
        "created_at",
        "text",
        "lang",
        F.col("user.followers_count").alias("followers_count"),
        F.col("retweet_count").alias("reshare_count"),
        "favorite_count",
        F.col("user.screen_name").alias("screen_name"),
        F.col("user.description").alias("description"),
        F.col("in_reply_to_user_id").alias("reply_user_id"),
        F.col("retweeted_status.id").alias("reshared_post_id"),
        resolve_id(
            F.col("retweeted_status.user.id"), F.col("retweeted_status.user.id_str")
        ).alias("reshared_user_id"),
        F.col("retweeted_status.user.screen_name").alias("reshared_screen_name"),
        F.col("retweeted_status.user.description").alias("reshared_description"),
        has_hashtag(F.col("entities")).alias("has_hashtag"),
    )


def require_fields(posts: DataFrame) -> DataFrame:
    """Keep posts that have an id, an author, a text and a time."""
    return posts.where(
        "post_id is not null and user_id is not null and text <> '' and created_at <> ''"
    )


def default_counters(posts: DataFrame) -> DataFrame:
    counters = ["followers_count", "reshare_count", "favorite_count"]
    return posts.fillna(0, counters)


def lang_in(posts: DataFrame, langs: Sequence[str]) -> DataFrame:
    return posts.where(F.col("lang").isin(*langs))


def parse_times(posts: DataFrame) -> DataFrame:
    """Time text to epoch seconds; posts whose time does not parse are dropped."""
    return posts.withColumn("created_at", parse_post_time(F.col("created_at"))).where(
        "created_at is not null"
    )


def dedupe_posts(posts: DataFrame) -> DataFrame:
    """One row per post id: the lowest by time, then text, then the other columns.

    An aggregate, so copies of a post are merged before they are shuffled.
    """
    rest = [c for c in posts.columns if c not in ("post_id", "created_at", "text")]
    first = F.min(F.struct("created_at", "text", *rest)).alias("first")
    return posts.groupBy("post_id").agg(first).select(
        "post_id", *[F.col(f"first.{c}").alias(c) for c in posts.columns if c != "post_id"]
    )


def classify_contact(posts: DataFrame) -> DataFrame:
    """Keep replies and re-shares as ``user1 -> user2``; a post that is both is a reply."""
    is_reply = F.col("reply_user_id").isNotNull()
    return (
        posts.where("reply_user_id is not null or reshared_post_id is not null")
        .withColumn("kind", F.when(is_reply, "reply").otherwise("reshare"))
        .withColumn("user2_id", F.coalesce("reply_user_id", "reshared_user_id"))
        .withColumnRenamed("user_id", "user1_id")
        .where("user2_id is not null")
    )


def drop_self_contacts(contacts: DataFrame) -> DataFrame:
    return contacts.where("user1_id <> user2_id")


def clean_contact_posts(raw: DataFrame) -> DataFrame:
    """Valid contact posts, before duplicates are merged.

    ``post_id, user1_id, user2_id, kind, text, created_at`` and the two profiles seen.
    """
    posts = lang_in(require_fields(flatten_posts(raw)), CONTACT_LANGS).where("has_hashtag")
    # Times are parsed last: it is the dearest test, and most posts are no contacts.
    contacts = parse_times(drop_self_contacts(classify_contact(posts)))
    return contacts.select(
        "post_id",
        "user1_id",
        "user2_id",
        "kind",
        "text",
        "created_at",
        "screen_name",
        "description",
        "reshared_user_id",
        "reshared_screen_name",
        "reshared_description",
    )


def clean_topic_posts(raw: DataFrame) -> DataFrame:
    """Valid posts for the topic tables, before duplicates are merged."""
    posts = parse_times(lang_in(require_fields(flatten_posts(raw)), TOPIC_LANGS))
    return default_counters(posts).select(
        "post_id",
        "user_id",
        "created_at",
        "text",
        "followers_count",
        "reshare_count",
        "favorite_count",
    )
