"""The nested form of the contact table, as structs or as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KEYS = ("user1_id", "month", "chunk")
# The counterparts of a user are dealt out by hash into this many rows a month.
CHUNKS = 64

# The columns of the stored format.
IDS = "array<bigint>"
NAMES = "array<string>"
SCORES = "array<double>"
TEXTS = "array<array<string>>"
TIMES = "array<array<bigint>>"
JSON_COLUMNS = {
    "user2_ids": IDS,
    "texts": TEXTS,
    "created_ats": TIMES,
    "intimacy_scores": SCORES,
    "user2_descs": NAMES,
    "user2_screen_names": NAMES,
}


def nest_contacts(facts: DataFrame, chunks: int = CHUNKS) -> DataFrame:
    """``[user1_id, month, chunk, contacts]``: the counterparts of a user with their texts, nested.

    A row holds the counterparts of one chunk and what was said in one calendar month (UTC). Which chunk
    a counterpart is in follows from its id alone, the same for every user and without a look at
    sizes beforehand. Counterparts stand in the order of their ids, texts in that of time.
    """
    month = F.date_format(F.timestamp_seconds("created_at"), "yyyy-MM").alias("month")
    chunk = F.pmod(F.xxhash64("user2_id"), F.lit(chunks)).cast("int").alias("chunk")
    counterpart = ["user2_id", "user2_screen_name", "user2_desc", "intimacy_score"]
    posts = F.sort_array(F.collect_list(F.struct("created_at", "text"))).alias("posts")
    # Dealt out once, by the key of the rows to be made: both groupings find their rows together.
    dealt = facts.select("*", month, chunk).repartition(*KEYS)
    by_contact = dealt.groupBy(*KEYS, *counterpart).agg(posts)
    contact = F.struct(*counterpart, "posts")
    return by_contact.groupBy(*KEYS).agg(F.sort_array(F.collect_list(contact)).alias("contacts"))


def contact_list(nested: DataFrame, user_id: int) -> DataFrame:
    """``[user1_id, contacts]``: all contacts of one user in one row, put together from the chunks."""
    own = nested.where(F.col("user1_id") == user_id).select("user1_id", F.inline("contacts"))
    counterpart = ["user2_id", "user2_screen_name", "user2_desc", "intimacy_score"]
    posts = F.sort_array(F.flatten(F.collect_list("posts"))).alias("posts")
    whole = own.groupBy("user1_id", *counterpart).agg(posts)
    return whole.groupBy("user1_id").agg(F.sort_array(F.collect_list(F.struct(*counterpart, "posts"))).alias("contacts"))


def contacts_to_json(nested: DataFrame) -> DataFrame:
    """Six parallel JSON arrays per row, for stores without nested types."""
    names = F.transform("contacts.user2_screen_name", lambda n: F.coalesce(n, F.lit("")))
    descs = F.transform("contacts.user2_desc", lambda d: F.coalesce(d, F.lit("")))
    columns = {
        "user2_ids": F.col("contacts.user2_id"),
        "texts": F.transform("contacts.posts", lambda p: p["text"]),
        "created_ats": F.transform("contacts.posts", lambda p: p["created_at"]),
        "intimacy_scores": F.col("contacts.intimacy_score"),
        "user2_descs": descs,
        "user2_screen_names": names,
    }
    return nested.select(
        *KEYS, *[F.to_json(c).alias(name) for name, c in columns.items()]
    )


def contacts_from_json(encoded: DataFrame) -> DataFrame:
    """The arrays read back from their JSON text."""
    return encoded.select(
        *KEYS,
        *[F.from_json(c, schema).alias(c) for c, schema in JSON_COLUMNS.items()],
    )


def flatten_json_contacts(decoded: DataFrame) -> DataFrame:
    """One row per text again: the inverse of nesting."""
    contact = F.arrays_zip(
        "user2_ids", "texts", "created_ats", "intimacy_scores", "user2_descs", "user2_screen_names"
    )
    per_contact = decoded.select("user1_id", F.inline_outer(contact)).where("user2_ids is not null")
    return per_contact.select(
        "user1_id",
        F.col("user2_ids").alias("user2_id"),
        F.col("user2_screen_names").alias("user2_screen_name"),
        F.col("user2_descs").alias("user2_desc"),
        F.col("intimacy_scores").alias("intimacy_score"),
        F.inline_outer(
            F.arrays_zip(F.col("texts").alias("text"), F.col("created_ats").alias("created_at"))
        ),
    ).where("text is not null")
