"""Views that present the supplied tables as posts, contacts and requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postlens.functions.text import lower_words
from postlens.operators import contacts as contact_ops
from postlens.operators.clean import clean_contact_posts
from postlens.operators.texts import number_texts
from postlens.operators.topics import with_impact

STOP = (
    "the of and to a in is that it for was on with be by as this are at from an re he"
).split()
CENSOR = ["rewh", "thatin", "ononst", "hehely"]
EPOCH = "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession) -> str | None:
    """Where a local session that names no shared folder may keep intermediate tables."""
    return "/tmp/postlens-shared" if spark.sparkContext.master.startswith("local[") else None


def buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _time_text() -> Column:
    return F.date_format("ts", "EEE MMM dd HH:mm:ss '+0000' yyyy")


def _event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with a document as its text: documents are used in turn."""
    docs = documents(spark, sf_dir)
    events = table(spark, sf_dir, "events").withColumn("k", _k())
    rows = table(spark, sf_dir, "documents").count()
    return events.withColumn("doc_id", F.col("event_id") % F.lit(rows)).join(docs, "doc_id")


def raw_event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a nested post.

    Clicks are replies, views are re-shares, purchases are both. Low counters leave ids,
    names, times or hashtags out, so that each cleaning rule has rows to act on.
    """
    is_reply = F.col("event_type").isin("click", "purchase")
    is_reshare = F.col("event_type").isin("view", "purchase")
    other = F.floor("value").cast("bigint")
    author = F.struct(
        F.when(F.col("k") >= 10, F.col("user_id")).alias("id"),
        F.col("user_id").cast("string").alias("id_str"),
        F.when(F.col("k") < 90, F.concat_ws("_", F.lit("user"), "user_id", "k")).alias("screen_name"),
        F.when(F.col("k") < 95, F.col("lang")).alias("description"),
        F.lit(None).cast("string").alias("created_at"),
        F.col("n_chars").alias("followers_count"),
    )
    reshared = F.struct(
        F.when(other >= 5, other).alias("id"),
        other.cast("string").alias("id_str"),
        F.concat_ws("_", F.lit("user"), other, "event_type").alias("screen_name"),
        F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("string").alias("created_at"),
    )
    hashtags = F.array(F.struct(F.col("event_type").alias("text")))
    return _event_documents(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        F.when(F.col("value") < 1, "").otherwise(_time_text()).alias("created_at"),
        "text",
        "lang",
        F.when(is_reply, F.col("k")).alias("in_reply_to_user_id"),
        F.col("k").alias("retweet_count"),
        other.alias("favorite_count"),
        F.struct(
            F.when(F.col("value") < 2, F.slice(hashtags, 1, 0)).otherwise(hashtags).alias("hashtags")
        ).alias("entities"),
        author.alias("user"),
        F.when(is_reshare, F.struct(F.col("event_id").alias("id"), reshared.alias("user"))).alias("retweeted_status"),
    )


def raw_document_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a nested post; documents labelled as low quality come twice.

    The second copy is a day later. Author and time come from the event of the same number.
    """
    events = table(spark, sf_dir, "events").withColumn("k", _k())
    low = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id").withColumn("copy", F.lit(1))
    copies = F.when(F.col("copy") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = (
        documents(spark, sf_dir)
        .join(events, F.col("doc_id") == F.col("event_id"))
        .join(low, "doc_id", "left")
        .withColumn("days", F.explode(copies))
        .withColumn("ts", F.expr("ts + make_dt_interval(days)"))
    )
    author = F.struct(
        F.when(F.col("k") >= 10, F.col("user_id")).alias("id"),
        F.when(F.col("k") >= 5, F.col("user_id").cast("string")).otherwise("unknown").alias("id_str"),
        F.concat_ws("_", F.lit("user"), "user_id").alias("screen_name"),
        F.col("source").alias("description"),
        F.lit(None).cast("string").alias("created_at"),
        F.when(F.col("value") >= 3, F.col("n_chars")).alias("followers_count"),
    )
    no_user = F.struct(
        F.lit(None).cast("bigint").alias("id"),
        F.lit(None).cast("string").alias("id_str"),
        F.lit(None).cast("string").alias("screen_name"),
        F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("string").alias("created_at"),
    )
    return rows.select(
        F.col("doc_id").alias("id"),
        F.when(F.col("value") < 1, "").when(F.col("value") < 2, "no time").otherwise(_time_text()).alias("created_at"),
        F.when(F.col("k") != 99, F.col("text")).alias("text"),
        "lang",
        F.lit(None).cast("bigint").alias("in_reply_to_user_id"),
        F.when(F.col("event_type") != "error", F.col("k")).alias("retweet_count"),
        F.floor("value").cast("bigint").alias("favorite_count"),
        F.struct(F.array(F.struct(F.col("source").alias("text"))).alias("hashtags")).alias("entities"),
        author.alias("user"),
        F.when(F.lit(False), F.struct(F.col("doc_id").alias("id"), no_user.alias("user"))).alias("retweeted_status"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a clean post, with the author and time of its event.

    Both tables grow alike, so the join is a shuffled one, whatever the size of the smaller. Texts
    are cut after it, in as many tasks as there are shuffle partitions and not files.
    """
    events = table(spark, sf_dir, "events")
    docs = documents(spark, sf_dir).hint("shuffle_hash")
    return docs.join(events, F.col("doc_id") == F.col("event_id")).select(
        F.col("doc_id").alias("post_id"),
        "user_id",
        F.expr(EPOCH).alias("created_at"),
        "text",
        "lang",
        F.col("n_chars").alias("followers_count"),
        _k().alias("reshare_count"),
        F.floor("value").cast("bigint").alias("favorite_count"),
    )


def impact_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English posts with their words and impact: the texts are cut into words once."""
    english = posts(spark, sf_dir).where("lang = 'en'").withColumn("words", lower_words(F.col("text")))
    return with_impact(english, STOP, "words").select(
        "post_id", "user_id", "created_at", "text", "words", "impact"
    )


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned contact posts; event ids are unique, so there are no copies to merge."""
    return clean_contact_posts(raw_event_posts(spark, sf_dir))


def numbered_contacts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The contacts with numbers for their texts, and the texts."""
    return number_texts(contacts(spark, sf_dir), work_folder(spark))


def profiles(of_contacts: DataFrame) -> DataFrame:
    return contact_ops.latest_profile(contact_ops.profiles_seen(of_contacts))


def heavy_users(of_contacts: DataFrame, key: str) -> DataFrame:
    return contact_ops.heavy_users(contact_ops.pair_weight(of_contacts), key)


def contact_fact(of_contacts: DataFrame) -> DataFrame:
    scored = contact_ops.score_contacts(of_contacts)
    return contact_ops.contact_fact(scored, profiles(of_contacts))


def contact_fact_of_user(of_contacts: DataFrame, user_id: int) -> DataFrame:
    """The fact table made from the contacts of one user only: the filter goes down to the
    scan, and the weights of the user's pairs need no other contacts."""
    own = contact_ops.of_user(of_contacts, user_id)
    scored = contact_ops.score_contacts(own, cut_heavy=False)
    return contact_ops.contact_fact(scored, profiles(of_contacts))


def contact_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per customer, with arguments as text, some of them unusable."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("request_id"),
        F.when(F.col("c_nationkey") == 24, "nobody")
        .otherwise((F.col("c_custkey")).cast("string"))
        .alias("user_id"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "of the")
        .when(F.col("c_mktsegment") == "BUILDING", "en")
        .otherwise("the")
        .alias("phrase"),
        F.floor(F.col("c_acctbal") / 1000).cast("string").alias("n"),
    )


def topic_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per supplier: ranges of different widths, some of them reversed."""
    key, balance = F.col("s_suppkey"), F.col("s_acctbal")
    start = F.lit(1704067200) + F.col("s_nationkey") * 3600
    return table(spark, sf_dir, "supplier").select(
        key.alias("request_id"),
        key.alias("uid_lo"),
        F.when(balance < 0, key - 1).otherwise(key + F.col("s_nationkey")).alias("uid_hi"),
        start.cast("bigint").alias("t_lo"),
        F.when(balance > 9000, F.lit(2**62))
        .otherwise((start + F.floor(balance) * 100).cast("bigint"))
        .alias("t_hi"),
        (F.lit(5) + F.col("s_nationkey")).cast("string").alias("n1"),
        F.col("s_nationkey").cast("string").alias("n2"),
    )


def wide_topic_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per nation over most users and times; later nations leave more out at both ends."""
    key = F.col("n_nationkey").cast("bigint")
    return table(spark, sf_dir, "nation").select(
        key.alias("request_id"),
        (key * 3).alias("uid_lo"),
        F.lit(2**62).alias("uid_hi"),
        (F.lit(1704067200) + key * 7000).alias("t_lo"),
        (F.lit(1704067200) + (30 - key) * 90001).alias("t_hi"),
        (F.lit(3) + key).cast("string").alias("n1"),
        F.lit("4").alias("n2"),
    )
