"""Posts that many requests ask for, each with the list of its requests.

A post travels once with its list instead of once for each request. Requests of bounded size over users near
each other share a home: the posts of a home meet in one task, which adds up whole requests, so that only
posts move and no row for each request and word. The posts of larger requests are brought into tasks by
their place; what a request adds up there is merged before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

ASKED = "asked"
HOME = ("home", "part")
# More requests of a post go to further copies of it, so that lists are bounded and tasks can share them.
ASKED_PER_ROW = 64
# What the requests of a home ask for together, in posts; a request for more has no home.
HOME_POSTS = 10_000
# Users of a home, as a power of two.
HOME_BITS = 5


def with_homes(totals: DataFrame) -> DataFrame:
    """``[..., n_posts, user_id]``, a row for each request with the first of its users, with ``home, part``, null for
    requests that are too large. A home is cut into parts of about ``HOME_POSTS``."""
    home = F.call_function("shiftright", F.col("user_id"), F.lit(HOME_BITS))
    small = F.col("n_posts") <= HOME_POSTS
    along = Window.partitionBy("home", "small").orderBy("user_id", "request_id").rowsBetween(Window.unboundedPreceding, 0)
    part = F.floor(F.sum("n_posts").over(along) / HOME_POSTS)
    placed = totals.withColumns({"home": home, "small": small}).withColumn("part", part)
    return placed.withColumns({c: F.when(F.col("small"), F.col(c)) for c in HOME}).drop("small", "user_id")


def with_askers(rows: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """``rows`` that are asked for, with ``asked``, their lists; a row with many requests comes several times, as ``block`` tells.

    ``pairs`` has a row for each request and key; its other columns go into the lists.
    """
    own = [c for c in pairs.columns if c != key]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*own))
    blocks = pairs.withColumn("block", F.floor((place - 1) / ASKED_PER_ROW))
    return rows.join(blocks.groupBy(key, "block").agg(F.collect_list(F.struct(*own)).alias(ASKED)), key)


def at_home(rows: DataFrame, posts: int) -> DataFrame:
    """Rows once for each home that asks for them, with ``home, part`` and the requests of that home alone.

    Rows of a home are in one task; there are as many tasks as the ``posts`` asked for in all need.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    homes = F.array_distinct(F.transform(ASKED, lambda a: F.struct(*[a[c].alias(c) for c in HOME])))
    sent = rows.select("*", F.explode(homes).alias("at")).where("at.home is not null")
    own = F.filter(ASKED, lambda a: (a["home"] == F.col("at.home")) & (a["part"] == F.col("at.part")))
    sent = sent.withColumn(ASKED, own).select("*", *[F.col(f"at.{c}").alias(f"at_{c}") for c in HOME]).drop("at")
    return sent.repartition(max(parts, posts // HOME_POSTS + 1), *[f"at_{c}" for c in HOME])


def side_by_side(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows that requests without a home ask for, with these alone; rows that are near each other by ``order`` in one task."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = rows.withColumn(ASKED, F.filter(ASKED, lambda a: a["home"].isNull())).where(F.size(ASKED) > 0)
    return rest.repartitionByRange(parts, *order)
