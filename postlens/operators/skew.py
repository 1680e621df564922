"""Joins and rankings that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from postlens.sources.staging import stage

# Slices of an even size, for each shuffle partition.
SLICES_PER_PARTITION = 10
# Groups that ask for fewer rows are cut to that many in every task, before the shuffle. Spark does so
# below ``spark.sql.optimizer.windowGroupLimitThreshold`` rows, 1000 unless it is set.
SMALL_GROUP = 1000
# A ranking of more rows is made by ranges instead of being merged in one task.
ONE_TASK = 10_000
# Several ranges for each shuffle partition even out which task gets which.
RANGES_PER_PARTITION = 4


def heavy_keys(counts: DataFrame, keys: Sequence[str], rows: str, share: int | None = None) -> DataFrame:
    """``[*keys, slices]``: the keys worth cutting, at most ``share`` of them.

    A key with more than 1/share of all rows is among the ``share`` largest. By default there
    are ``SLICES_PER_PARTITION`` times as many as shuffle partitions, so that a slice is a small
    part of a partition on any cluster; the list grows with the cluster and not with the data.

    ``counts`` holds one row per key and comes from an aggregation that is merged before it
    is shuffled. Slices are in proportion to the rows of the largest keys; all slices
    together number less than 2 * share. Keys tied at the limit are not above the mean, get
    one slice and drop out, so that the list is the same each time it is computed.
    """
    if share is None:
        share = SLICES_PER_PARTITION * int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    largest = counts.select(*keys, F.col(rows).alias("rows")).orderBy(F.desc("rows")).limit(share)
    # One task, over at most ``share`` rows.
    total = F.sum("rows").over(Window.partitionBy())
    slices = F.ceil(F.col("rows") * share / total).cast("int")
    return largest.withColumn("slices", slices).where("slices > 1").drop("rows")


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    heavy: DataFrame | None,
    spread_by: Sequence[str | Column],
    how: str = "inner",
) -> DataFrame:
    """Join ``facts`` to ``lookup`` on ``keys`` with the heavy keys cut into slices.

    Facts of a heavy key are spread over its slices by the hash of ``spread_by``; the
    lookup rows of that key are repeated once per slice. All other keys join as usual,
    and a lookup that is small enough is broadcast by the planner.

    Without ``heavy`` it is a plain join, and adaptive execution cuts the partition of a
    heavy key while it runs. It can do so only if the next step does not rely on the
    partitioning of the join: a grouping by the same keys needs ``heavy``.
    """
    keys = list(keys)
    if heavy is None:
        return facts.join(lookup, keys, how)
    heavy = F.broadcast(heavy)
    slice_of = F.when(
        F.col("slices").isNull(), F.lit(0)
    ).otherwise(F.pmod(F.xxhash64(*spread_by), F.col("slices")).cast("int"))
    all_slices = F.sequence(F.lit(0), F.coalesce(F.col("slices"), F.lit(1)) - 1)
    left = facts.join(heavy, keys, "left").withColumn("slice", slice_of).drop("slices")
    right = lookup.join(heavy, keys, "left").withColumn("slice", F.explode(all_slices)).drop("slices")
    return left.join(right, [*keys, "slice"], how).drop("slice")


def top_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    n: Column,
    spread_by: Sequence[str],
    rank: str = "rank",
    most: int | None = None,
) -> DataFrame:
    """The first ``n`` rows of every group with their rank; ``n`` may differ by group.

    ``most`` is the greatest n there is, if the caller knows it. Groups that ask for few rows are
    cut to ``most`` of them by each task before anything is shuffled. The others are ranked inside
    slices first, which drops the rows that cannot be among the first n, so no task ever
    ranks a whole group. There are as many slices as shuffle partitions: one group may then
    occupy all tasks. Both ways are exact.
    """
    few = SMALL_GROUP - 1
    if most is not None and most <= few:
        return _cut_by_task(df, group, order, n, rank, most)
    if most is None:
        return _ranked_by_slice(df, group, order, n, spread_by, rank)
    small = _cut_by_task(df.where(n <= few), group, order, n, rank, few)
    return small.unionByName(_ranked_by_slice(df.where(n > few), group, order, n, spread_by, rank))


def _cut_by_task(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: Column, rank: str, most: int) -> DataFrame:
    """What reaches a group's task is bounded by ``most`` rows from every task before."""
    first = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(first))
    return ranked.where((F.col(rank) <= F.lit(most)) & (F.col(rank) <= n))


def _ranked_by_slice(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: Column, spread_by: Sequence[str], rank: str
) -> DataFrame:
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    inside = Window.partitionBy(*group, "slice").orderBy(*order)
    across = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn("slice", F.pmod(F.xxhash64(*spread_by), F.lit(slices)))
        .withColumn(rank, F.row_number().over(inside))
        .where(F.col(rank) <= n)
        .withColumn(rank, F.row_number().over(across))
        .where(F.col(rank) <= n)
        .drop("slice")
    )


def greatest(df: DataFrame, column: str) -> int:
    """The greatest value of a column, 0 where there is none: one number for the driver."""
    return df.agg(F.max(column)).first()[0] or 0


def top_rows(
    df: DataFrame, order: Sequence[Column], n: int, rank: str = "rank", staging_folder: str | None = None
) -> DataFrame:
    """The first ``n`` rows with their rank; ``order`` must leave no ties.

    Up to ``ONE_TASK`` rows each task keeps n of its own and one merges them. More are ranked by
    ``ranked_by_range``, which stages the rows in the shared folder.
    """
    if n > ONE_TASK:
        ranked = ranked_by_range(df, order, rank, staging_folder, n)
        return ranked.withColumn(rank, F.col(rank).cast("int"))
    return df.orderBy(*order).limit(n).withColumn(
        rank, F.row_number().over(Window.orderBy(*order))
    )


def ranked_by_range(
    df: DataFrame, order: Sequence[Column], rank: str = "rank", staging_folder: str | None = None, n: int | None = None
) -> DataFrame:
    """All rows (or the first ``n``) with their exact rank, a bigint; no task sees them all.

    Rows are dealt out by ranges of the order and staged. A row's rank is its place in its range
    plus the rows of the ranges before; the driver gets one count for each range. ``order``
    must leave no ties, as rows that are equal by it share a range.
    """
    spark = df.sparkSession
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *order).withColumn("range_", F.spark_partition_id())
    rows = stage(dealt, "ranges", staging_folder)
    counted = sorted(rows.groupBy("range_").agg(F.count("*")).collect())
    before, offsets = 0, []
    for number, count in counted:
        if n is None or before < n:
            offsets.append((number, before))
        before += count
    placed = rows.join(F.broadcast(spark.createDataFrame(offsets, "range_ int, offset_ bigint")), "range_")
    inside = Window.partitionBy("range_").orderBy(*order)
    ranked = placed.withColumn(rank, F.col("offset_") + F.row_number().over(inside)).drop("range_", "offset_")
    return ranked if n is None else ranked.where(F.col(rank) <= n)
