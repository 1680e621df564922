"""Writers: Parquet tables, clustered for lookups, and relational tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Cells per column of the curve, as a power of two.
CURVE_BITS = 8
ROW_GROUP = "parquet.block.size"


def table_path(base: str, name: str, suffix: str | None = None) -> str:
    """``base/name`` or ``base/name_suffix``."""
    return f"{base.rstrip('/')}/{name}" + (f"_{suffix}" if suffix else "")


def cluster(df: DataFrame, by: Sequence[str], spread_by: Sequence[str] = ()) -> DataFrame:
    """Range-partition and sort on ``by``, so that lookups on these columns read little.

    The minimum and maximum kept per file and row group then rule out nearly all of them.
    ``spread_by`` extends the range key only: a single key that holds a large part of the
    table is cut into several ranges instead of filling one task. Finding the ranges
    samples the input, so cluster before costly row-by-row work, not after it.
    """
    return df.repartitionByRange(*by, *spread_by).sortWithinPartitions(*by)


def _place(column: str, bounds: Sequence[int]) -> Column:
    """How many of ``bounds`` (in order, 2**n - 1 of them) are at most the value: found in n steps."""
    held = F.lit(list(bounds))

    def stepped(place: Column, half: int) -> Column:
        def step(at: Column, _: Column) -> Column:
            return F.when(F.get(held, at + (half - 1)) <= F.col(column), at + half).otherwise(at)

        # A fold over one value, since each step uses the place more than once.
        return F.aggregate(F.array(F.lit(0)), place, step)

    place, half = F.lit(0), (len(bounds) + 1) // 2
    while half:
        place, half = stepped(place, half), half // 2
    return place


def curve_position(places: Sequence[Column], bits: int = CURVE_BITS) -> Column:
    """The bits of several whole numbers dealt out in turn: near places get near positions (Z order)."""
    position = F.lit(0).cast("bigint")
    for bit in range(bits):
        for n, place in enumerate(places):
            own = F.call_function("shiftright", place, F.lit(bit)).bitwiseAND(F.lit(1)).cast("bigint")
            position = position + own * (1 << (bit * len(places) + n))
    return position


def cluster_on_curve(df: DataFrame, by: Sequence[str], spread_by: Sequence[str] = (), bits: int = CURVE_BITS) -> DataFrame:
    """Order rows along a space-filling curve over whole-number columns, so that a filter on any of them prunes.

    Each column is cut at quantiles into 2**bits parts of about equal size; the parts' numbers make the
    position. The quantiles are approximate, which moves rows but loses none, and are all
    that goes to the driver. Rows without a value come first. ``spread_by`` extends the range key:
    a cell that holds a large part of the table is cut into several ranges. The input is read
    for the quantiles, for the ranges and for the rows: stage what is dear to make.
    """
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(c, shares).alias(c) for c in by]).first()
    places = [_place(c, row[c]) if row[c] else F.lit(0) for c in by]
    placed = df.withColumn("curve_", curve_position(places, bits))
    return placed.repartitionByRange("curve_", *by, *spread_by).sortWithinPartitions("curve_", *by).drop("curve_")


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", row_group_bytes: int | None = None) -> None:
    """A Parquet table. Smaller row groups than Spark's let lookups skip more and scans run longer."""
    writer = df.write.mode(mode)
    if row_group_bytes:
        writer = writer.option(ROW_GROUP, row_group_bytes)
    writer.parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, by: Sequence[str], buckets: int, sort_by: Sequence[str] = ()) -> None:
    """A Parquet table of the session's catalog, dealt into ``buckets`` files by the hash of ``by``.

    Joins and groupings by these columns need no exchange of it, and a lookup opens one file. A key with
    a large part of the rows fills its bucket: keep such keys apart.
    """
    dealt = df.repartition(buckets, *by)
    writer = dealt.write.format("parquet").option("path", path).bucketBy(buckets, *by)
    writer.sortBy(*(sort_by or by)).saveAsTable(table)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    column_types: str | None = None,
    connections: int = 32,
    batch_size: int = 5000,
    keep_table: bool = False,
) -> None:
    """Replace the rows of a relational table.

    The table is dropped and created again with ``column_types``; ``keep_table`` empties
    it instead, which keeps keys and indexes declared beforehand. ``connections`` bounds
    how many tasks write at once, without narrowing
    the stage that makes the rows: they are dealt out anew. Each partition is one transaction, so a partition that
    is written again after a lost executor is rolled back or, if the loss fell between
    commit and report, refused by the primary key of a kept table. User, password and
    driver come from the caller in ``properties``.
    """
    writer = (
        df.repartition(connections).write.mode("overwrite")
        .option("numPartitions", connections)
        .option("batchsize", batch_size)
        .option("truncate", str(keep_table).lower())
    )
    if column_types and not keep_table:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.jdbc(url, table, properties=dict(properties))
