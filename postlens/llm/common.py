"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from postlens.sources.staging import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_default(spark: SparkSession) -> str | None:
    """A folder for sessions that name no shared one, which only local sessions may do."""
    if spark.sparkContext.master.startswith("local["):
        return "/tmp/postlens-shared"
    return None


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` in the shared folder and read it back: lineage ends at these files."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.parquet(path)
    out.staged_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame.staged_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_folder(spark, local_default(spark))}/{name}-{uuid.uuid4().hex}"


def fold(id_column: Column, n: int) -> Column:
    """The remainder of crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % n


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_sample(ids: DataFrame, group: str, key: str, slices: int, each: int) -> DataFrame:
    """At most ``slices * each`` rows of every group: those with the least hashes in each slice.

    Ranked inside (group, slice), so that a group with most of the rows is no single task.
    The same rows come out however the input is partitioned.
    """
    h = F.xxhash64(F.lit(11), F.col(key))
    order = Window.partitionBy(group, "slice_").orderBy("hash_", key)
    return (
        ids.withColumn("hash_", h)
        .withColumn("slice_", F.pmod(F.xxhash64(F.lit(7), F.col(key)), F.lit(slices)))
        .withColumn("rank_", F.row_number().over(order))
        .where(F.col("rank_") <= each)
        .drop("hash_", "slice_", "rank_")
    )


def spread_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows dealt out evenly by the hash of ``columns``."""
    return df.repartition(partitions(df.sparkSession), F.xxhash64(*columns))
