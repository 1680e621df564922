"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """The folder named by the session, or ``fallback`` where the session names none."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    folder = folder or fallback
    if not folder:
        raise ValueError(f"{_SETTING} is not set and no shared folder was given")
    return folder.rstrip("/")


def stage(df: DataFrame, name: str, fallback: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Later steps start from the files: they read just the columns they need, and a lost
    executor costs a re-read instead of the whole lineage. The files stay in the folder, under
    a name of their own, until the folder is cleared.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark, fallback)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
