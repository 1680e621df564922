"""Texts kept once: rows carry the number of their text, so that grouping and joining move numbers.

Numbers follow the order of the texts: the lowest, the greatest and the order of numbers are those of the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postlens.sources.staging import stage

TEXT_ID = "text_id"
_KEY = ["text_key1", "text_key2"]


def text_key(column: str) -> list[Column]:
    """Two 64-bit hashes of a text."""
    return [F.xxhash64(F.lit(n), column) for n in (1, 2)]


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumns(dict(zip(_KEY, text_key("text"))))


def number_texts(posts: DataFrame, staging_folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``posts`` with the numbers of their texts in place of ``text``, and ``[text_id, text]``.

    Both are staged; ``posts`` is computed twice, once for its texts and once for the rest. Copies of a
    text merge in each task before they are shuffled, so that what moves is the texts once, and
    numbers for each row.
    """
    in_order = posts.select("text").distinct().repartitionByRange("text").sortWithinPartitions("text")
    # The number of the range, then the place in it: as ranges are in order, so are the numbers.
    numbered = _keyed(in_order.withColumn(TEXT_ID, F.monotonically_increasing_id()))
    texts = stage(numbered, "texts", staging_folder)
    keys = texts.select(*_KEY, TEXT_ID)
    rows = _keyed(posts).drop("text").join(keys, _KEY).withColumnRenamed(TEXT_ID, "text").select(*posts.columns)
    return stage(rows, "numbered", staging_folder), texts.select(TEXT_ID, "text")


def with_texts(rows: DataFrame, texts: DataFrame, column: str = "text") -> DataFrame:
    """The texts in place of their numbers in ``column``; the rows move as numbers, the texts once."""
    listed = texts.select(F.col(TEXT_ID).alias(column), F.col("text").alias("text_"))
    found = rows.join(listed, column, "left").drop(column).withColumnRenamed("text_", column)
    return found.select(*rows.columns)
