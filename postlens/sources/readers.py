"""Readers for posts, word lists, censor dictionaries and finished tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from postlens.functions.text import rot13
from postlens.sources.schema import RAW_POST


def _parsed(lines: DataFrame) -> DataFrame:
    """``[value, post]``; ``post.malformed`` holds the line if any field does not parse."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"}
    post = F.from_json("value", f"{RAW_POST}, malformed string", options)
    return lines.select("value", post.alias("post"))


_BLANK = "value is null or trim(value) = ''"
_GOOD = "post is not null and post.malformed is null"


def parse_posts(lines: DataFrame) -> DataFrame:
    """Posts from a table ``[value]`` of JSON texts, one object each; malformed ones are dropped.

    A line is malformed if any field of the schema does not parse. That is decided on the whole
    line, whatever columns are read afterwards.
    """
    return _parsed(lines.where(f"not ({_BLANK})")).where(_GOOD).select("post.*").drop("malformed")


def rejected_lines(lines: DataFrame) -> DataFrame:
    """``[value, reason]``: the lines that ``parse_posts`` drops, each with what is wrong with it.

    ``blank``: null, empty or spaces; ``no json``: the text does not parse; ``no object``: another JSON
    value; else ``field`` and the first field of the schema whose value has another type. Lines with a
    fault inside a post that no single field explains are ``no post``.
    """
    faulty = _parsed(lines).where(f"({_BLANK}) or not ({_GOOD})").select("value")
    value = F.try_parse_json("value")
    reason = F.when(F.expr(_BLANK), "blank").when(value.isNull(), "no json")
    reason = reason.when(~F.schema_of_variant(value).startswith("OBJECT"), "no object")
    for field in StructType.fromDDL(RAW_POST):
        one = f"{field.name} {field.dataType.simpleString()}, malformed string"
        alone = F.from_json("value", one, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"})
        reason = reason.when(alone["malformed"].isNotNull(), f"field {field.name}")
    return faulty.select("value", reason.otherwise("no post").alias("reason"))


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """Posts from JSON lines, one object per line; malformed lines are dropped."""
    return parse_posts(spark.read.text(path))


def read_rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """What ``read_posts`` drops, with reasons."""
    return rejected_lines(spark.read.text(path))


def parse_words(lines: DataFrame, obscured: bool = False) -> DataFrame:
    """``[word]`` in lower case from a table ``[value]``, one word per line, empty ones skipped."""
    word = rot13(F.col("value")) if obscured else F.col("value")
    return lines.where("value <> ''").select(F.lower(word).alias("word"))


def parse_censor(lines: DataFrame) -> DataFrame:
    """``[word, mask]`` in lower case from a table ``[value]`` of ``word,mask`` lines."""
    row = F.from_csv("value", "word string, mask string", {"quote": ""}).alias("row")
    return lines.select(row).where("row.word is not null and row.mask is not null").select(
        F.lower("row.word").alias("word"), F.lower("row.mask").alias("mask")
    )


def read_words(spark: SparkSession, path: str, obscured: bool = False) -> DataFrame:
    """Lower-cased word list ``[word]``, one word per line, empty lines skipped.

    ``obscured`` lists are stored rotated by 13 letters.
    """
    return parse_words(spark.read.text(path), obscured)


def read_censor(spark: SparkSession, path: str) -> DataFrame:
    """Censor dictionary ``[word, mask]`` from ``word,mask`` lines, lower-cased."""
    return parse_censor(spark.read.text(path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written by one of the jobs."""
    return spark.read.parquet(path)
