"""The corpus pipeline: documents in, packed sequences out.

Every stage takes what the stage before it kept, written as Parquet and read again, and all
but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from postlens.llm import decontaminate, jaccard_join, lang_id, packing, suffix_dedup
from postlens.llm.common import read_table, staged

NEAR_PERCENT, NEAR_WORDS = 80, 5


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or far from every language learned from ``lang``."""
    return lang_id.accepted(docs, lang_id.train(docs, F.lit(True)))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each class of similar documents: that with the smallest id, an id before none.

    Rows are told apart by a number that is written with them, not by their ids: rows that share an
    id but not the text belong to classes of their own, rows that repeat id and text count as copies,
    and rows without an id take part like others. Texts without a word are in no class and stay.
    """
    rows = staged(docs.withColumn("row_", F.monotonically_increasing_id()), "pipeline-rows")
    classes = jaccard_join.jaccard_classes(rows, id_column="row_", percent=NEAR_PERCENT, words=NEAR_WORDS)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_")
    first = classes.join(rows.select("row_", "doc_id"), "row_").groupBy("component_id").agg(F.min(order).alias("first"))
    return rows.join(first.select("first.row_"), "row_", "left_semi").select(*docs.columns)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages out that also start earlier; documents of which nothing is left go."""
    carry = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    cut = suffix_dedup.dedup_passages(docs, carry=carry).where("kept_text <> ''")
    cut = cut.withColumnRenamed("kept_text", "text").withColumn("n_chars", F.length("text").cast("long"))
    return cut.select(*[c for c in docs.columns])


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, in sequences of at most 4096 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("jaccard_join", keep_one_of_near_copies),
    ("suffix_dedup", remove_repeated_passages),
    ("decontaminate", remove_benchmark_leaks),
    ("pack", pack_sequences),
]
# No stage but the second and third could be said in SQL; small fixtures are tested instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents through all stages, each written in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
