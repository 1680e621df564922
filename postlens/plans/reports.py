"""The answers as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postlens.operators.topics import posts_in_range
from postlens.functions.arguments import topic_arguments
from postlens.plans.topic_query import topic_posts, topic_words

# Fixed value: impacts are shown as 32-bit numbers.
MAX_SHOWN_IMPACT = 2147483647


def _in_rank_order(line: Column, separator: str) -> Column:
    ordered = F.sort_array(F.collect_list(F.struct(F.col("rank"), line.alias("line"))))
    return F.array_join(ordered["line"], separator)


def format_contacts(ranked: DataFrame, *by: str) -> DataFrame:
    """``[*by, report]``: a line ``name, description, text`` per contact, tab-separated."""
    line = F.concat_ws("\t", "screen_name", "description", "text")
    return ranked.groupBy(*by).agg(_in_rank_order(line, "\n").alias("report"))


def word_line(words: DataFrame, *by: str) -> DataFrame:
    """``[*by, line]``: ``word:score`` with two decimals, tab-separated.

    Scores have 6 places; as decimals they are rounded half up wherever that is done.
    """
    shown = F.round(F.col("score").cast("decimal(38,6)"), 2).cast("decimal(38,2)").cast("string")
    entry = F.concat_ws(":", "shown_word", shown)
    return words.groupBy(*by).agg(_in_rank_order(entry, "\t").alias("line"))


def post_lines(posts: DataFrame, *by: str) -> DataFrame:
    """``[*by, lines]``: a line ``impact, id, text`` per post, tab-separated."""
    impact = F.least(F.col("impact"), F.lit(MAX_SHOWN_IMPACT))
    line = F.format_string("%d\t%d\t%s", impact, F.col("post_id"), F.col("text"))
    return posts.groupBy(*by).agg(_in_rank_order(line, "\n").alias("lines"))


def topic_report(posts: DataFrame, uid_lo, uid_hi, t_lo, t_hi, n1, n2, staging_folder: str | None = None, **options) -> DataFrame:
    """One row ``[report]``: the word line, then the post lines; empty without posts. Staged as in ``topic_posts``."""
    arguments = topic_arguments(uid_lo, uid_hi, t_lo, t_hi, n1, n2)
    if arguments is None:
        return posts.sparkSession.createDataFrame([("",)], "report string")
    words = topic_words(posts, *arguments[:5], **options)
    chosen = topic_posts(posts, *arguments, staging_folder=staging_folder, **options)
    found = posts_in_range(posts, *arguments[:4]).agg(F.count("*").alias("n")).scalar()
    report = F.concat(F.col("line"), F.lit("\n"), post_lines(chosen).scalar())
    return word_line(words).select(F.when(found > 0, report).otherwise("").alias("report"))
