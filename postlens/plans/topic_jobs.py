"""The topic jobs: scored and censored posts, their words, and the serving table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from postlens.functions.text import lower_words
from postlens.operators.cells import Cells, coarser_totals, coarser_words, finest_totals, finest_words
from postlens.operators.clean import clean_topic_posts, dedupe_posts
from postlens.operators.dictionaries import Words, with_censored_text
from postlens.operators.grid import Grid
from postlens.operators.topics import post_words, with_impact
from postlens.plans.topic_query import postings
from postlens.sources.readers import read_posts, read_table, read_words
from postlens.sources.sinks import cluster, cluster_on_curve, table_path, write_jdbc, write_table
from postlens.sources.staging import stage

SCORED_POST = ["post_id", "user_id", "created_at", "text", "censored_text", "impact"]


def score_posts(posts: DataFrame, stop: Words, censor: Words) -> DataFrame:
    """``post_id, user_id, created_at, text, censored_text, impact`` of cleaned posts."""
    listed = posts.withColumn("words", lower_words(F.col("text")))
    return with_censored_text(with_impact(listed, stop, "words"), censor).select(*SCORED_POST)


def scored_posts(raw: DataFrame, stop: Words, censor: Words) -> DataFrame:
    """The scored posts from raw ones, without writing anything."""
    return score_posts(dedupe_posts(clean_topic_posts(raw)), stop, censor)


def run_topic_etl(
    spark: SparkSession,
    input_path: str,
    stopwords_path: str,
    censor_path: str,
    output_path: str,
    suffix: str | None = None,
    censor_obscured: bool = True,
    staging_folder: str | None = None,
) -> None:
    """Posts to the tables ``scored_posts``, ``post_words`` and ``word_postings``, the words once more by word.

    The first two lie on a curve over user and time, the two ranges that queries ask for. Posts are
    staged once cleaned and clustered before their texts are worked on; the word rows are made from
    the finished posts in stored order, so they are clustered already and nothing is shuffled.
    """
    stop = read_words(spark, stopwords_path)
    censor = read_words(spark, censor_path, obscured=censor_obscured)
    posts_path = table_path(output_path, "scored_posts", suffix)
    cleaned = dedupe_posts(clean_topic_posts(read_posts(spark, input_path)))
    clustered = cluster_on_curve(stage(cleaned, "posts", staging_folder), ["user_id", "created_at"], ["post_id"])
    write_table(score_posts(clustered, stop, censor), posts_path)
    words = post_words(read_table(spark, posts_path), stop)
    words_path = table_path(output_path, "post_words", suffix)
    write_table(words, words_path)
    write_table(postings(read_table(spark, words_path)), table_path(output_path, "word_postings", suffix))


def run_topic_cells(
    spark: SparkSession, posts_path: str, words_path: str, output_path: str, grid: Grid, suffix: str | None = None
) -> None:
    """Posts and words to the tables ``cell_totals`` and ``cell_words``, a folder for each level.

    Every level is read back to make the next: it has fewer rows than the words it came from.
    """
    totals_path, words_out = (table_path(output_path, name, suffix) for name in ("cell_totals", "cell_words"))
    totals = finest_totals(read_table(spark, posts_path).select("user_id", "created_at"), grid)
    words = finest_words(read_table(spark, words_path), grid)
    for level in range(len(grid.bits)):
        if level:
            totals, words = coarser_totals(totals, grid, level), coarser_words(words, grid, level)
        for df, path in ((totals, totals_path), (words, words_out)):
            write_table(cluster(df.drop("level"), ["u_cell", "t_cell"]), f"{path}/level={level}")
        totals, words = (_level(spark, path, level) for path in (totals_path, words_out))


def _level(spark: SparkSession, path: str, level: int) -> DataFrame:
    return read_table(spark, f"{path}/level={level}").withColumn("level", F.lit(level))


def read_cells(spark: SparkSession, output_path: str, suffix: str | None = None) -> Cells:
    """The cells that ``run_topic_cells`` has written."""
    return Cells(*(read_table(spark, table_path(output_path, name, suffix)) for name in ("cell_totals", "cell_words")))


def serving_posts(scored: DataFrame) -> DataFrame:
    """What the serving table holds of the scored posts: all but the censored text."""
    return scored.drop("censored_text")


def export_topics(
    scored: DataFrame, url: str, table: str, properties: Mapping[str, str], text_type: str, **options
) -> None:
    """Scored posts into a relational table, without the censored text."""
    types = (
        "post_id bigint, user_id bigint, created_at bigint, "
        f"text {text_type}, impact bigint"
    )
    write_jdbc(serving_posts(scored), url, table, properties, types, **options)
