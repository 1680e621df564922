"""Which words and posts stand out for a range of users and time."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, functions as F

from postlens.functions.arguments import topic_arguments
from postlens.functions.scoring import rounded
from postlens.functions.text import lower_words, mask_word
from postlens.operators.dictionaries import Words, drop_stopwords, normal_words, with_censored_text
from postlens.operators.skew import top_rows
from postlens.operators.topics import (
    VARIANTS,
    count_words,
    explode_counts,
    post_words,
    posts_in_range,
    scored_words,
    usable_posts,
    word_weight,
)
from postlens.sources.schema import TOPIC_POST_RANKING, TOPIC_WORD_RANKING
from postlens.sources.sinks import cluster
from postlens.sources.staging import stage


# Up to so many top words go to the reader of postings as a filter; more are joined.
LISTED_WORDS = 200


def postings(words: DataFrame) -> DataFrame:
    """Word rows laid out by word, then time: the rows of a word stand together, a frequent one in several files."""
    return cluster(words, ["word", "created_at"], ["post_id"])


def best_words_first():
    return [F.desc("score"), F.asc("word")]


def best_posts_first():
    return [F.desc_nulls_last("impact"), F.desc("post_id")]


def with_shown_word(top: DataFrame, censor: Words) -> DataFrame:
    """Add ``shown_word``: the mask where the whole word is in the dictionary."""
    word = F.col("word")
    if isinstance(censor, DataFrame):
        listed = F.lower("word").alias("word")
        mask = F.col("mask") if "mask" in censor.columns else mask_word(F.lower("word"))
        masks = censor.select(listed, mask.alias("mask")).where("word <> ''")
        masks = masks.groupBy("word").agg(F.max("mask").alias("shown_word"))
        return top.join(masks, "word", "left").withColumn(
            "shown_word", F.coalesce("shown_word", "word")
        )
    censor = normal_words(censor)
    listed = word.isin(*censor) if censor else F.lit(False)
    return top.withColumn("shown_word", F.when(listed, mask_word(word)).otherwise(word))


def _with_words(posts: DataFrame) -> DataFrame:
    return posts if "words" in posts.columns else posts.withColumn("words", lower_words(F.col("text")))


def topic_words(
    posts: DataFrame,
    uid_lo: object,
    uid_hi: object,
    t_lo: object,
    t_hi: object,
    n1: object,
    stop: Words = (),
    censor: Words = (),
    variant: str = VARIANTS[0],
    words_table: DataFrame | None = None,
) -> DataFrame:
    """``[rank, word, shown_word, posts, score]``: the first n1 words by score, then word.

    Works on the texts of ``posts``, or on the word rows the topic job has written if
    ``words_table`` is given. Stop words are dropped after words have been counted: by
    then there is one row per distinct word.
    """
    arguments = topic_arguments(uid_lo, uid_hi, t_lo, t_hi, n1, 0)
    if arguments is None:
        return posts.sparkSession.createDataFrame([], TOPIC_WORD_RANKING)
    span, limit = arguments[:4], arguments[4]
    chosen = usable_posts(posts_in_range(posts, *span), variant)
    if words_table is None:
        rows = post_words(_with_words(chosen), words="words")
    else:
        rows = usable_posts(posts_in_range(words_table, *span), variant)
    number_of_posts = chosen.agg(F.count("*").alias("n")).scalar()
    weights = drop_stopwords(word_weight(rows, variant=variant), stop)
    top = top_rows(scored_words(weights, number_of_posts), best_words_first(), limit)
    return with_shown_word(top, censor).select(
        "rank", "word", "shown_word", "posts", rounded(F.col("score"), 6).alias("score")
    )


def topic_posts(
    posts: DataFrame,
    uid_lo: object,
    uid_hi: object,
    t_lo: object,
    t_hi: object,
    n1: object,
    n2: object,
    stop: Words = (),
    censor: Words = (),
    words_table: DataFrame | None = None,
    postings: DataFrame | None = None,
    staging_folder: str | None = None,
) -> DataFrame:
    """``[rank, post_id, impact, text]``: of the posts that hold one of the first n1 words,
    the first n2 by impact, then the higher id. Only these are censored.

    Without ``words_table`` the counted words of the posts are staged, so that texts are cut once;
    ``spark.checkpoint.dir`` or ``staging_folder`` must be set then.
    ``postings`` are the word rows laid out by word: of these only the parts with top words are read.
    """
    arguments = topic_arguments(uid_lo, uid_hi, t_lo, t_hi, n1, n2)
    if arguments is None or arguments[5] == 0:
        return posts.sparkSession.createDataFrame([], TOPIC_POST_RANKING)
    span, n_words, n_posts = arguments[:4], arguments[4], arguments[5]
    chosen = posts_in_range(posts, *span)
    if words_table is None:
        counted = stage(count_words(_with_words(chosen), "words"), "counted", staging_folder)
        words_table = explode_counts(counted)
    top = topic_words(posts, *span, n_words, stop, words_table=words_table).select("word")
    if postings is not None:
        rows = posts_in_range(postings, *span)
        if n_words <= LISTED_WORDS:
            # At most so many words come to the driver; single comparisons reach the row groups' statistics.
            listed = [r["word"] for r in top.collect()]
            rows = rows.where(functools.reduce(lambda a, b: a | b, (F.col("word") == w for w in listed), F.lit(False)))
    else:
        rows = posts_in_range(words_table, *span)
    # Ranked on ids; then the texts of the winners alone are fetched.
    hits = rows.join(top, "word", "left_semi").groupBy("post_id").agg(F.max("impact").alias("impact"))
    ranked = top_rows(hits, best_posts_first(), n_posts)
    ranked = ranked.join(chosen.select("post_id", "text"), "post_id")
    return with_censored_text(ranked, censor).select(
        "rank", "post_id", "impact", F.col("censored_text").alias("text")
    )
