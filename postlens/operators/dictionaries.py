"""Stop words and censored words applied to posts.

A dictionary is a collection of words or a table ``[word]``. Both mean the same: lower-cased
words, without nulls, empty ones and copies. A collection becomes a set of literals inside the
expressions, a table is joined, whatever its size. Only the distinct words of distinct texts
take part in a join, so rows may share an id, and a word that stands often counts once a text.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, functions as F

from postlens.functions.posts import effective_words
from postlens.functions.text import TOKEN, censor_text, lower_words, mask_word, text_segments, word_counts

Words = Collection[str] | DataFrame


def normal_words(words: Words) -> Words:
    """The words in lower case, each once, without nulls and empty ones."""
    if isinstance(words, DataFrame):
        return words.select(F.lower("word").alias("word")).where("word <> ''").distinct()
    return sorted({w.lower() for w in words if w})


def explode_column(df: DataFrame, array: str, item: str) -> DataFrame:
    """One row per item of a column without null items.

    The outer form with a filter on the items: for the inner form the optimizer adds a
    filter on the array, and pushed down that would cut every text a second time.
    """
    rest = [c for c in df.columns if c != array]
    return df.select(*rest, F.explode_outer(array).alias(item)).where(F.col(item).isNotNull())


def drop_stopwords(df: DataFrame, stop: Words) -> DataFrame:
    """Rows whose lower-cased ``word`` is not a stop word."""
    stop = normal_words(stop)
    if isinstance(stop, DataFrame):
        listed = stop.withColumnRenamed("word", "stop_word")
        return df.join(listed, F.lower(df["word"]) == F.col("stop_word"), "left_anti")
    return df.where(~F.lower("word").isin(*stop)) if stop else df


def _text_key(column: str) -> Column:
    return F.struct(F.xxhash64(F.lit(1), column), F.xxhash64(F.lit(2), column))


def with_effective_words(posts: DataFrame, stop: Words, words: str | None = None) -> DataFrame:
    """Add ``effective_words``; ``words`` names a column of lower-cased words, if there is one."""
    listed = F.col(words) if words else lower_words(F.col("text"))
    if not isinstance(stop, DataFrame):
        return posts.withColumn("effective_words", effective_words(listed, normal_words(stop)))
    keyed = posts.withColumn("text_key", _text_key("text"))
    cut = keyed.select("text_key", listed.alias("words"))
    counted = cut.select("text_key", F.inline_outer(word_counts(F.col("words")))).where("word is not null")
    stops = counted.join(normal_words(stop), "word", "left_semi")
    # Texts that come more than once are counted once: their words are the same.
    per_text = stops.dropDuplicates(["text_key", "word"]).groupBy("text_key").agg(F.sum("cnt").alias("stopped"))
    size = F.size(listed).cast("bigint")
    return keyed.join(per_text, "text_key", "left").withColumn(
        "effective_words", size - F.coalesce("stopped", F.lit(0))
    ).select(*posts.columns, "effective_words")


def with_censored_text(posts: DataFrame, censor: Words) -> DataFrame:
    """Add ``censored_text``: the text with the listed words masked."""
    censor_words = normal_words(censor)
    if not isinstance(censor_words, DataFrame):
        return posts.withColumn("censored_text", censor_text(F.col("text"), censor_words))
    keyed = posts.withColumn("text_key", _text_key("text"))
    tokens = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)), F.lower))
    words = explode_column(keyed.select("text_key", tokens.alias("tokens")), "tokens", "word")
    # The listed words of a text: as many as it has distinct words at most.
    found = words.join(censor_words, "word", "left_semi").groupBy("text_key").agg(F.collect_set("word").alias("listed"))
    masked = F.transform(
        text_segments(F.col("text")),
        lambda seg: F.when(F.array_contains("listed", F.lower(seg)), mask_word(seg)).otherwise(seg),
    )
    shown = F.when(F.col("listed").isNull(), F.col("text")).otherwise(F.array_join(masked, ""))
    return keyed.join(found, "text_key", "left").select(*posts.columns, shown.alias("censored_text"))
