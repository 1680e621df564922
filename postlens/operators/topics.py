"""Topic words and topic posts.

Posts come as ``scored_posts``: ``post_id, user_id, created_at, text, impact``. Word rows
come as ``post_words``: one row per post and distinct word with ``cnt``, the occurrences,
and ``num_words``, all words of the post with stop words counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postlens.functions.posts import impact_score
from postlens.functions.scoring import rounded, topic_score
from postlens.functions.text import extract_words, lower_words, word_counts
from postlens.operators.dictionaries import (
    Words,
    drop_stopwords,
    explode_column,
    with_effective_words,
)

CARRIED = ("post_id", "user_id", "created_at", "impact")
ADDENDS = ("weight_high", "weight_low")
HIGH, LOW = float(1 << 20), float(1 << 46)
VARIANTS = ("ln_impact_plus_1", "ln_impact")


def with_impact(posts: DataFrame, stop: Words, words: str | None = None) -> DataFrame:
    """Add ``impact``: effective words times popularity."""
    impact = impact_score(
        F.col("effective_words"),
        F.col("followers_count"),
        F.col("reshare_count"),
        F.col("favorite_count"),
    )
    return with_effective_words(posts, stop, words).withColumn("impact", impact)


def posts_in_range(
    posts: DataFrame, uid_lo: int, uid_hi: int, t_lo: int, t_hi: int
) -> DataFrame:
    """Posts by users and at times inside two ranges, all ends included."""
    return posts.where(
        F.col("user_id").between(uid_lo, uid_hi) & F.col("created_at").between(t_lo, t_hi)
    )


def explode_words(posts: DataFrame) -> DataFrame:
    """``[post_id, word]``: one row per occurrence, in lower case."""
    listed = posts.select("post_id", extract_words(F.col("text")).alias("words"))
    return explode_column(listed, "words", "word").withColumn("word", F.lower("word"))


def count_words(posts: DataFrame, words: str | None = None) -> DataFrame:
    """Posts with ``num_words`` and ``counts``, each distinct word with its occurrences.

    ``words`` names a column of lower-cased words, if there is one. Everything is counted
    inside the row, so nothing is shuffled. It is a projection of its own: next to a
    generator, the array of all words would be copied into every row it makes.
    """
    carried = [c for c in CARRIED if c in posts.columns]
    listed = F.col(words) if words else lower_words(F.col("text"))
    return posts.select(*carried, listed.alias("words")).select(
        *carried, F.size("words").alias("num_words"), word_counts(F.col("words")).alias("counts")
    )


def explode_counts(counted: DataFrame) -> DataFrame:
    """One row per post and distinct word, with ``word`` and ``cnt``."""
    rest = [c for c in counted.columns if c != "counts"]
    # The outer form for the reason given in explode_column.
    return counted.select(*rest, F.inline_outer("counts")).where("word is not null")


def post_words(posts: DataFrame, stop: Words = (), words: str | None = None) -> DataFrame:
    """The word rows of posts, stop words left out."""
    return drop_stopwords(explode_counts(count_words(posts, words)), stop)


def _post_weight(variant: str) -> Column:
    impact = F.col("impact")
    return F.log(impact + 1 if variant == "ln_impact_plus_1" else impact)


def with_addends(words: DataFrame, variant: str = VARIANTS[0]) -> DataFrame:
    """Word rows with what each adds to the weight of its word, as two whole numbers.

    ``weight_high`` counts steps of 2**-20, ``weight_low`` steps of 2**-46 beyond. Whole numbers add
    up to the same sum in any order, and fast; 64 bits hold the sums of 10**11 posts.
    """
    steps = words.withColumn("steps", F.col("cnt") / F.col("num_words") * _post_weight(variant) * HIGH)
    high = F.floor("steps")
    low = F.floor((F.col("steps") - high) * (LOW / HIGH) + 0.5)
    return steps.withColumns({"weight_high": high, "weight_low": low}).drop("steps")


def summed(column: str) -> Column:
    return F.sum(column).alias(column)


def weight_of_sums() -> Column:
    return F.col("weight_high") / HIGH + F.col("weight_low") / LOW


def word_weight(
    words: DataFrame, by: tuple[str, ...] = (), variant: str = VARIANTS[0]
) -> DataFrame:
    """``[*by, word, posts, weight]``: in how many posts a word stands, and its weight.

    Word rows are distinct per post already, so the post count is a plain count and all
    values are merged before the shuffle: a common word costs one row per task.
    """
    sums = with_addends(words, variant).groupBy(*by, "word").agg(
        F.count("*").alias("posts"), *map(summed, ADDENDS)
    )
    return sums.select(*by, "word", "posts", weight_of_sums().alias("weight"))


def usable_posts(posts: DataFrame, variant: str) -> DataFrame:
    """Posts the variant is defined for: ``ln(impact)`` needs an impact above 0."""
    if variant not in VARIANTS:
        raise ValueError(f"unknown variant {variant!r}, expected one of {VARIANTS}")
    return posts.where("impact > 0") if variant == "ln_impact" else posts


def scored_words(weights: DataFrame, posts_in_range: Column) -> DataFrame:
    """Add ``score``, to 9 places."""
    score = topic_score(posts_in_range, F.col("posts"), F.col("weight"))
    return weights.withColumn("score", rounded(score, 9))
