"""Topic queries for a whole table of requests: a range join on user and time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from postlens.functions.arguments import whole_number_column
from postlens.functions.scoring import rounded
from postlens.operators.asked import ASKED, HOME, at_home, side_by_side, with_askers, with_homes
from postlens.operators.dictionaries import Words, drop_stopwords, with_censored_text
from postlens.operators.grid import BOX, meet
from postlens.operators.skew import top_per_group
from postlens.operators.topics import ADDENDS, count_words, explode_counts, scored_words, summed, weight_of_sums, with_addends
from postlens.plans.topic_query import best_posts_first, best_words_first, with_shown_word
from postlens.sources.staging import stage

WORDS_PER_ARRAY = 10_000
OF_REQUEST = ("request_id", "n1", "n_posts")


def valid_topic_requests(requests: DataFrame) -> DataFrame:
    """``[request_id, uid_lo, uid_hi, t_lo, t_hi, n1, n2]`` without the requests whose
    answer is empty."""
    longs = [whole_number_column(F.col(c), "bigint").alias(c) for c in ("uid_lo", "uid_hi", "t_lo", "t_hi")]
    ints = [whole_number_column(F.col(c), "int").alias(c) for c in ("n1", "n2")]
    return requests.select("request_id", *longs, *ints).where(
        "n1 > 0 and n2 >= 0 and uid_lo <= uid_hi and t_lo <= t_hi"
    )


def match_requests(requests: DataFrame, posts: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """``[request_id, n1, n2, post_id, impact, *kept]``: posts of every valid request, a row each.

    Only ids, times and impacts of posts go through the join; post ids are unique.
    """
    ranges = zip(BOX, ("uid_lo", "uid_hi", "t_lo", "t_hi"))
    valid = valid_topic_requests(requests).withColumnsRenamed({c: side for side, c in ranges})
    narrow = posts.select("post_id", "user_id", "created_at", "impact")
    return meet(valid, narrow, "user_id", "created_at").drop(*({"user_id", "created_at"} - set(kept)))


def request_totals(counts: DataFrame, staging_folder: str | None) -> DataFrame:
    """``[request_id, n1, n2, n_posts, home, part]``, staged, from ``[request_id, n1, n2, user_id, posts]``."""
    totals = counts.groupBy("request_id", "n1", "n2").agg(F.sum("posts").alias("n_posts"), F.min("user_id").alias("user_id"))
    return stage(with_homes(totals), "totals", staging_folder)


def asked_posts(counted: DataFrame, pairs: DataFrame, totals: DataFrame, staging_folder: str | None) -> DataFrame:
    """Posts with their counted words and their requests, staged: texts are cut once, and only posts asked for are kept.

    ``pairs`` is ``[request_id, n1, n2, post_id]``.
    """
    return stage(with_askers(counted, pairs.join(totals, ["request_id", "n1", "n2"]), "post_id"), "asked", staging_folder)


def _sums(near: DataFrame, homes: Sequence[str]) -> DataFrame:
    rows = explode_counts(near.select(*homes, "impact", "num_words", "counts", F.inline(ASKED)).drop(*HOME))
    return with_addends(rows).groupBy(*homes, *OF_REQUEST, "word").agg(F.count("*").alias("posts"), *map(summed, ADDENDS))


def _first_words(sums: DataFrame, stop: Words, homes: Sequence[str], most: int) -> DataFrame:
    weights = sums.select(*homes, *OF_REQUEST, "word", "posts", weight_of_sums().alias("weight"))
    scored = scored_words(drop_stopwords(weights, stop), F.col("n_posts"))
    top = top_per_group(scored, [*homes, "request_id"], best_words_first(), F.col("n1"), ["word"], most=most)
    return top.select("request_id", "rank", "word", "posts", "score")


def top_words(
    asked: DataFrame, totals: DataFrame, stop: Words, most: int, more: DataFrame | None = None
) -> DataFrame:
    """``[request_id, rank, word, posts, score]``: the first n1 words of every request.

    ``more`` is what requests without a home add up apart from ``asked``.
    """
    has_home = F.col("home").isNotNull()
    small, large = totals.agg(F.sum(F.when(has_home, F.col("n_posts"))), F.count(F.when(~has_home, 1))).first()
    homes = [f"at_{c}" for c in HOME]
    top = _first_words(_sums(at_home(asked, small or 0), homes), stop, homes, most)
    if not large:
        return top
    sums = _sums(side_by_side(asked, ["user_id", "created_at", "post_id"]), [])
    if more is not None:
        sums = sums.unionByName(more).groupBy(*OF_REQUEST, "word").agg(*map(summed, ("posts", *ADDENDS)))
    return top.unionByName(_first_words(sums, stop, [], most))


def posts_with_words(asked: DataFrame, top: DataFrame) -> DataFrame:
    """``[request_id, n2, post_id, impact]``: posts that hold one of the request's top words.

    The top words travel as arrays of bounded length, so posts are tested whole; the words of a
    post move once, not once for each of its requests.
    """
    block = F.floor((F.col("rank") - 1) / WORDS_PER_ARRAY)
    top = top.groupBy("request_id", block.alias("top_block")).agg(F.collect_list("word").alias("top_words"))
    pairs = asked.select("post_id", "impact", F.inline(ASKED)).join(top, "request_id")
    words = asked.where("block = 0").select("post_id", F.col("counts.word").alias("distinct_words"))
    return (
        pairs.join(words, "post_id")
        .where(F.arrays_overlap("distinct_words", "top_words"))
        .groupBy("request_id", "post_id")
        .agg(F.max("impact").alias("impact"), F.max("n2").alias("n2"))
    )


def _prepared(requests: DataFrame, posts: DataFrame, staging_folder: str | None) -> tuple[DataFrame, DataFrame]:
    matched = match_requests(requests, posts, ["user_id"]).drop("impact")
    pairs = stage(matched, "pairs", staging_folder)
    totals = request_totals(pairs.withColumn("posts", F.lit(1)), staging_folder)
    counted = count_words(posts, "words" if "words" in posts.columns else None)
    return asked_posts(counted, pairs.drop("user_id"), totals, staging_folder), totals


def most_asked(requests: DataFrame) -> tuple[int, int]:
    """The greatest n1 and n2 of the valid requests: two numbers for the driver."""
    n1, n2 = valid_topic_requests(requests).agg(F.max("n1"), F.max("n2")).first()
    return n1 or 0, n2 or 0


def request_words(
    requests: DataFrame, posts: DataFrame, stop: Words = (), censor: Words = (), staging_folder: str | None = None
) -> DataFrame:
    """``[request_id, rank, word, shown_word, posts, score]`` for every request.

    The posts asked for are staged with their counted words, so ``spark.checkpoint.dir`` or ``staging_folder`` must be set.
    """
    top = top_words(*_prepared(requests, posts, staging_folder), stop, most_asked(requests)[0])
    return with_shown_word(top, censor).select(
        "request_id", "rank", "word", "shown_word", "posts", rounded(F.col("score"), 6).alias("score")
    )


def request_posts(
    requests: DataFrame, posts: DataFrame, stop: Words = (), censor: Words = (), staging_folder: str | None = None
) -> DataFrame:
    """``[request_id, rank, post_id, impact, text]`` for every request.

    Staged as in ``request_words``.
    """
    asked, totals = _prepared(requests, posts, staging_folder)
    most_words, most_posts = most_asked(requests)
    chosen = posts_with_words(asked, top_words(asked, totals, stop, most_words))
    ranked = top_per_group(chosen, ["request_id"], best_posts_first(), F.col("n2"), ["post_id"], most=most_posts)
    texts = posts.select("post_id", "text")
    if isinstance(censor, DataFrame):
        texts = texts.join(ranked.select("post_id").distinct(), "post_id", "left_semi")
        shown = ranked.join(with_censored_text(texts, censor), "post_id")
    else:
        shown = with_censored_text(ranked.join(texts, "post_id"), censor)
    return shown.select(
        "request_id", "rank", "post_id", "impact", F.col("censored_text").alias("text")
    )
