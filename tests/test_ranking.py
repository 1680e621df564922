"""Rankings of whole tables and of groups."""

import math
import random

import pytest
from pyspark.sql import functions as F

from checks import queries
from postlens.functions.scoring import rounded
from postlens.operators.skew import ONE_TASK, ranked_by_range, top_per_group, top_rows
from test_plans import plan_of


def order():
    return [F.desc("score"), F.asc("word")]


@pytest.fixture(scope="module")
def words(spark):
    return spark.range(30_000).selectExpr("concat('w', id) as word", "cast(id % 700 as double) / 7 as score").repartition(5)


def _expected(n):
    rows = sorted((-((i % 700) / 7), f"w{i}") for i in range(30_000))
    return [(k, w, -s) for k, (s, w) in enumerate(rows[:n], 1)]


def _got(df):
    return sorted((r["rank"], r["word"], r["score"]) for r in df.select("rank", "word", "score").collect())


def test_small_and_large_rankings_agree(words):
    for n in (1, 25, ONE_TASK, ONE_TASK + 1, 29_999, 10**6):
        assert _got(top_rows(words, order(), n)) == _expected(n)
    assert _got(ranked_by_range(words, order())) == _expected(30_000)


def test_no_task_of_a_large_ranking_sees_all_rows(spark, words):
    # With so few rows, adaptive execution would put them all in one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = top_rows(words, order(), 10**6).withColumn("task", F.spark_partition_id())
        per_task = [r["count"] for r in rows.groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(per_task) == 30_000 and max(per_task) < 15_000


def test_large_rankings_need_no_rows(spark):
    empty = spark.createDataFrame([], "word string, score double")
    assert top_rows(empty, order(), 10**6).count() == 0


def test_groups_of_all_sizes(spark):
    rng = random.Random(3)
    rows = [(g, f"w{i}", float(rng.randint(0, 50)), n) for g, n in ((1, 0), (2, 3), (3, 999), (4, 1000), (5, 5000), (6, 2)) for i in range(1500)]
    df = spark.createDataFrame(rows, "g long, word string, score double, n int").repartition(4)
    want = []
    for g in range(1, 7):
        of_group = sorted(((-s, w, n) for gg, w, s, n in rows if gg == g))
        want += [(g, k, w) for k, (_, w, n) in enumerate(of_group, 1) if k <= n]
    for most in (None, 5000):
        got = top_per_group(df, ["g"], order(), F.col("n"), ["word"], most=most)
        assert sorted((r["g"], r["rank"], r["word"]) for r in got.collect()) == want
    small = df.where("n <= 999")
    got = top_per_group(small, ["g"], order(), F.col("n"), ["word"], most=999)
    assert sorted((r["g"], r["rank"], r["word"]) for r in got.collect()) == [x for x in want if x[0] in (2, 3, 6)]


def test_groups_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([], "g long, word string, score double, n int")
    plan = plan_of(top_per_group(df, ["g"], order(), F.col("n"), ["word"], most=20))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_scores_are_rounded_in_doubles(spark):
    """As SQL rounds: 1.0000005 is below its decimal text, so scaled it does not reach the half."""
    values = [0.5113695, 1.0000005, -2.5, 4.0858455, 16.7613665, 1.0385875]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(rounded(F.col("v"), 6)).collect()]
    assert got == [math.copysign(math.floor(abs(v) * 1e6 + 0.5), v) / 1e6 for v in values]


def test_word_ranking_has_every_word(spark, monkeypatch):
    """The ranking asks for no number of words, so it leaves none out however many there are."""
    posts = spark.createDataFrame([(1, [f"w{i}" for i in range(300)], 5), (2, ["w1", "x"], 7)], "post_id long, words array<string>, impact long")
    monkeypatch.setattr(queries.t, "impact_posts", lambda spark, sf: posts)
    asked = []
    monkeypatch.setattr(queries, "ranked_by_range", lambda *a, **k: asked.append((a[3:], k)) or ranked_by_range(*a, **k), raising=False)
    assert queries.word_ranking(spark, "").count() == 301
    assert asked and "n" not in asked[0][1] and len(asked[0][0]) < 2
