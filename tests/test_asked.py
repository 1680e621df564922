"""Posts asked for by many requests: homes, lists, and what is moved."""

import pytest
from pyspark.sql import functions as F

from postlens.operators import asked, cells, topics
from postlens.plans import topic_cells, topic_query, topic_requests
from test_cells import GRID, POST, REQUEST
from test_plans import plan_of
from test_topics import CENSOR, REQUESTS, STOP, make_posts, plain


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(make_posts(400, 5), POST)


@pytest.fixture(scope="module")
def expected():
    words, found = [], []
    for rid, u0, u1, t0, t1, n1, n2 in REQUESTS:
        valid = u0 <= u1 and t0 <= t1 and n1 > 0 and n2 >= 0
        chosen = [(i, t, m) for i, u, at, t, m in make_posts(400, 5) if valid and u0 <= u <= u1 and t0 <= at <= t1]
        if chosen:
            words += [(rid, k + 1, w, n, round(s, 6)) for k, (w, n, s) in enumerate(plain.topic_words(chosen, STOP, n1))]
            found += [(rid, k + 1, i, plain.censor(t, CENSOR)) for k, (i, t, m) in enumerate(plain.topic_posts(chosen, STOP, n1, n2))]
    return sorted(words), sorted(found)


@pytest.mark.parametrize("home_posts", [1, 30, 150, 10**6])
def test_requests_with_and_without_homes(spark, posts, expected, monkeypatch, home_posts):
    for module in (asked, topic_cells):
        monkeypatch.setattr(module, "HOME_POSTS", home_posts)
    monkeypatch.setattr(asked, "ASKED_PER_ROW", 3)
    table = spark.createDataFrame(REQUESTS, REQUEST)
    words = topics.post_words(posts, STOP)
    held = cells.cells_of(posts, words, GRID)
    of_words = (
        topic_requests.request_words(table, posts, STOP, CENSOR),
        topic_cells.request_words_by_cells(table, posts, words, held, GRID, (), CENSOR),
    )
    for got in of_words:
        assert sorted((r["request_id"], r["rank"], r["word"], r["posts"], r["score"]) for r in got.collect()) == expected[0]
    of_posts = (
        topic_requests.request_posts(table, posts, STOP, CENSOR),
        topic_cells.request_posts_by_cells(table, posts, words, held, GRID, (), CENSOR),
    )
    for got in of_posts:
        assert sorted((r["request_id"], r["rank"], r["post_id"], r["text"]) for r in got.collect()) == expected[1]


def test_no_row_moves_for_each_request_and_word(spark, posts):
    table = spark.createDataFrame(REQUESTS, REQUEST)
    words = topics.post_words(posts, STOP)
    for got in (
        topic_requests.request_words(table, posts, STOP),
        topic_cells.request_words_by_cells(table, posts, words, cells.cells_of(posts, words, GRID), GRID),
    ):
        assert "Exchange hashpartitioning(request_id" not in plan_of(got)


def test_homes_are_bounded(spark):
    rows = [(i, 5, 5, 100 + i % 40, i % 32) for i in range(500)] + [(500, 5, 5, 10**7, 3)]
    totals = spark.createDataFrame(rows, "request_id long, n1 int, n2 int, n_posts long, user_id long")
    placed = asked.with_homes(totals)
    assert [r["request_id"] for r in placed.where("home is null or part is null").collect()] == [500]
    sizes = placed.where("home is not null").groupBy("home", "part").agg(F.sum("n_posts").alias("n")).collect()
    assert len(sizes) > 1 and max(r["n"] for r in sizes) < 2 * asked.HOME_POSTS


def test_lists_are_cut_into_blocks(spark):
    pairs = spark.range(asked.ASKED_PER_ROW * 2 + 1).selectExpr("id as request_id", "7L as post_id")
    rows = asked.with_askers(spark.createDataFrame([(7, "x"), (8, "y")], "post_id long, text string"), pairs, "post_id")
    got = rows.orderBy("block").collect()
    assert [(r["post_id"], r["block"], len(r["asked"])) for r in got] == [(7, 0, 64), (7, 1, 64), (7, 2, 1)]


def test_topic_posts_cut_texts_once(spark, posts):
    """The words of the range are staged: neither the ranking of words nor that of posts cuts texts again."""
    assert "regexp_extract_all" not in plan_of(topic_query.topic_posts(posts, 0, 40, 0, 5000, 3, 3, STOP))
