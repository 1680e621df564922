"""Covers by cells, and requests answered from them."""

import random

import pytest
from pyspark.sql import functions as F

from postlens.operators import cells, topics
from postlens.operators.grid import POINTS, Grid, cover, meet
from postlens.plans import topic_cells, topic_requests
from test_topics import CENSOR, REQUESTS, STOP, make_posts

GRID = Grid(((1, 3), (2, 6), (4, 9)))
REQUEST = "request_id long, uid_lo long, uid_hi long, t_lo long, t_hi long, n1 int, n2 int"
POST = "post_id long, user_id long, created_at long, text string, impact long"


def test_covers_are_exact(spark):
    rng = random.Random(1)
    rects = []
    for i in range(150):
        x, y = rng.randint(-40, 60), rng.randint(-300, 900)
        rects.append((i, x, x + rng.choice([0, 1, 3, 10, 40]), y, y + rng.choice([0, 5, 64, 700])))
    rects.append((150, -(2**63), 2**63 - 1, -(2**63), 2**63 - 1))
    rects.append((151, 3, 2**63 - 1, -(2**63), 0))
    df = spark.createDataFrame(rects, "id long, x_lo long, x_hi long, y_lo long, y_hi long")
    boxes = {}
    for b in cover(df, GRID).collect():
        assert b.x_lo <= b.x_hi and b.y_lo <= b.y_hi
        sx, sy = (0, 0) if b.level == POINTS else GRID.bits[b.level]
        boxes.setdefault(b.id, []).append((b.x_lo << sx, ((b.x_hi + 1) << sx) - 1, b.y_lo << sy, ((b.y_hi + 1) << sy) - 1))
    area = lambda a, b, c, d: (b - a + 1) * (d - c + 1)
    for i, *rect in rects:
        # Parts lie inside, do not overlap, and fill the rectangle.
        assert all(rect[0] <= a and b <= rect[1] and rect[2] <= c and d <= rect[3] for a, b, c, d in boxes[i])
        assert sum(area(*b) for b in boxes[i]) == area(*rect)
        assert len(boxes[i]) <= 4 * (len(GRID.bits) + 1)
        for k, (a, b, c, d) in enumerate(boxes[i]):
            assert not any(a <= f and e <= b and c <= h and g <= d for e, f, g, h in boxes[i][:k])


def test_points_in_rectangles(spark):
    rng = random.Random(2)
    rects = [(i, rng.randint(0, 3), x := rng.randint(-50, 50), x + rng.choice([-1, 0, 7, 90]), y := rng.randint(-50, 50), y + rng.choice([0, 30])) for i in range(60)]
    points = [(i, rng.randint(0, 3), rng.randint(-60, 60), rng.randint(-60, 60)) for i in range(200)]
    got = meet(
        spark.createDataFrame(rects, "rect long, kind int, x_lo long, x_hi long, y_lo long, y_hi long").where("x_lo <= x_hi"),
        spark.createDataFrame(points, "point long, kind int, x long, y long"), "x", "y", ["kind"],
    )
    want = [(r[0], p[0]) for r in rects for p in points if r[1] == p[1] and r[2] <= p[2] <= r[3] and r[4] <= p[3] <= r[5]]
    assert sorted((r["rect"], r["point"]) for r in got.collect()) == want


def test_grids_must_grow():
    for bits in (((3, 3), (2, 4)), ((0, 0),), ((1, 1), (1, 1)), ((1, 63),)):
        with pytest.raises(ValueError):
            Grid(bits)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Posts, their words, and the cells as the job writes them."""
    from postlens.plans.topic_jobs import read_cells, run_topic_cells

    out = str(tmp_path_factory.mktemp("cells"))
    posts = spark.createDataFrame(make_posts(400, 5), POST)
    posts.write.parquet(f"{out}/scored_posts")
    topics.post_words(posts, STOP).write.parquet(f"{out}/post_words")
    run_topic_cells(spark, f"{out}/scored_posts", f"{out}/post_words", out, GRID)
    return spark.read.parquet(f"{out}/scored_posts"), spark.read.parquet(f"{out}/post_words"), read_cells(spark, out)


def test_stored_cells_hold_what_the_words_add_up_to(spark, stored):
    posts, words, stored_cells = stored
    made = cells.cells_of(posts, words, GRID)
    for a, b in zip(stored_cells, made):
        columns = sorted(a.columns)
        assert sorted(a.select(*columns).collect(), key=str) == sorted(b.select(*columns).collect(), key=str)
    per_level = stored_cells.totals.groupBy("level").agg(F.sum("posts")).collect()
    assert {tuple(r) for r in per_level} == {(level, 400) for level in range(3)}


def test_requests_from_cells_agree_with_requests_from_posts(spark, stored):
    posts, words, held = stored
    table = spark.createDataFrame(REQUESTS, REQUEST)
    got = topic_cells.request_words_by_cells(table, posts, words, held, GRID, (), CENSOR)
    assert sorted(got.collect()) == sorted(topic_requests.request_words(table, posts, STOP, CENSOR).collect())
    got = topic_cells.request_posts_by_cells(table, posts, words, held, GRID, (), CENSOR)
    want = sorted(topic_requests.request_posts(table, posts, STOP, CENSOR).collect())
    assert sorted(got.collect()) == want and want


def test_a_wide_request_meets_cells_and_not_posts(spark):
    """Twenty times the posts in the same ranges: the same number of rows comes out of the range joins."""
    table = spark.createDataFrame([(1, 0, 31, 0, 4095, 5, 2), (2, 1, 30, 1, 4094, 5, 2)], REQUEST)
    rows = []
    for copies in (1, 20):
        posts = spark.createDataFrame(
            [(1000 * c + i, u, t, text, m) for c in range(copies) for i, (_, u, t, text, m) in enumerate(make_posts(300, 7)) if 2 <= u < 30 and 8 <= t < 4088],
            POST,
        )
        whole, rim = topic_cells.covered(table, posts, cells.cells_of(posts, topics.post_words(posts), GRID), GRID)
        rows.append((whole.count(), rim.count()))
        met = topic_requests.match_requests(table, posts).count()
    assert rows[0] == rows[1] and rows[0][1] == 0 < rows[0][0]
    assert met > 20 * sum(rows[0])


def test_empty_tables(spark):
    posts = spark.createDataFrame([], POST)
    words = topics.post_words(posts)
    held = cells.cells_of(posts, words, GRID)
    for requests in (REQUESTS, []):
        table = spark.createDataFrame(requests, REQUEST)
        assert topic_cells.request_words_by_cells(table, posts, words, held, GRID).count() == 0
        assert topic_cells.request_posts_by_cells(table, posts, words, held, GRID).count() == 0
