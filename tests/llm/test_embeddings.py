"""Embedding links against brute force."""

import numpy as np
import pytest

from postlens.llm import embedding_dedup as dedup


def _vectors(seed=0, n=700, size=32):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(60, size))
    noise = rng.choice([0.05, 0.2, 0.4], size=n)
    rows = centres[rng.integers(0, 60, n)] + noise[:, None] * rng.normal(size=(n, size))
    rows[10:20] = rows[9]
    return rows.astype(np.float32)


def test_links_and_recall(spark):
    rows = _vectors()
    frame = spark.createDataFrame([(i, r.tolist(), 1) for i, r in enumerate(rows)], "vec_id long, embedding array<float>, n int")
    got = {r["vec_id"]: r for r in dedup.link_vectors(frame).collect()}
    x = rows.astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    links = x @ x.T >= dedup.THRESHOLD
    np.fill_diagonal(links, False)
    want = links.sum(axis=1)
    n_links = np.array([got[i]["n_links"] for i in range(len(rows))])
    assert (n_links <= want).all()
    assert n_links.sum() >= 0.95 * want.sum()
    for i, r in got.items():
        assert r["kept"] == (r["component_id"] == i)
        assert r["component_id"] <= i
    assert len({got[i]["component_id"] for i in range(9, 20)}) == 1


def test_blocks_give_the_same(spark, monkeypatch):
    rows = _vectors(1)
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<float>")
    whole = sorted(map(tuple, dedup.link_vectors(frame).collect()))
    monkeypatch.setattr(dedup, "BLOCK", 3)
    assert sorted(map(tuple, dedup.link_vectors(frame).collect())) == whole


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 1.0]), (2, [2.0, 0.0, 2.0]), (2, [2.0, 0.0, 2.0]), (3, [1.0, 0.0, 1.0]), (4, None), (5, [0.0, 0.0, 0.0]),
        (6, [nan, 0.0, 1.0]), (7, [inf, 0.0, 1.0]), (8, [None, 0.0, 1.0]), (9, [1.0, 0.0]), (None, [1.0, 0.0, 1.0]), (10, []), (11, [1e300, 0.0, 1e300]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in dedup.link_vectors(frame).collect()}
    assert got == {
        1: (3, 1, True), 2: (3, 1, False), 3: (3, 1, False), 11: (3, 1, False),
        **{i: (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10)}, None: (0, None, False),
    }
    assert dedup.link_vectors(frame.limit(0)).count() == 0


def _directed(common, hot=0.0, n=2000, size=64):
    """Unit vectors around many centres, with a squared component in common, or a hot cluster."""
    rng = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centres, direction = unit(rng.normal(size=(n // 8, size))), unit(rng.normal(size=size))
    noise = rng.choice([0.2, 0.3, 0.45, 0.6], n)[:, None] * rng.normal(size=(n, size)) / np.sqrt(size)
    rows = np.sqrt(common) * direction + np.sqrt(1 - common) * unit(centres[rng.integers(0, len(centres), n)] + noise)
    k = int(hot * n)
    rows[:k] = direction + 0.33 * rng.normal(size=(k, size)) / np.sqrt(size)
    return unit(rows)


def _components(links):
    label = np.arange(len(links))
    while True:
        least = np.where(links, label[None, :], len(links)).min(axis=1)
        now = np.minimum(label, least)
        if (now == label).all():
            return label
        label = now


@pytest.mark.parametrize("common, hot", [(0.0, 0.0), (0.5, 0.0), (0.7, 0.0), (0.0, 0.33)])
def test_recall_where_vectors_share_a_direction(spark, common, hot):
    rows = _directed(common, hot)
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in dedup.link_vectors(frame).collect()}
    links = rows @ rows.T >= dedup.THRESHOLD
    np.fill_diagonal(links, False)
    found = np.array([got[i]["n_links"] for i in range(len(rows))])
    assert (found <= links.sum(axis=1)).all()
    assert found.sum() >= 0.95 * links.sum()
    same = np.array([got[i]["component_id"] for i in range(len(rows))]) == _components(links)
    assert same.mean() >= 0.95


@pytest.mark.parametrize("common", [0.0, 0.5])
def test_plan_for_many_vectors(common):
    rows = _directed(common, n=4000)
    mean, projections, size, per_code = dedup.learn_tables(rows[::2], 10_000_000, dedup.THRESHOLD)
    subs = dedup.substrings(rows, mean, projections, size, per_code)
    a, b = np.nonzero(np.triu(rows @ rows.T, 1) >= dedup.THRESHOLD)
    assert size >= 12
    assert (subs[a] == subs[b]).any(axis=1).mean() >= 0.95


def test_rows_that_share_an_id(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [1.0, 0.1, 0.0]), (3, [0.1, 1.0, 0.0]), (7, [0.0, 0.0, 1.0]), (5, [0.0, 0.0, 2.0]), (5, [-1.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in dedup.link_vectors(frame).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (5, 0, 5, True), (5, 1, 5, True), (7, 1, 5, False)]
