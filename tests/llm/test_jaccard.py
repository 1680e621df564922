"""The Jaccard join against a comparison of all pairs."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from postlens.llm import graph, jaccard_join
from postlens.llm.shingles import Shingler


def _expected(rows, percent, words):
    sets = [(i, set(Shingler(words).set_of(t).tolist())) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in sets:
        for b, y in sets:
            if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(s), find(i)) for i, s in sets}


def _variant(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("percent, words, many", [(90, 3, False), (80, 5, False), (90, 3, True)])
def test_classes(spark, monkeypatch, percent, words, many):
    if many:  # blocks of lists and hot shingles
        monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(300)]
    rows, doc_id = [], 0
    for _ in range(30):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 150))]
        for _ in range(rng.randint(1, 6)):
            rows.append((doc_id, " ".join(_variant(rng, base, rng.randint(0, max(1, len(base) // 20))))))
            doc_id += 1
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows += [(1000 + i, " ".join(_variant(rng, base, i % 4))) for i in range(40)]  # one large group
    rows += [(2000, "One  two"), (2001, "one\ttwo"), (2002, "two one"), (2003, ""), (2004, None), (2005, " \n"), (2006, "one two")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(docs, percent=percent, words=words).collect()}
    assert got == _expected(rows, percent, words)


@pytest.mark.parametrize("percent, words", [(90, 3), (80, 5)])
def test_appended_and_deleted_passages(spark, monkeypatch, percent, words):
    monkeypatch.setattr(jaccard_join, "HOT_DOCS", 3)
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(200)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    page = prose(100)  # hot: many documents hold most of it
    rows = [(i, " ".join(page + prose(rng.randint(40, 90)))) for i in range(8)]
    doc_id = 100
    for _ in range(120):
        base = (page if rng.random() < 0.3 else []) + prose(rng.randint(30, 120))
        n = round(len(base) * (100 - percent) / 100) + rng.randint(-3, 2)
        new = [f"c{rng.randrange(10**6)}" for _ in range(n)] if rng.random() < 0.7 else prose(n)
        changed = rng.choice([base + new, new + base, base[n:], base[:-n] if n else base])
        rows += [(doc_id, " ".join(base)), (doc_id + 1, " ".join(changed))]
        doc_id += 2
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(docs, percent=percent, words=words).collect()}
    assert got == _expected(rows, percent, words)


def test_parities_bound_the_overlap():
    rng = np.random.default_rng(4)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
        x = np.unique(rng.choice(pool, rng.integers(1, 600)))
        y = np.unique(rng.choice(pool, rng.integers(1, 600)))
        odd = [np.frombuffer(jaccard_join.parities(s), np.uint64)[None] for s in (x, y)]
        most = jaccard_join.most_overlap(np.array([len(x)]), np.array([len(y)]), *odd)[0]
        assert len(np.intersect1d(x, y)) <= most <= min(len(x), len(y)) + abs(len(x) - len(y))


def test_pages_that_share_a_passage_give_no_pairs():
    """Sets with a long common part but not similar: their number of emitted pairs stays 0."""
    rng = np.random.default_rng(5)
    page = rng.integers(0, 1 << 62, 200, dtype=np.uint64)
    for n in (50, 200):
        sets = [np.unique(np.r_[page, rng.integers(0, 1 << 62, 250, dtype=np.uint64)]) for _ in range(n)]
        frame = pd.DataFrame({
            "token": 1, "k": range(n), "class": range(n), "n": [len(s) for s in sets], "pos": 3, "mark": 5, "rank": 3, "listed": 40,
            "odd": [jaccard_join.parities(s) for s in sets],
        })
        assert len(jaccard_join._remaining_pairs(90)(frame)) == 0


def test_lists_hold_no_entry_that_can_give_no_pair(spark):
    """Texts that share a shingle now and then, as more texts share more of them, make no entries."""
    rng = random.Random(9)
    prose = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    common = [prose(3) for _ in range(60)]
    # Sizes fit in the second half, but similar sets of them share many lists, not one or two.
    rows = [(i, " ".join(prose(30 + 4 * i) + common[i % 20])) for i in range(60)]
    rows += [(100 + i, " ".join(common[20 + i % 40] + prose(200))) for i in range(80)]
    base = prose(200)
    rows += [(200, " ".join(base)), (201, " ".join(base[:-2]))]
    texts = spark.createDataFrame(rows, "id_ long, text_ string").repartition(4)
    got = jaccard_join.prefix_lists(texts, 3, 90).collect()
    sizes = {len(Shingler(3).set_of(t)) for i, t in rows if i in (200, 201)}
    assert {r["n"] for r in got} == sizes and len({r["k"] for r in got}) == 2
    assert all(r["listed"] * 2 == len(got) and 0 <= r["rank"] < r["listed"] for r in got)


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_fewest_lists_of_an_entry(percent):
    rng = np.random.default_rng(6)
    for _ in range(40):
        token, n = np.sort(rng.integers(-3, 4, 40)), rng.integers(1, 60, 40)
        by = np.lexsort((n, token))
        token, n = token[by], n[by]
        company, least = jaccard_join._company(token, n.astype(np.int32), percent)
        for i in range(40):
            fits = (token == token[i]) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])) & (np.arange(40) != i)
            assert company[i] == fits.any()
            if fits.any():
                assert least[i] <= jaccard_join.least_lists(n[i], n[fits], percent).min()


@pytest.mark.parametrize("percent, words", [(60, 1), (75, 2)])
def test_texts_of_few_words(spark, percent, words):
    """Most shingles are in many sets, so most sets of a fitting size share lists."""
    rng = random.Random(10)
    rows = [(i, " ".join(f"v{rng.randrange(25)}" for _ in range(rng.randint(2, 40)))) for i in range(160)]
    rows += [(200 + i, rows[i][1] + " " + " ".join(f"w{rng.randrange(99)}" for _ in range(i % 9))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(docs, percent=percent, words=words).collect()}
    assert got == _expected(rows, percent, words)


def test_only_wanted_texts_move(spark, monkeypatch):
    rows = [(i % 1500, f"text {i} of many") for i in range(3000)] + [(7, "text 7 of many")] * 3
    texts = spark.createDataFrame(rows, "id_ long, text_ string").withColumn("h", F.xxhash64("text_")).repartition(4)
    ends = texts.where("id_ % 100 = 7")
    wanted = sorted((r["id_"], r["text_"]) for r in ends.select("id_", "text_").distinct().collect())
    assert sorted((r["id_"], r["text_"]) for r in jaccard_join._wanted(texts, ends).collect()) == wanted
    monkeypatch.setattr(jaccard_join, "MAP_BITS", 64)  # too small: others pass, none is lost
    found = [(r["id_"], r["text_"]) for r in jaccard_join._wanted(texts, ends).collect()]
    assert set(wanted) <= set(found) and len(found) == len(set(found))


def test_pairs_are_compared_once(spark, monkeypatch):
    """Rows that repeat id and text, ids with several texts, and sets made again."""
    monkeypatch.setattr(jaccard_join, "HELD", 0)
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "x y z"), (2, "a b c d e f g"), (2, "x y z"), (3, "A b c d e q")]
    texts = spark.createDataFrame(rows, "id_ long, text_ string").withColumn("h", F.xxhash64("text_"))
    row = {(r["id_"], r["text_"]): (r["id_"], r["h"]) for r in texts.collect()}
    x, y, z = row[1, "a b c d e f"], row[2, "a b c d e f g"], row[3, "A b c d e q"]
    pairs = spark.createDataFrame(
        [(1, 2, x, y), (1, 3, x, z), (2, 3, y, z)], "a long, b long, a_ struct<id_: long, h: long>, b_ struct<id_: long, h: long>"
    )
    assert sorted(map(tuple, jaccard_join._compared(pairs, texts, 3).collect())) == [(1, 2, 4, 5, 4), (1, 3, 4, 4, 3), (2, 3, 5, 4, 3)]


def test_answers_derived_from_a_leader(spark):
    rng = random.Random(7)
    sets = {i: set(rng.sample(range(140), rng.randint(90, 120))) for i in range(4)}
    for i in range(4, 40):
        base = set(sets[i % 4])
        base -= set(rng.sample(sorted(base), rng.randint(0, 6)))
        sets[i] = base | {1000 * i + j for j in range(rng.randint(0, 5))}
    similar = lambda a, b, p: 100 * len(sets[a] & sets[b]) >= p * len(sets[a] | sets[b])
    answers = [(min(a, b), max(a, b)) for a in range(4) for b in sets if a != b]
    rows = [(a, b, len(sets[a]), len(sets[b]), len(sets[a] & sets[b])) for a, b in sorted(set(answers))]
    pairs = [(a, b) for a in range(4, 40) for b in range(a + 1, 40)]
    for percent in (90, 70):
        got = jaccard_join._derived(
            spark.createDataFrame(pairs, "a long, b long"), spark.createDataFrame(rows, jaccard_join._ANSWER), percent
        ).collect()
        assert sorted((r["a"], r["b"]) for r in got) == pairs
        decided = [r for r in got if r["linked"] is not None]
        assert all(r["linked"] == similar(r["a"], r["b"], percent) for r in decided)
        assert len(decided) > len(pairs) / 3


def test_odd_rows(spark):
    rows = [(None, "a b c d", 1), (7, "a b c d", 2), (7, "a b c d", 3), (3, "a b c d", 4), (7, "x y z u", 5), (9, "x y z u", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k int")
    got = sorted((r["doc_id"] or 99, r["component_id"] or -1) for r in jaccard_join.jaccard_classes(docs).collect())
    assert [g for g in got if g[0] != 7] == [(3, 3), (9, 7), (99, -1)]
    assert sorted(g[1] for g in got if g[0] == 7) == [3, 3, 7]
    assert jaccard_join.jaccard_classes(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 150)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)]
    rng.shuffle(links)
    parent = {x: x for link in links for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    frame = spark.createDataFrame([*links, (5, 5), (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in graph.components(frame, "a", "b").collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
