"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from postlens.llm import ranked_search as r

TERM = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def _terms(text):
    return re.findall(TERM, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def _brute(docs, items, k=20):
    """Rows as the contract states them."""
    counted = [(i, Counter(t)) for i, text in docs if (t := _terms(text))]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counted:
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in _terms(text)
                if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, n, d, -s) for n, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return out


def _prose(rng, n):
    """Few frequent words, many rare ones."""
    return " ".join(f"w{int(rng.paretovariate(0.6)) % 3000}" for _ in range(n))


def _corpus(rng, n):
    docs = [(i, _prose(rng, rng.choice([1, 5, 30, 200]))) for i in range(n)]
    for i in range(0, n, 7):  # passages that items ask for, and copies
        docs[i] = (i, docs[i][1] + " " + docs[(i * 3) % n][1])
    return docs


def test_segments_against_scoring_all():
    rng = random.Random(1)
    docs = _corpus(rng, 400)
    items = [(i, _prose(rng, rng.choice([1, 2, 8, 40]))) for i in range(40)]
    items += [(100 + i, docs[i][1][:300]) for i in range(20)]
    builders = [r._Builder() for _ in range(5)]
    for i, (doc_id, text) in enumerate(docs):
        builders[i * 5 // len(docs)].add(doc_id, text.encode())
    rows = [row for n, b in enumerate(builders) for row in b.batch(str(n)).to_pylist()]
    about = [row for row in rows if row["term"] == ""]
    block = r.Block(sum(x["df"] for x in about), sum(x["terms"] for x in about))
    df = Counter()
    for row in rows:
        df[row["term"]] += row["df"]
    counted = [Counter(_terms(text)) for _, text in items]
    block.terms = sorted(t for t in set().union(*counted) if t in df)
    block.weights = [r.weight(block.n_docs, df[t]) for t in block.terms]
    number = {t: a for a, t in enumerate(block.terms)} | {"": -1}
    block.queries = [{number[t]: n for t, n in c.items() if t in number} for c in counted]
    block.choose_pairs()
    plain = r.Block(block.n_docs, block.n_terms, block.terms, block.weights)
    for k in (1, 3, 20):
        want = _brute(docs, items, k)
        for with_pairs in (True, False):
            found = [[] for _ in items]
            for n in range(5):
                lists = [(x["segment"], number[x["term"]], -1, x["docs"], x["counts"], None) for x in rows if x["segment"] == str(n) and x["term"] in number]
                table = lambda more=(): pa.Table.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*[*lists, *more]), r._LISTS_ARROW)], schema=r._LISTS_ARROW
                )
                pairs = r.Segment(table(), block).pair_lists(block.pairs).to_pylist() if with_pairs else []
                segment = r.Segment(table([tuple(p.values()) for p in pairs]), block)
                for q, query in enumerate(block.queries):
                    floor = sorted(found[q])[k - 1][0] * -1 if len(found[q]) >= k else 1
                    at, scores = segment.search(query, block.pairs if with_pairs else plain.pairs, k, floor)
                    found[q] += [(-int(s), int(segment.ids[d])) for d, s in zip(at, scores)]
            got = [(items[q][0], n, d, -s) for q, rows_ in enumerate(found) for n, (s, d) in enumerate(sorted(rows_)[:k], 1)]
            assert got == want


def test_pair_bounds_hold_and_are_tighter():
    """No document gives more than its unit's bound; pairs without a common document save much."""
    rng = random.Random(2)
    b = r._Builder()
    for i in range(200):
        b.add(i, (_prose(rng, 60) + (" left" if i % 2 else " right")).encode())
    rows = b.batch("0").to_pylist()
    terms = ["left", "right", "w1", "w2", "w5"]
    number = {t: a for a, t in enumerate(terms)} | {"": -1}
    block = r.Block(200, sum(x["terms"] for x in rows if x["term"] == ""), terms, [900, 900, 300, 400, 800])
    block.queries = [{0: 1, 1: 1, 2: 3, 3: 1, 4: 2}]
    block.choose_pairs()
    lists = [("0", number[x["term"]], -1, x["docs"], x["counts"], None) for x in rows if x["term"] in number]
    table = lambda more=(): pa.Table.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*[*lists, *more]), r._LISTS_ARROW)], schema=r._LISTS_ARROW
    )
    pairs = r.Segment(table(), block).pair_lists(block.pairs).to_pylist()
    segment = r.Segment(table([tuple(p.values()) for p in pairs]), block)
    units, _ = segment._units(block.queries[0], block.pairs, 20)
    for bound, unit in units:
        score = np.zeros(200, np.int64)
        for t in unit:
            score[segment.docs[t]] += block.queries[0][t] * segment.impacts[t]
        assert score.max() <= bound
    alone = sum(n * segment.most[t] for t, n in block.queries[0].items())
    assert sum(bound for bound, _ in units) <= alone - segment.most[0] + 1


def test_long_texts_go_by_pieces(monkeypatch):
    monkeypatch.setattr(r, "PIECE", 5)
    for text in ("", "  ", "Aa,bb  c-d\xe9f g" * 3, "x" * 30 + " y"):
        assert [t.decode() for part in r.split_terms(text.encode()) for t in part] == _terms(text)


def test_query_against_the_contract(spark, tmp_path):
    rng = random.Random(5)
    docs = _corpus(rng, 150)
    docs += [(3, docs[4][1]), (3, docs[4][1]), (None, docs[10][1]), (None, docs[11][1]), (900, None), (901, ""), (902, " ,;")]
    docs += [(2**53 + 1, docs[12][1]), (903, "W1 é w2. É " * 3), (904, "w7 " * 40_000)]
    items = [(i, docs[i * 2][1][:200]) for i in range(25)] + [(50, None), (51, ""), (52, "nowhere"), (None, "w1 W2 é w2"), (53, "W1 w1 w7")]
    items += [(1, "w3 w4"), (1, "w5 w6")]
    spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, score int, term string").repartition(5).write.parquet(
        str(tmp_path / "documents.parquet")
    )
    spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = [tuple(row) for row in r.op11_ranked_search(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(_brute(docs, items), key=str)


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    index = r.build_index(docs)
    assert r.search(index, items).count() == 0
    assert r.search(r.build_index(docs.union(spark.createDataFrame([(1, "a")], docs.schema))), items.where("false")).count() == 0
