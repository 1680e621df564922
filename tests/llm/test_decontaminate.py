"""Edit matching against plain dynamic programming."""

import random

from postlens.llm import decontaminate as d


def _distance(pattern, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        row = [i]
        for j, x in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != x)))
        before = row
    return min(before)


def test_myers():
    rng = random.Random(1)
    for _ in range(500):
        pattern = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.5:
            text += pattern[:-2] + "x" + text
        most = rng.randint(0, 20)
        found, want = d.myers(pattern, text, most), _distance(pattern, text)
        assert (found[0] if found else None) == (want if want <= most else None)


def _edited(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1 :], text[:at] + "q" + text[at:], text[:at] + "z" + text[at + 1 :]])
    return text


def test_leaks_against_brute_force(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rng.randint(8, 25))) for i in range(8)] + [(20, "tiny"), (21, ""), (22, None), (None, prose(9))]
    rows = []
    for i in range(40):
        item = rng.choice(items[:8])[1]
        part = _edited(rng, item, rng.randint(0, 14)).upper() if rng.random() < 0.7 else prose(5)
        rows.append((i, f"{prose(rng.randint(0, 20))}\n{part}, {prose(rng.randint(0, 20))}"))
    rows += [(100, None), (101, ""), (None, "Tiny!"), (102, items[0][1])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, distance int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for doc_id, text in rows:
        for item_id, item in items:
            item = d.normalise(item)
            if item_id is not None and item:
                found = _distance(item, d.normalise(text))
                if found <= len(item) // d.CHARS_PER_ERROR:
                    want.add((doc_id, item_id, found))
    got = d.find_leaks(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in got} == want and len(got) == len(want)
    kept = {r["doc_id"] for r in d.decontaminate(docs, bench).collect()}
    assert kept == {r[0] for r in rows} - {w[0] for w in want}
    assert d.find_leaks(docs, bench.limit(0)).count() == 0
    assert d.find_leaks(docs.limit(0), bench).count() == 0


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rng = random.Random(5)
    items = [(i, " ".join(str(rng.random()) for _ in range(4))) for i in range(6)]
    docs = spark.createDataFrame([(i, f"see {t} here") for i, t in items], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(d, "BLOCK_CHARS", 50)
    assert sorted((r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, bench).collect()) == [(i, i) for i in range(6)]
    assert d.decontaminate(docs, bench).count() == 0


def test_items_without_an_id(spark):
    item, other = "which river is the longest of all in the south", "how many moons does the largest planet have"
    docs = spark.createDataFrame([(1, f"so {item} and so"), (2, f"so {other}"), (3, "nothing here")], "doc_id long, text string")
    items = spark.createDataFrame([(None, item), (2**62 + 1, other), (None, None)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in d.find_leaks(docs, items).collect()}
    assert got == {(1, None, 0), (2, 2**62 + 1, 0)}
    assert [r["doc_id"] for r in d.decontaminate(docs, items).collect()] == [3]
