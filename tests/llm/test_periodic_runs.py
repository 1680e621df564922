"""Runs of words against a search over all periods and places."""

import hashlib
import random
import re
import zlib

import numpy as np

from postlens.llm import periodic_runs as p


def _runs(words, least=6, exponent=4):
    """All runs, straight from the definition."""
    out, n = {}, len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in out.items())


def _collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _words(rng, n):
    return [rng.choice("ab") if rng.random() < 0.5 else f"w{rng.randint(0, 40)}" for _ in range(n)]


def _text(rng):
    """Words with stretches of all sorts of periods, some nested, some broken by one word."""
    out = _words(rng, rng.randint(0, 40))
    for _ in range(rng.randint(0, 4)):
        base = _words(rng, rng.choice([1, 2, 3, 5, 8, 9, 13, 16, 17, 31, 33, 70]))
        if rng.random() < 0.3:
            base = base * rng.randint(2, 6) + _words(rng, rng.randint(1, 3))
        part = base * rng.randint(2, 7)
        part = part[: len(part) - rng.randint(0, len(base))]
        if rng.random() < 0.3 and part:
            part[rng.randrange(len(part))] = "other"
        out += part + _words(rng, rng.randint(0, 20))
    return out


def test_all_runs_are_found():
    rng = random.Random(3)
    texts = [_text(rng) for _ in range(400)] + [[], ["a"], ["a"] * 5, ["a"] * 6, ["x", "y"] * 500]
    group = p._Group()
    for i, words in enumerate(texts):
        group.add(i, " ".join(words).encode())
    found = group.rows(4, 6).to_pylist()
    for row, words in zip(found, texts):
        want = _runs(words)
        assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == want
        assert row["collapsed"] == _collapse(words, want)
        assert row["n_words"] == len(words)


def test_more_periods_asked_for():
    rng = random.Random(5)
    for _ in range(60):
        words = _text(rng)
        names = {w: i for i, w in enumerate(dict.fromkeys(words))}
        ids = np.array([names[w] for w in words] + [-1], np.int64)
        assert p.find_stretches(ids, np.array([0, len(ids)]), 5, 3) == _runs(words, 3, 5)


def test_window_minima():
    rng = np.random.default_rng(1)
    for n, width in ((8, 8), (20, 8), (33, 4), (100, 16)):
        values = rng.integers(0, 1000, n).astype(np.uint64)
        want = [min(values[i : i + width]) for i in range(n - width + 1)]
        assert p.window_minima(values, width).tolist() == want


def test_long_texts_go_by_pieces(monkeypatch):
    monkeypatch.setattr(p, "PIECE", 7)
    for data in (b"", b"  a bb  ccc\tdddddddddddd\ne ", b"x" * 30, b"aaaaaa bbbbbbb cccccccc", b" " * 20 + b"end"):
        assert [w for part in p.split_words(data) for w in part] == data.split()


def test_query_against_the_contract(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, "\t ".join(_text(rng)) + rng.choice(["", "\n", " x"])) for i in range(300)]
    rows += [(7, "again again"), (7, None), (None, "a " * 30), (1000, ""), (-5, "b " * 9), (2**53 + 1, "c " * 9)]
    rows += [(50, "word " * 30_000 + "end")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, runs int, start int")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, p.op12_periodic_runs(spark, str(tmp_path)).drop("n_words").collect()), key=str)
    want = []
    for doc_id, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            period = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + i % period] for i in range(n - a)]
        runs = _runs(words) if n < 20_000 else [(0, 30_000, 1)]
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        best = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, _collapse(words, runs))]
        want.append((doc_id, len(runs), *best, *sha))
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    assert p.find_runs(p.with_planted_runs(docs)).count() == 0
