"""Suffix order against sorting, passage removal against a set of all windows."""

import hashlib
import random
from pathlib import Path

import numpy as np
import pytest

from postlens.llm import suffix_dedup as dedup, suffix_sort as sort


def _check_order(symbols, depth, **options):
    text = np.array([*symbols, 0], dtype=np.uint8)
    runs = list(sort.sorted_suffixes(text, depth, **options))
    order = np.concatenate([r[0] for r in runs]).tolist()
    shared = np.concatenate([r[1] for r in runs]).tolist()
    raw = text.tobytes()
    assert order[::-1] == sorted(range(len(raw)), key=lambda i: raw[i:])
    for i in range(1, len(order)):
        a, b = raw[order[i - 1]:], raw[order[i]:]
        n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[i] == n if n < depth else shared[i] >= min(depth, sort.CAP)


def test_order_and_common_prefixes():
    rng = random.Random(5)
    for _ in range(400):
        letters = rng.choice([1, 2, 3, 20])
        symbols = [rng.randint(1, letters) for _ in range(rng.randint(0, 60))] * rng.randint(1, 3)
        _check_order(symbols, rng.choice([3, 8, 100]), base=rng.choice([1, 2, 8, 1 << 20]))


def test_queues_on_disk(tmp_path):
    rng = random.Random(6)
    for _ in range(5):
        spill = sort.Spill(str(tmp_path))
        _check_order([rng.randint(1, 4) for _ in range(200)] * 3, 50, base=4, spill=spill, limit=200)
        assert spill.files > 0
        spill.close()
    assert list(tmp_path.iterdir()) == []


def _expected(rows, length):
    seen, out = set(), {}
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        new = set()
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen or window in new:
                gone[at : at + length] = True
            new.add(window)
        seen |= new
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out[doc_id] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def _words(rng, n, letters="abcdé"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.mark.parametrize("queue_bytes, base", [(1 << 20, 1 << 20), (300, 16)])
def test_passages(spark, queue_bytes, base):
    rng = random.Random(7)
    passages = [_words(rng, n) for n in (25, 40, 60)]
    rows = []
    for doc_id in range(60):
        parts = [_words(rng, rng.randint(0, 30)) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(passages))
        rows.append((doc_id, " ".join(parts)))
    rows += [(70, rows[3][1]), (71, rows[3][1]), (72, "xyz " * 200), (73, "!" * 500), (74, "!" * 400), (75, None), (76, ""), (77, "short")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = dedup.dedup_passages(docs, queue_bytes=queue_bytes, base=base).collect()
    want = _expected(sorted(rows), dedup.LENGTH)
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want


def test_ids_that_are_null_or_repeated_and_other_columns(spark):
    rng = random.Random(8)
    long = _words(rng, 60)
    rows = [(2, long, 5), (2, long, 6), (None, long, 7), (1, "new " + long, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id_ int")
    got = dedup.dedup_passages(docs, carry=["id_"]).collect()
    size = len(long.encode())
    by = sorted(((r["doc_id"] or 99, r["id_"], r["n_removed"]) for r in got))
    assert by == [(1, 8, 0), (2, 5, size), (2, 6, size), (99, 7, size)]
    assert {r["kept_text"] for r in got if r["doc_id"] == 1} == {"new " + long}
    assert dedup.dedup_passages(docs.limit(0)).count() == 0


@pytest.mark.parametrize("length", [15, 201, 300])
def test_lengths_that_cannot_be_told_apart_are_refused(spark, length):
    docs = spark.createDataFrame([(1, "x" * 900)], "doc_id long, text string")
    with pytest.raises(ValueError, match="passages"):
        dedup.dedup_passages(docs, length=length)


def test_longest_passages(spark):
    rng = random.Random(8)
    shared = "".join(rng.choice("abcd ") for _ in range(450))
    rows = [(1, "q" * 30 + shared), (2, shared + "z" * 40), (3, shared[:199])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in dedup.dedup_passages(docs, length=200).collect()}
    assert got == {1: 0, 2: 450, 3: 0}


@pytest.mark.parametrize("texts, carry", [(True, ["lang"]), (False, [])])
def test_texts_move_once_and_are_not_written(spark, tmp_path, monkeypatch, texts, carry):
    rng = random.Random(9)
    random_text = lambda n: "".join(chr(rng.randint(33, 126)) for _ in range(n))
    passages = [random_text(150) for _ in range(4)]
    rows = [(i, random_text(2000) + passages[i // 30] * (i % 10 == 0) + random_text(i % 7), "x") for i in range(100)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "docs"))
    monkeypatch.setattr(dedup, "work_folder", lambda _, name: str(tmp_path / name))
    monkeypatch.setattr("postlens.llm.common.work_folder", lambda _, name: str(tmp_path / name))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = dedup.dedup_passages(spark.read.parquet(str(tmp_path / "docs")), texts=texts, carry=carry)
        assert {r["doc_id"]: r["kept_sha256"] for r in got.collect()} == {k: v[3] for k, v in _expected([r[:2] for r in rows], dedup.LENGTH).items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    written = sum(f.stat().st_size for f in (tmp_path / "passages").iterdir())
    assert written < 0.1 * sum(len(r[1]) for r in rows)
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet [doc_id#") == 1 and "ReusedExchange" in plan
