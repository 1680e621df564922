"""Language-model scores: exact base scores, the filter against exact counts."""

import glob
import math
import pickle
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import lm_score as lm
from postlens.llm.common import fold


def _tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()) + [b""]


def test_filter_never_answers_too_low():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 2**63, 5000).astype(np.uint64)
    counts = rng.integers(1, 400, 5000)
    words = np.zeros(64 * 256, np.uint64)
    for level in range(1, 20):
        held = hashes[lm.level(counts) >= level]
        word, bits = lm.entry_marks(held, level, 256)
        np.bitwise_or.at(words, held % np.uint64(64) * np.uint64(256) + word, bits)
    found = lm.Filter(words, 64).levels(hashes)
    assert (found >= lm.level(counts)).all()
    assert (found == lm.level(counts)).mean() > 0.9


@pytest.mark.parametrize("frequent", [lm.FREQUENT_WORDS, 16])
def test_base_score_is_exact(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT_WORDS", frequent)
    monkeypatch.setattr(lm.frequent_words, "__defaults__", (frequent,))
    rng = random.Random(3)
    words = [f"W{int(rng.paretovariate(0.7))}é" for _ in range(3000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \x0b "), (3, rows[3][1]), (3, "other text"), (None, "some words here"), (2**62 + 1, "W1é"), (203, "A\u00a0b\x1cc ÀB")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")
    held = fold(F.col("doc_id"), 7) == 2
    model, counted = lm.train(docs, ~held)
    got = lm.score(docs, model, counted).collect()
    counts = Counter()
    for doc_id, text in rows:
        if zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 != 2:
            counts.update(_tokens(text))
    n, v = sum(counts.values()), len(counts)
    assert (model.tokens, model.types) == (n, v)
    want = sorted(
        (-1 if doc_id is None else doc_id, len(_tokens(text)), sum(counts[t] > 0 for t in _tokens(text)),
         round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in _tokens(text)), 6))
        for doc_id, text in rows
    )
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model, counted = lm.train(docs.limit(0), F.lit(True))
    assert (model.tokens, model.types) == (0, 0)
    assert lm.score(docs.limit(0), model, counted).count() == 0
    row = lm.score(docs, model, counted).first()
    assert (row["n_tokens"], row["n_known"], row["base_score"]) == (3, 0, 0.0)


def test_pairs_help_on_repeated_text(spark):
    rng = random.Random(9)
    phrase = "alpha beta gamma delta epsilon"
    rows = [(i, " ".join(phrase if rng.random() < 0.5 else f"n{rng.randrange(50)}" for _ in range(30))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = fold(F.col("doc_id"), 7) == 2
    model, counted = lm.train(docs, ~held)
    sums = lm.score(docs, model, counted).where(held).agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert sums["s"] > 0.8 * sums["b"]


def test_filter_grows_with_the_entries(spark):
    counted = lm.count_ngrams(spark.createDataFrame([("a b c",)], "text_ string"), 8)
    entries = 60_000_000
    built = lm.build_filter(counted, 8, entries)
    assert 64 * len(built.words) >= lm.BITS_PER_ENTRY * entries


def test_pairs_seen_once_are_kept(spark):
    rows = [(i, f"a{i} b{i} c{i}") for i in range(50)]
    model, _ = lm.train(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(True))
    tokens = np.concatenate([lm.token_hashes(text) for _, text in rows])
    pairs = lm.pair_hash(lm.with_histories(tokens, np.arange(4, 201, 4)), tokens)
    assert (model.filter.counts(pairs) >= 1).all()


def test_scores_do_not_depend_on_partitions_or_frequent_words(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held, before = fold(F.col("doc_id"), 7) == 2, spark.conf.get("spark.sql.shuffle.partitions")
    scores = []
    try:
        for partitions, frequent in ((before, 1 << 17), ("3", 16)):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            monkeypatch.setattr(lm.frequent_words, "__defaults__", (frequent,))
            model, counted = lm.train(docs.repartition(int(partitions)), ~held)
            scores.append({r["doc_id"]: (r["score"], r["base_score"]) for r in lm.score(docs, model, counted).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for i, (score, base) in scores[0].items():
        assert scores[1][i] == (pytest.approx(score, abs=1e-9), pytest.approx(base, abs=1e-9))


def test_score_against_the_mixture_of_exact_counts(spark):
    """Where every count is one, a level says it exactly, and the filter hardly errs."""
    rows = [(i, " ".join(f"d{i}w{n}" for n in range(20))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model, counted = lm.train(docs, F.lit(True))
    got = {r["doc_id"]: r["score"] for r in lm.score(docs, model, counted).collect()}
    ends = lm._MEANS[lm.level(np.array([60]))[0]]  # the end stands once in each text
    total, share = model.tokens + model.types + 1, model.mixes[1]
    after_end = model.mixes[min(lm.level(np.array([ends]))[0], lm.HISTORY_LEVELS - 1)]
    want = (
        math.log10(after_end / ends + (1 - after_end) * 2 / total)
        + 19 * math.log10(share + (1 - share) * 2 / total)
        + math.log10(share + (1 - share) * (ends + 1) / total)
    )
    right = sum(abs(s - want) < 1e-6 for s in got.values())
    assert right >= 0.9 * len(rows)


def test_the_mixture_is_fitted_on_all_training_documents(spark):
    """A long document decides the weights of its levels, wherever a sample would look."""
    rng = random.Random(11)
    rows = [(i, " ".join(f"v{rng.randrange(40)}" for _ in range(5))) for i in range(2500)]
    for i in (1, 2, 3, 5, 8):
        rows[i] = (i, " ".join(f"v{rng.randrange(40)}" if rng.random() < 0.2 else "v1 v2 v3 v4" for _ in range(2500)))
    model, _ = lm.train(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(True))
    tokens = [lm.token_hashes(text) for _, text in rows]
    single, after, step = model.parts(np.concatenate(tokens), np.cumsum([len(t) for t in tokens]), own=True)
    for s in range(lm.HISTORY_LEVELS):
        at = step == s
        likely = [np.log(x * after[at] + (1 - x) * single[at]).sum() for x in lm.MIXES]
        assert model.mixes[s] == lm.MIXES[np.argmax(np.round(likely, 6))]


def test_no_process_holds_the_whole_filter(spark, monkeypatch):
    """Scores from many pieces and homes are those of the whole filter, which is nowhere made."""
    rng = random.Random(17)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(3, rows[3][1]), (3, "other text"), (None, rows[5][1]), (None, None), (160, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = fold(F.coalesce(F.col("doc_id"), F.lit(-1)), 7) == 2
    sent, context = [], type(spark.sparkContext)
    send = context.broadcast
    monkeypatch.setattr(lm, "FLUSH_TOKENS", 400)
    monkeypatch.setattr(lm, "SEGMENT_BYTES", 60)
    monkeypatch.setattr(lm.frequent_words, "__defaults__", (16,))
    with monkeypatch.context() as m:
        m.setattr(lm, "build_filter", lambda *_: pytest.fail("the filter is gathered"))
        m.setattr(context, "broadcast", lambda self, value: sent.append(len(pickle.dumps(value))) or send(self, value))
        model, counted = lm.train(docs, ~held)
        got = [(r["doc_id"], r["n_tokens"], round(r["score"], 9)) for r in lm.score(docs, model, counted).collect()]
    assert model.segments > 128 and counted.count() > 32
    assert max(sent) < 10_000  # the least filter has 131,072 bytes
    tokens = [lm.token_hashes(text) for _, text in rows]
    ends = np.cumsum([len(t) for t in tokens])
    scores = np.add.reduceat(_log10(model, *model.parts(np.concatenate(tokens), ends)), np.r_[0, ends[:-1]])
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(((i, len(t), pytest.approx(x, abs=2e-9)) for (i, _), t, x in zip(rows, tokens, scores)), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2].expected))
    learned = [t for (i, _), t in zip(rows, tokens) if zlib.crc32(str(-1 if i is None else i).encode()) % 7 != 2]
    single, after, step = model.parts(np.concatenate(learned), np.cumsum([len(t) for t in learned]), own=True)
    for s in range(lm.HISTORY_LEVELS):
        likely = [np.log(x * after[step == s] + (1 - x) * single[step == s]).sum() for x in lm.MIXES]
        assert model.mixes[s] == lm.MIXES[np.argmax(np.round(likely, 6))]


def _log10(model, single, after, step):
    share = model.mixes[step]
    return np.log10(share * after + (1 - share) * single)


def test_other_documents_than_those_learned_from(spark):
    """They ask for themselves, and get what the whole filter holds."""
    docs = spark.createDataFrame([(i, f"a b c d{i} a b") for i in range(40)], "doc_id long, text string")
    model, counted = lm.train(docs, F.lit(True))
    texts = ["a b new", "c d1 a", None, "new newer a b c"]
    got = lm.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, counted)
    got = {r["doc_id"]: (r["n_tokens"], r["n_known"], r["score"]) for r in got.collect()}
    for i, known in enumerate((3, 4, 1, 4)):
        tokens = lm.token_hashes(texts[i])
        want = _log10(model, *model.parts(tokens, np.array([len(tokens)]))).sum()
        assert got[i] == (len(tokens), known, pytest.approx(want, abs=1e-9))


def test_places_keep_hashes_and_their_segments():
    hashes = np.r_[np.random.default_rng(1).integers(0, 2**64, 3000, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)]
    for segments in (1, 16, 17, 3001):
        places = lm.places_of(hashes, segments)
        assert (lm.hashes_at(places, segments) == hashes).all()
        assert (np.diff((hashes % np.uint64(segments)).astype(int)[np.argsort(places)]) >= 0).all()
        ordered = np.sort(places)
        assert (lm._unpack_sorted(lm._pack_sorted(ordered)) == ordered).all()
    for values in ([], [0], [5, 300, 0], [2**63]):
        assert lm._unpack(lm._pack(np.array(values, np.uint64))).tolist() == values


def test_shuffles_of_staged_tables_go_with_their_write(spark):
    setting, env = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", spark._jvm.org.apache.spark.SparkEnv.get()
    folders, before = list(env.blockManager().diskBlockManager().localDirsString()), spark.conf.get(setting, None)
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
    had = files()
    dealt = spark.range(5000).repartition(3, "id")
    alone = lm._staged_alone(dealt, "alone")
    assert spark.conf.get(setting, None) == before
    until = time.monotonic() + 20  # they are deleted aside
    while files() - had and time.monotonic() < until:
        time.sleep(0.2)
    assert not files() - had
    assert alone.count() == 5000
    had |= files()
    lm.staged(dealt, "kept")
    assert files() - had
