"""Packing: exact pieces, gapless sequences, few of them."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from postlens.llm import packing


def _ids(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_words_give_the_ids_of_the_text():
    encoder, tokenizer = packing.WordEncoder(), Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    assert encoder.direct
    texts = ["The  quick,\tbrown\nfox! don't Straße ÉCOLE naïve", "a<|endoftext|>b İstanbul ΣΑΣ. e\u0301 x\u00a0y 12 ½ \x1c z", "", " ", "…—¿!?.,,", "日本語 テキスト"]
    texts += ["Unglichß ßüver, it's DON'T 'S9 x''d a10b--?!c (é7&&& <a>| 16.183.68.211", "a\x0bb\x0cc\x85d\u2028e\u3000f  \n"]
    for text in texts:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_texts_together_give_the_ids_of_each():
    encoder, tokenizer = packing.WordEncoder(), Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    rng = random.Random(7)
    signs = [chr(c) for c in range(0x20, 0x180)] + list("''''sStTdDmMlLrRvVeE<||>  ") + ["\u0301", "İ", "Σ", "\x1c", "\x85"]
    texts = [None, "", " "] + ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(3000)] + ["end ", None]
    got = encoder.ids_of(pa.array(texts))
    assert [g.tolist() for g in got] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert encoder.ids_of(pa.array([], pa.string())) == []


def test_batches_are_cut_by_size(monkeypatch):
    monkeypatch.setattr(packing, "BATCH_BYTES", 10)
    texts = ["abc", None, "x" * 50, "", "abcdef", "abcdef"]
    parts = list(packing._by_size(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text_"])))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts and len(parts) > 2
    assert list(packing._by_size(pa.RecordBatch.from_arrays([pa.array([], pa.string())], names=["text_"]))) == []


def test_pack(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["the", "cat", "sat", "überall"]) for _ in range(rng.randint(0, 90)))) for i in range(150)]
    rows += [(500, None), (501, ""), (None, "one two"), (1, "again"), (502, "word " * 1000)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, piece int")
    got = packing.pack(docs, capacity=128, shard_pieces=(40, 20)).collect()
    want = []
    for doc_id, text in rows:
        ids = _ids(text)
        for n, at in enumerate(range(0, len(ids), 128)):
            part = np.array(ids[at : at + 128], "<u4").tobytes()
            want.append((doc_id, n, at, len(part) // 4, zlib.crc32(part)))
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(want, key=key)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 128
    least = -(-sum(r["length"] for r in got) // 128)
    assert len(sequences) <= 1.05 * least + 1
    assert packing.pack(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_genetic_steps_keep_all_pieces(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 100, 80).tolist()
    a = packing.evolve(lengths, [], 100, seed, generations=0)
    b = packing.evolve(lengths, [a], 100, seed + 1)
    for child in (packing.crossover(a, b, lengths, 100, rng), packing.mutate(a, lengths, 100, rng), b):
        assert sorted(i for x in child for i in x) == list(range(80))
        assert all(sum(lengths[i] for i in x) <= 100 for x in child)
    assert packing.fitness(b, lengths, 100) <= packing.fitness(a, lengths, 100)


def test_improves_on_best_fit():
    # Best fit, longest first, needs one bin more than there must be.
    lengths = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6, 11, 9]
    first = []
    packing.best_fit(first, [], list(range(len(lengths))), lengths, 100)
    assert len(packing.evolve(lengths, [], 100, 1, generations=50)) <= len(first)


def _hard_lengths(n=600):
    return np.random.default_rng(4).integers(1300, 1501, n).tolist()


@pytest.mark.parametrize("seed", range(3))
def test_evolution_needs_fewer_bins_than_best_fit(seed):
    lengths, first = _hard_lengths(), []
    packing.best_fit(first, [], list(range(len(lengths))), lengths, packing.CAPACITY)
    assert len(packing.evolve(lengths, [], packing.CAPACITY, seed)) < len(first)


def test_islands_need_fewer_bins_than_one_generation(spark):
    lengths, first = _hard_lengths(), []
    packing.best_fit(first, [], list(range(len(lengths))), lengths, packing.CAPACITY)
    pieces = spark.createDataFrame(list(enumerate(lengths)), "uid long, length long")
    bins = [
        {r["sequence_id"] for r in packing._pack_level(pieces, 1000, 0, packing.CAPACITY, islands, rounds).collect()}
        for islands, rounds in ((packing.ISLANDS, packing.ROUNDS), (1, 1))
    ]
    assert len(bins[0]) < len(bins[1]) < len(first)
