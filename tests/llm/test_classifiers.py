"""Language identification and toxicity on made-up languages: held-out accuracy and odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import lang_id, toxicity
from postlens.llm.common import fold

LETTERS = {"aa": "abcde", "bb": "mnopq", "cc": "uvxyzé"}


def _prose(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        lang = rng.choice(list(LETTERS))
        rows.append((i, _prose(rng, LETTERS[lang], rng.randint(2, 60)), lang, 0.5))
    rows += [(900, None, "aa", 0.0), (901, "", "aa", 0.0), (902, "12 !? 34", "bb", 0.0), (903, "abc", None, 0.0), (None, "abab cde", "aa", 0.0), (5, "mnop qqq", "bb", 0.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")


def test_language(docs):
    held = fold(F.col("doc_id"), 4) == 2
    model = lang_id.train(docs, ~held)
    got = lang_id.predict(docs, model)
    assert got.count() == docs.count()
    rows = {r["doc_id"]: r for r in got.collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.where(held & F.col("lang").isNotNull() & (F.col("doc_id") < 600)).collect() if r["doc_id"] != 5}
    assert np.mean([rows[i]["lang_pred"] == lang for i, lang in truth.items()]) > 0.98
    for i in (900, 901, 902):
        assert (rows[i]["lang_pred"], rows[i]["score"], rows[i]["rejected"]) == ("und", 0.0, True)
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    kept = {r["doc_id"] for r in lang_id.accepted(docs, model).collect()}
    assert {900, 901, 902}.isdisjoint(kept) and len(kept) > 590


def test_far_texts_are_rejected(spark, docs):
    model = lang_id.train(docs, F.lit(True))
    strange = spark.createDataFrame([(1, "жзий клмн опрс " * 5)], "doc_id long, text string")
    assert lang_id.predict(strange, model).first()["rejected"]
    empty = docs.limit(0)
    assert lang_id.predict(empty, lang_id.train(empty, F.lit(True))).count() == 0
    assert lang_id.predict(strange, lang_id.train(empty, F.lit(True))).first()["lang_pred"] == "und"


def test_unseen_latin_texts_are_rejected(spark):
    words = {
        "aa": "the of and to in is that for was with on are by this from water house people under between which there".split(),
        "bb": "der die und das nicht ist ein zu den mit auf wasser haus leute unter zwischen welche durch auch werden".split(),
    }
    rng = random.Random(9)
    prose = lambda lang, n: " ".join(rng.choices(words[lang], k=n))
    rows = [(i, prose(lang, rng.randint(5, 80)), lang) for i in range(400) for lang in [rng.choice(["aa", "bb"])]]
    rows += [(400, "qxz jvk", "aa"), (401, "xqj " * 30, "bb"), (402, "kk", "aa")]  # odd ones set no floor
    model = lang_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    noise = lambda letters: ["".join(rng.choice(letters) for _ in range(n)) for n in (40, 200, 1000)]
    strange = noise("bcdfghjklmnpqrstvwxz  ") + noise("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/")
    strange += ["kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan " * n for n in (1, 5)]
    assert all(rejected for _, _, rejected in model.predict(strange))
    fresh = [prose(lang, n) for lang in words for n in (2, 5, 20, 80, 400) for _ in range(40)]
    assert np.mean([rejected for _, _, rejected in model.predict(fresh)]) <= 0.02


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = _prose(random.Random(2), "abcdef", 400)
    whole = lang_id.term_counts([text])
    monkeypatch.setattr(lang_id, "_PIECE", 100)
    pieces = lang_id.term_counts([text])
    assert abs(whole.sum() - pieces.sum()) <= 0.05 * whole.sum()


def _edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_automaton_against_edit_distance():
    rng = random.Random(3)
    word = lambda low=3: "".join(rng.choice("abc") for _ in range(rng.randint(low, 8)))
    lexicon = {word(): rng.random() for _ in range(12)} | {f"{word(4)[:4]}*": rng.random() for _ in range(3)}
    automaton = toxicity.Automaton(lexicon)
    for _ in range(4000):
        token = word(1)
        exact = [w for t, w in lexicon.items() if (token.startswith(t[:-1]) if t.endswith("*") else token == t)]
        near = [w for t, w in lexicon.items() if not t.endswith("*") and len(t) >= toxicity.FUZZY_LENGTH and _edit_distance(t, token) == 1]
        want = (max(exact), False) if exact else (max(near), True) if near else None
        assert automaton.match(token) == want, (token, lexicon)


def test_quotation_counts_less():
    matcher = toxicity.Matcher({"idiot": 5.0})
    plain = matcher.features("you are an idiot and that is all there is")
    quoted = matcher.features('he said "you are an idiot" and left the room')
    assert plain[0] > quoted[0] and quoted[4] > plain[4]
    assert matcher.features("you idiott") [2] > 0  # with an error
    assert matcher.features(None) == matcher.features("") == [0.0] * 8


def test_toxicity(spark):
    rng = random.Random(4)
    bad = ["grobian", "flegel", "rüpel"]
    rows, labels = [], []
    for i in range(900):
        toxic = int(rng.random() < 0.3)
        words = _prose(rng, "abcdefgh", 30).split()
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(30), rng.choice(bad))
        rows.append((i, " ".join(words), 1))
        if rng.random() < 0.8:
            labels.append((i, toxic))
    labels += [(None, 1), (2000, None), (3000, 1)]
    rows += [(2000, None, 1), (2001, "", 1), (None, "grobian flegel", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    marked = spark.createDataFrame(labels, "doc_id long, toxic int")
    held = lambda c: fold(c, 3) == 1
    model = toxicity.train(docs, marked, held)
    assert set(bad) <= set(model.lexicon)
    got = toxicity.score(docs, model)
    assert got.count() == len(rows)
    test = got.where(held(F.col("doc_id"))).join(marked, "doc_id").where("toxic is not null").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in test]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.collect())
    none = toxicity.train(docs, marked.limit(0), held)
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), model).count() == 0
