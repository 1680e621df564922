"""Toxicity by a learned lexicon, matched with Levenshtein automata.

The lexicon holds words and stems (``abcd*``) that occur in documents labelled toxic and
hardly in others. A trie of it is intersected with Levenshtein automata: the states that a
token can reach are sets of (trie node, errors), and their transitions are computed once and
kept, so that most tokens leave the automaton after a few characters. The window around a hit
tells quotation from abuse, and a logistic model weighs the hits.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from postlens.llm.common import bounded_sample, fold, read_table

# The model is fitted on at most SLICES * EACH documents of each label: one half of them gives
# the lexicon, the other half the weights.
SLICES, EACH = 64, 128
LEXICON_SIZE = 5000
MIN_TOXIC_DOCS = 10
MIN_LOG_ODDS = 3.0
STEM_LENGTHS = (4, 5, 6)
FUZZY_LENGTH = 5  # words of this length or more are also found with one error
WINDOW = 8
THRESHOLD = 0.7

_TOKEN = re.compile(r"\w+")
_TOKEN_OR_MARK = re.compile(r"\w+|[\"“”„«»\n]")
# Words that announce a quotation, and quotation marks.
REPORTING = frozenset(
    "said says say wrote writes quote quoted quotes called cited reads dit disait écrit cite sagt sagte schrieb "
    "zitat zitiert dijo dice escribió cita citó".split()
)
_OPEN, _CLOSE = frozenset("“„«"), frozenset("”»")


class Automaton:
    """Levenshtein automata of all terms, intersected with their trie, made deterministic lazily."""

    DEAD = 0
    MAX_STATES = 200_000

    def __init__(self, lexicon: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.word: list[float | None] = [None]
        self.stem: list[float | None] = [None]
        self.fuzzy: list[bool] = [False]  # a word below may be matched with an error
        for term, weight in lexicon.items():
            stem = term.endswith("*")
            node, path = 0, [0]
            for c in term.rstrip("*"):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.word.append(None)
                    self.stem.append(None)
                    self.fuzzy.append(False)
                node = self.children[node][c]
                path.append(node)
            if stem:
                self.stem[node] = weight
            else:
                self.word[node] = weight
                if len(term) >= FUZZY_LENGTH:
                    for n in path:
                        self.fuzzy[n] = True
        self.min_fuzzy = FUZZY_LENGTH
        self._reset()

    def _reset(self) -> None:
        start = self._close({(0, 0)})
        self.states: list[frozenset] = [frozenset(), (start, None)]
        self.number = {(start, None): 1}
        self.moves: dict[tuple[int, str], int] = {}

    def _close(self, states: set[tuple[int, int]]) -> frozenset:
        """Add what is reached by leaving out one character of the term."""
        out = set(states)
        for node, errors in states:
            if errors == 0:
                out.update((child, 1) for child in self.children[node].values() if self.fuzzy[child])
        return frozenset(s for s in out if s[1] == 0 or (s[0], 0) not in out)

    def _step(self, state: int, c: str) -> int:
        """The state after one more character; a stem that is complete stays reached."""
        members, stem = self.states[state]
        out: set[tuple[int, int]] = set()
        for node, errors in members:
            child = self.children[node].get(c)
            if child is not None and (errors == 0 or self.fuzzy[child]):
                out.add((child, errors))
                if errors == 0 and self.stem[child] is not None:
                    stem = self.stem[child] if stem is None else max(stem, self.stem[child])
            if errors == 0:
                if self.fuzzy[node]:
                    out.add((node, 1))
                out.update((other, 1) for other in self.children[node].values() if self.fuzzy[other])
        key = (self._close(out), stem)
        if not key[0] and stem is None:
            return self.DEAD
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
        return self.number[key]

    def match(self, token: str) -> tuple[float, bool] | None:
        """Weight of the best term for a token, and whether it needed an error."""
        if len(self.states) > self.MAX_STATES:
            self._reset()
        state, moves = 1, self.moves
        for c in token:
            after = moves.get((state, c))
            if after is None:
                after = moves[state, c] = self._step(state, c)
            if after == 0:
                return None
            state = after
        members, stem = self.states[state]
        exact = [w for n, e in members if e == 0 and (w := self.word[n]) is not None]
        if stem is not None:
            exact.append(stem)
        if exact:
            return max(exact), False
        near = [w for n, e in members if e == 1 and self.fuzzy[n] and (w := self.word[n]) is not None]
        return (max(near), True) if near else None


def context_score(tokens: list[str], at: int, inside: bool) -> float:
    """How much the window around a hit speaks for a quotation, from 0 to 1."""
    near = tokens[max(0, at - WINDOW) : at] + tokens[at + 1 : at + 1 + WINDOW]
    return 0.6 * inside + 0.4 * any(t in REPORTING for t in near)


class Matcher:
    """Features of a text. The answers for tokens already seen are kept, up to a bound."""

    MAX_SEEN = 300_000

    def __init__(self, lexicon: dict[str, float]):
        self.automaton = Automaton(lexicon)
        self.seen: dict[str, tuple[float, bool] | None] = {}

    def hits(self, text: str) -> list[tuple[float, bool, float]]:
        """(weight, fuzzy, context score) of every hit."""
        lowered = text.lower()
        seen, found = self.seen, False
        if len(seen) > self.MAX_SEEN:
            seen.clear()
        for token in set(_TOKEN.findall(lowered)):
            if token not in seen:
                seen[token] = self.automaton.match(token)
            found = found or seen[token] is not None
        if not found:
            return []
        tokens, marks, inside = [], [], False
        for token in _TOKEN_OR_MARK.findall(lowered):
            if token == "\n":
                inside = False
            elif token in _OPEN or token in _CLOSE or token == '"':
                inside = not inside if token == '"' else token in _OPEN
            else:
                tokens.append(token)
                marks.append(inside)
        out = []
        for at, token in enumerate(tokens):
            hit = seen[token] if token in seen else self.automaton.match(token)
            if hit:
                out.append((*hit, context_score(tokens, at, marks[at])))
        return out

    def features(self, text: str | None) -> list[float]:
        hits = self.hits(text) if text else []
        plain = [(w, f, 1 - c) for w, f, c in hits]
        quoted = [(w, f, c) for w, f, c in hits]
        out = []
        for side in (plain, quoted):
            for fuzzy in (False, True):
                weights = [w * share for w, f, share in side if f == fuzzy]
                out += [max(weights, default=0.0) / 5, float(np.log1p(sum(weights)))]
        return out


@dataclass
class Model:
    lexicon: dict[str, float]
    weights: np.ndarray  # the first is the intercept

    def scores(self, features: list[list[float]]) -> np.ndarray:
        rows = np.array(features, dtype=float).reshape(len(features), -1)
        z = self.weights[0] + rows @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def terms_of(text: str) -> set[str]:
    """The words of a text and their stems."""
    words = {t for t in _TOKEN.findall(text.lower()) if len(t) >= 3 and not t.isdigit()}
    return words | {f"{w[:n]}*" for w in words for n in STEM_LENGTHS if len(w) > n}


def choose_terms(counts: list[tuple[str, int, float]]) -> dict[str, float]:
    """Term weights from (term, toxic documents, log odds).

    A stem is left out if one longer term under it is in nearly as many toxic documents.
    """
    ordered = sorted(counts)
    best_below: dict[str, int] = {}
    for term, n, _ in ordered:
        plain = term.rstrip("*")
        for k in STEM_LENGTHS:
            stem = f"{plain[:k]}*"
            if len(plain) >= k and stem != term:
                best_below[stem] = max(best_below.get(stem, 0), n)
    return {t: w for t, n, w in ordered if not (t.endswith("*") and best_below.get(t, 0) >= 0.9 * n)}


def fit_weights(rows: np.ndarray, labels: np.ndarray, case_weights: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps. Weights without evidence stay 0."""
    x = np.hstack([np.ones((len(rows), 1)), rows])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (case_weights * (p - labels)) + penalty * w
        hessian = (x * (case_weights * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        w = w - np.linalg.solve(hessian, gradient)
    return w


def train(docs: DataFrame, labels: DataFrame, held_out) -> Model:
    """Learn from at most ``SLICES * EACH`` labelled documents of each label outside the fold.

    A document with several labels counts as toxic if one of them says so. Without documents
    of both labels the model gives every text the share of toxic ones (0.5 without any).
    """
    marked = (
        labels.select(F.col("doc_id").alias("id_"), F.col("toxic").cast("int").alias("toxic_"))
        .where("id_ is not null and toxic_ in (0, 1)")
        .where(~held_out(F.col("id_")))
        .groupBy("id_").agg(F.max("toxic_").alias("toxic_"))
    )
    sizes = {r["toxic_"]: r["count"] for r in marked.groupBy("toxic_").count().collect()}
    if len(sizes) < 2:
        share = 0.5 if not sizes else (0.9 if 1 in sizes else 0.1)
        return Model({}, np.array([np.log(share / (1 - share))] + [0.0] * 8))
    chosen = bounded_sample(marked, "toxic_", "id_", SLICES, EACH)
    # At most 2 * SLICES * EACH narrow rows.
    sample = docs.select(F.col("doc_id").alias("id_"), F.col("text").alias("text_")).join(
        F.broadcast(chosen), "id_"
    ).withColumn("half_", F.pmod(F.xxhash64(F.lit(3), "id_"), F.lit(2)))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch["text_"], batch["toxic_"]):
                n[toxic].update(terms_of(text or ""))
            terms = list(n[1].keys())  # a term that is in no toxic document is of no use
            yield pd.DataFrame({"term": terms, "t": [n[1][x] for x in terms], "c": 0})
            terms = list(n[0].keys())
            yield pd.DataFrame({"term": terms, "t": 0, "c": [n[0][x] for x in terms]})

    mining = sample.where("half_ = 0")
    n_mined = {r["toxic_"]: r["count"] for r in mining.groupBy("toxic_").count().collect()}
    nt, nc = n_mined.get(1, 0), n_mined.get(0, 0)
    odds = F.log((F.col("t") + 0.5) / (nt + 1)) - F.log((F.col("c") + 0.5) / (nc + 1))
    strong = (
        mining.mapInPandas(count, "term string, t long, c long")
        .groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        .where(F.col("t") >= max(3, min(MIN_TOXIC_DOCS, nt // 40)))
        .withColumn("odds", odds)
        .where(F.col("odds") >= MIN_LOG_ODDS)
        .orderBy(F.desc("t"), "term").limit(LEXICON_SIZE)
    )
    lexicon = choose_terms([(r["term"], r["t"], r["odds"]) for r in strong.collect()])

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(lexicon)
        for batch in batches:
            yield pd.DataFrame({
                "id_": batch["id_"], "toxic_": batch["toxic_"],
                "x": [matcher.features(t) for t in batch["text_"]],
            })

    got = sample.where("half_ = 1").mapInPandas(featurise, "id_ long, toxic_ int, x array<double>").toPandas()
    got = got.sort_values("id_", kind="stable")
    y = got["toxic_"].to_numpy(float)
    rows = np.array(got["x"].tolist(), dtype=float).reshape(len(got), -1) if len(got) else np.zeros((0, 8))
    # Cases stand for the whole training rows of their label, to keep the true share of toxic ones.
    total, n1 = sizes[0] + sizes[1], max(1.0, y.sum())
    case = np.where(y == 1, sizes[1] / total * len(y) / n1, sizes[0] / total * len(y) / max(1.0, len(y) - y.sum()))
    return Model(lexicon, fit_weights(rows, y, case))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, score, predicted, context (quoted weight).

    The whole text is used; null and empty texts have no hits. Repeated rows score alike.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(model.lexicon)
        for batch in batches:
            x = [matcher.features(t if isinstance(t, str) else None) for t in batch["text_"]]
            if x:
                s = model.scores(x)
                yield pd.DataFrame({
                    "id_": batch["id_"], "score": s, "predicted": (s >= threshold).astype("int32"),
                    "context": [max(0.0, f[4], f[6]) for f in x],
                })

    # Ids as text, since a batch of numbers with a null becomes one of doubles.
    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("id_"), F.col("text").alias("text_"))
    out = rows.mapInPandas(run, "id_ string, score double, predicted int, context double")
    return out.select(F.col("id_").cast("long").alias("doc_id"), "score", "predicted", "context")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels are learned outside the held-out fold only."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = lambda column: fold(column, 3) == 1
    model = train(docs, read_table(spark, sf_dir, "labels"), held_out)
    scored = score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


QUERIES = {"op9_toxicity": op9_toxicity}
ORACLES: dict[str, str] = {}
