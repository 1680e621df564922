"""Language identification by the nearest centroid.

A text becomes a normalised TF-IDF vector of hashed byte 1-, 2- and 3-grams. Every language
has several centroids, found by spherical k-means on a bounded sample of labelled documents.
The language of the centroid with the greatest cosine is predicted. A text is rejected if it
lies farther from it than texts of its length do that the language's centroids were made
without; short texts lie farther away than long ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postlens.llm.common import bounded_sample, fold, read_table

DIMENSIONS = 4096
# The classifier is fitted on at most SLICES * EACH documents of every language.
SLICES, EACH = 32, 8
MAX_LANGUAGES = 1000
CENTROIDS = 4
# Rejected: a cosine below REJECT_SHARE of the quantile LOW of the language's sample documents,
# cut to LENGTHS bytes and measured with centroids of the other folds. Lengths that fewer than
# MIN_MEASURED documents reach have the floor of the next shorter one.
LOW, REJECT_SHARE = 0.02, 0.7
LENGTHS = tuple(1 << i for i in range(2, 11))
FOLDS, MIN_MEASURED = 4, 8
UNDETERMINED = "und"

_PIECE = 1 << 20
_TO_SPACE = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def _codes(data: np.ndarray) -> np.ndarray:
    """Hashed 1-, 2- and 3-grams of a run of bytes, as dimensions."""
    wide = data.astype(np.uint32)
    two = wide[:-1] | wide[1:] << 8 | 1 << 24
    three = wide[:-2] | wide[1:-1] << 8 | wide[2:] << 16 | np.uint32(2 << 24)
    codes = np.concatenate([wide, two, three])
    return (codes * np.uint32(2654435761)) >> np.uint32(20)


def _plain(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_TO_SPACE).split()) + b" "


def term_counts(texts: list[str | None]) -> np.ndarray:
    """One row of gram counts per text. Long texts are counted piece by piece."""
    counts = np.zeros((len(texts), DIMENSIONS), np.float32)
    for row, text in enumerate(texts):
        if not text:
            continue
        plain = _plain(text)
        for at in range(0, len(plain), _PIECE):
            piece = np.frombuffer(plain[at : at + _PIECE + 2], np.uint8)
            if len(piece) > 2:
                counts[row] += np.bincount(_codes(piece), minlength=DIMENSIONS)
    return counts


def _normal(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    languages: list[str]
    owner: np.ndarray  # language of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floors: np.ndarray  # cosine by language and length below which a text is rejected

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _normal(np.sqrt(counts) * self.idf)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Language, cosine of the nearest centroid, and whether it is too far away."""
        if not self.languages:
            return [(UNDETERMINED, 0.0, True)] * len(texts)
        counts = term_counts(texts)
        cosines = self.vectors(counts) @ self.centroids.T
        best = cosines.argmax(axis=1)
        # Three grams start at every byte but the last ones.
        lengths = np.log2(counts.sum(axis=1) / 3 + 1)
        out = []
        for text, i, row, length in zip(texts, best, cosines, lengths):
            if not has_letter(text):
                out.append((UNDETERMINED, 0.0, True))
            else:
                owner, cosine = self.owner[i], float(min(1.0, max(0.0, row[i])))
                floor = np.interp(length, np.log2(LENGTHS), self.floors[owner])
                out.append((self.languages[owner], cosine, bool(cosine < floor)))
        return out


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Up to ``k`` unit centroids; starts from rows that lie far apart, so it has no chance in it."""
    mean = rows.mean(axis=0)
    chosen = [int((rows @ mean).argmax())]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int((rows @ rows[chosen].T).max(axis=1).argmin()))
    centroids = rows[chosen]
    for _ in range(rounds):
        nearest = (rows @ centroids.T).argmax(axis=1)
        sums = np.stack([rows[nearest == i].sum(axis=0) for i in range(len(centroids))])
        centroids = _normal(sums[np.linalg.norm(sums, axis=1) > 0])
    return centroids


def _floors(model: Model, rows: np.ndarray, heads: list[bytes], centroids: int) -> np.ndarray:
    """Least cosine of a text that is not rejected, by length; nan where too few documents tell."""
    folds = np.arange(len(rows)) % FOLDS
    centers = [spherical_kmeans(rows[folds != i], centroids) if (folds != i).any() else None for i in range(FOLDS)]
    out = np.full(len(LENGTHS), np.nan)
    for n, length in enumerate(LENGTHS):
        found = []
        for i, center in enumerate(centers):
            cut = [heads[at][:length] for at in np.flatnonzero(folds == i) if len(heads[at]) >= length]
            if center is not None and cut:
                vectors = model.vectors(np.stack([np.bincount(_codes(np.frombuffer(c, np.uint8)), minlength=DIMENSIONS) for c in cut]))
                found += (vectors @ center.T).max(axis=1).tolist()
        if len(found) >= MIN_MEASURED:
            out[n] = REJECT_SHARE * max(0.0, np.quantile(found, LOW))
        elif n:
            out[n] = out[n - 1]  # shorter texts lie farther away
    return out


def fit(counts: np.ndarray, labels: list[str], heads: list[bytes], centroids: int = CENTROIDS) -> Model:
    """``heads``: the first bytes, at least ``LENGTHS[-1]``, of the texts as they are counted."""
    languages = sorted(set(labels))
    number = np.array([languages.index(x) for x in labels], dtype=int)
    idf = np.log1p(len(labels) / (1.0 + (counts > 0).sum(axis=0))).astype(np.float32)
    model = Model(
        languages, np.zeros(0, int), np.zeros((0, DIMENSIONS), np.float32), idf, np.full((len(languages), len(LENGTHS)), np.nan)
    )
    rows = model.vectors(counts)
    owner, found = [], []
    for i in range(len(languages)):
        own = np.flatnonzero(number == i)
        centers = spherical_kmeans(rows[own], centroids)
        owner += [i] * len(centers)
        found.append(centers)
        model.floors[i] = _floors(model, rows[own], [heads[at] for at in own], centroids)
    if found:
        model.owner, model.centroids = np.array(owner), np.concatenate(found).astype(np.float32)
        # A language with too few documents has the floors of the least strict one.
        known = np.where(np.isnan(model.floors), np.inf, model.floors).min(axis=0)
        model.floors = np.where(np.isnan(model.floors), np.where(np.isinf(known), 0.0, known), model.floors)
    return model


def train(docs: DataFrame, may_learn: Column) -> Model:
    """Fit on at most ``SLICES * EACH`` documents of every language among the allowed rows.

    Rows without a language or without an ASCII or other letter teach nothing. No labelled row
    at all gives a model that rejects everything.
    """
    rows = docs.select(
        F.col("doc_id").alias("id_"), F.col("lang").alias("lang_"), F.col("text").alias("text_"), may_learn.alias("may_")
    ).where("may_ and id_ is not null and lang_ is not null")
    languages = rows.select("lang_").distinct().limit(MAX_LANGUAGES + 1).count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    chosen = bounded_sample(rows.where("text_ is not null").select("id_", "lang_"), "lang_", "id_", SLICES, EACH)
    chosen = chosen.groupBy("id_", "lang_").agg(F.lit(1).alias("one"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[[has_letter(t) for t in batch["text_"]]]
            counts = term_counts(batch["text_"].tolist()).astype(np.float32)
            yield pd.DataFrame({
                "id_": batch["id_"], "lang_": batch["lang_"], "counts": [c.tobytes() for c in counts],
                "head": [_plain(t)[: LENGTHS[-1]] for t in batch["text_"]],
            })

    # At most MAX_LANGUAGES * SLICES * EACH narrow rows.
    sample = rows.join(F.broadcast(chosen), ["id_", "lang_"], "left_semi").select("id_", "lang_", "text_")
    got = sample.mapInPandas(count, "id_ long, lang_ string, counts binary, head binary").toPandas()
    got = got.sort_values(["lang_", "id_"], kind="stable")
    counts = np.array([np.frombuffer(c, np.float32) for c in got["counts"]]).reshape(-1, DIMENSIONS)
    return fit(counts, got["lang_"].tolist(), got["head"].tolist())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (cosine, 0 to 1), rejected.

    The whole text is used. Null and empty texts and texts without a letter give ``und`` with
    score 0 and are rejected. Repeated rows give repeated rows; ties go to the first centroid.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                got = model.predict([t if isinstance(t, str) else None for t in part["text_"]])
                yield pd.DataFrame({
                    "id_": part["id_"],
                    "lang_pred": [g[0] for g in got],
                    "score": [g[1] for g in got],
                    "rejected": [g[2] for g in got],
                })

    # Ids as text, since a batch of numbers with a null becomes one of doubles.
    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("id_"), F.col("text").alias("text_"))
    out = rows.mapInPandas(run, "id_ string, lang_pred string, score double, rejected boolean")
    return out.select(F.col("id_").cast("long").alias("doc_id"), "lang_pred", "score", "rejected")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, with all their columns, that the model does not reject."""

    def keep(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out: list[bool] = []
            for at in range(0, len(texts), 256):
                part = [t if isinstance(t, str) else None for t in texts.iloc[at : at + 256]]
                out += [not rejected for _, _, rejected in model.predict(part)]
            yield pd.Series(out, dtype=bool)

    return docs.where(F.pandas_udf(keep, "boolean")(F.col("text").cast("string")))


def op4_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from documents outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    predicted = predict(docs, train(docs, ~held_out))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


QUERIES = {"op4_lang_id": op4_lang_id}
ORACLES: dict[str, str] = {}
