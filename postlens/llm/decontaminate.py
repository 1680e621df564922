"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may differ from a document's passage in k = m // CHARS_PER_ERROR
edits. Cut into k + 1 pieces, at least one piece then occurs unchanged. The pieces of all
items are found in one pass over each text, and the surroundings of a hit are verified with
Myers' bit-parallel edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from postlens.llm.common import read_table

CHARS_PER_ERROR = 15
# Items are handed to the workers in blocks of at most this many characters, a pass each.
BLOCK_CHARS = 4_000_000

_TO_SPACE = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256)
)

LEAK_SCHEMA = "doc_id string, item_id long, distance int, start long, stop long"


def normalise(text: str | None) -> str:
    """Lower case; runs of ASCII characters other than letters and digits are one space."""
    if not text:
        return ""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_TO_SPACE).split()).decode("utf-8")


def split_pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of nearly equal length with their offsets."""
    n = errors + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """Least edit distance between ``pattern`` and any part of ``text``, and where that part ends.

    One bit per character of the pattern; None if every part needs more than ``most`` edits.
    """
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    every, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, distance = every, 0, m
    best, best_end = most + 1, -1
    for end, c in enumerate(text, 1):
        match = masks.get(c, 0)
        vertical = match | minus
        horizontal = (((match & plus) + plus) ^ plus) | match
        h_plus = minus | ~(horizontal | plus) & every
        h_minus = plus & horizontal
        if h_plus & top:
            distance += 1
        elif h_minus & top:
            distance -= 1
        h_plus = h_plus << 1 & every  # a part may start anywhere: nothing is carried in
        h_minus = h_minus << 1 & every
        plus = h_minus | ~(vertical | h_plus) & every
        minus = h_plus & vertical
        if distance < best:
            best, best_end = distance, end
            if best == 0:
                break
    return (best, best_end) if best <= most else None


class ItemIndex:
    """The pieces of a block of items in one Aho-Corasick automaton."""

    def __init__(self, items: list[tuple[int, str]], chars_per_error: int):
        import ahocorasick

        self.items = items
        self.errors = [len(text) // chars_per_error for _, text in items]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text) in enumerate(items):
            for at, piece in split_pieces(text, self.errors[n]):
                pieces.setdefault(piece, []).append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        if pieces:
            self.automaton.make_automaton()

    def leaks(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, stop) of the best passage of every item within its budget."""
        if not self.items or not text:
            return []
        windows: dict[int, list[tuple[int, int]]] = {}
        for end, (size, places) in self.automaton.iter(text):
            for n, at in places:
                start = end + 1 - size - at
                k, m = self.errors[n], len(self.items[n][1])
                # Edits before the piece move its start by k at most, in both directions.
                low, high = max(0, start - k), min(len(text), start + m + k)
                spans = windows.setdefault(n, [])
                if spans and low <= spans[-1][1]:
                    spans[-1] = (min(spans[-1][0], low), max(spans[-1][1], high))
                else:
                    spans.append((low, high))
        out = []
        for n, spans in windows.items():
            item_id, item = self.items[n]
            best = None
            for low, high in spans:
                exact = text.find(item, low, high)
                if exact >= 0:
                    best = (0, exact + len(item))
                    break
                if high - low >= len(item) - self.errors[n]:
                    found = myers(item, text[low:high], self.errors[n] if best is None else best[0] - 1)
                    if found:
                        best = (found[0], low + found[1])
            if best:
                out.append((item_id, best[0], max(0, best[1] - len(item)), best[1]))
        return out


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items as (id, normalised text), in blocks of bounded size, one on the driver at a time."""
    held, size = [], 0
    rows = items.select(F.col("item_id").cast("long").alias("id_"), F.col("text").alias("text_")).where(
        "text_ is not null"
    ).distinct().orderBy("id_", "text_")
    for row in rows.toLocalIterator():
        text = normalise(row["text_"])
        if text:
            held.append((row["id_"], text))
            size += len(text)
        if size >= BLOCK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def find_leaks(docs: DataFrame, items: DataFrame, chars_per_error: int = CHARS_PER_ERROR) -> DataFrame:
    """``[doc_id, item_id, distance, start, stop]``: one row per document row and item that it holds within the item's budget.

    ``distance`` is the least number of edits, ``start`` and ``stop`` the place in the
    normalised text (start as if there were no edits). Whole texts are searched; null and empty
    texts and items match nothing; items of fewer than ``chars_per_error`` characters match
    unchanged only. Repeated documents give repeated rows; an item repeated with other text
    counts once per text and is reported with its least distance. Items without an id are
    searched like others; ``item_id`` is null for them, as if they shared an id.
    """
    # Ids as text, since a batch of numbers with a null becomes one of doubles.
    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("id_"), F.col("text").alias("text_"))
    found = None
    for block in _blocks(items):
        part = rows.mapInPandas(_find_in_block(block, chars_per_error), LEAK_SCHEMA)
        found = part if found is None else found.unionByName(part)
    found = docs.sparkSession.createDataFrame([], LEAK_SCHEMA) if found is None else found
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def _find_in_block(block: list[tuple[int, str]], chars_per_error: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = ItemIndex(block, chars_per_error)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["id_"], batch["text_"]):
                least: dict[int, tuple] = {}
                for leak in index.leaks(normalise(text if isinstance(text, str) else None)):
                    least[leak[0]] = min(leak, least.get(leak[0], leak), key=lambda x: x[1:])
                out += [(doc_id, *leak) for leak in least.values()]
            frame = pd.DataFrame(out, columns=["doc_id", "item_id", "distance", "start", "stop"])
            # Else numbers beside a null become doubles.
            yield frame.assign(item_id=pd.array([x[1] for x in out], dtype="Int64"))

    return run


def decontaminate(docs: DataFrame, items: DataFrame, chars_per_error: int = CHARS_PER_ERROR) -> DataFrame:
    """The documents, with all their columns, that hold no item. Texts are searched in place."""
    kept = docs
    for block in _blocks(items):
        kept = kept.where(F.pandas_udf(_holds_no_item(block, chars_per_error), "boolean")(F.col("text").cast("string")))
    return kept


def _holds_no_item(block: list[tuple[int, str]], chars_per_error: int):
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = ItemIndex(block, chars_per_error)
        for texts in batches:
            yield pd.Series([not index.leaks(normalise(t if isinstance(t, str) else None)) for t in texts], dtype=bool)

    return clean


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair that leaks."""
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {"op6_decontaminate": op6_decontaminate}
ORACLES: dict[str, str] = {}
