"""Periodic runs of words: found from multi-scale minimizers, and collapsed to one period.

A run is a stretch of words with smallest period q and at least ``exponent`` periods, which no
neighbouring word extends. For every scale k = 16, 32, ... the minimum of k-word strings is
taken in all windows of k / 2 strings. Inside a run of a period q in (k/2, k] two windows that
stand q words apart hold the same strings, so their minima stand q apart, too. A k-word string
occurs once a period only, hence neighbours among equal minima are such a pair: it seeds the
run and is extended word by word in both directions. Shorter periods are found by comparing
the words with those 1, 2, ... ``SHORT`` places on.

Why the windows fit: both windows together cover k/2 + k - 1 + q < q + 2q + q = 4q words, so a
run of four periods always holds them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postlens.llm.common import read_table
from postlens.llm.shingles import mix

# Periods up to SHORT (half the first scale) are looked for by direct comparison.
SHORT = 8
EXPONENT = 4
LEAST_WORDS = 6
# Documents are looked through together until they have this many words.
FLUSH_WORDS = 400_000
# Texts are cut into words in pieces of this many bytes.
PIECE = 1 << 22

_U = np.uint64
_FACTOR = _U(0x9E3779B97F4A7C15)
_MOST = _U(0xFFFFFFFFFFFFFFFF)
_BLANKS = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
SCHEMA = f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", _RUN), ("collapsed", pa.string())])


def split_words(data: bytes) -> Iterator[list[bytes]]:
    """The words between ASCII white space, piece by piece."""
    at = 0
    while at < len(data):
        stop = at + PIECE
        if stop < len(data):
            last = max(data.rfind(c, at, stop) for c in _BLANKS)
            if last < 0:  # a word longer than the piece
                ends = [x for c in _BLANKS if (x := data.find(c, stop)) >= 0]
                last = min(ends, default=len(data))
            stop = last
        # bytes.split() separates at exactly these six bytes.
        yield data[at:stop].split()
        at = stop + 1


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, from minima to and from the edges of blocks."""
    n = len(values)
    blocks = np.append(values, np.full(-n % width, _MOST, np.uint64)).reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], upto[width - 1 : n])


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places of the window minima, in order; the first of equal ones counts."""
    bits = _U(max(1, int(len(hashes)).bit_length()))
    places = np.arange(len(hashes), dtype=np.uint64)
    packed = window_minima((hashes >> bits) << bits | places, width)
    at = (packed & ((_U(1) << bits) - _U(1))).astype(np.int64)
    return at[np.r_[True, at[1:] != at[:-1]]]


def _agreeing(ids: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The stretch around ``at`` in which words equal those ``lag`` places on."""
    low, high, step = at, at, 64
    while high < len(ids) - lag:
        part = ids[high : high + step]
        on = ids[high + lag : high + lag + step]
        differ = np.flatnonzero(part[: len(on)] != on)
        if len(differ):
            high += int(differ[0])
            break
        high += len(on)
        step *= 2
    step = 64
    while low > 0:
        first = max(0, low - step)
        differ = np.flatnonzero(ids[first:low] != ids[first + lag : low + lag])
        if len(differ):
            low = first + int(differ[-1]) + 1
            break
        low = first
        step *= 2
    return low, high


def _lag_scan(ids: np.ndarray, lag: int, least: int) -> list[tuple[int, int, int]]:
    if len(ids) <= lag:
        return []
    same = (ids[lag:] == ids[:-lag]).view(np.int8)
    edges = np.flatnonzero(np.diff(same, prepend=0, append=0))
    start, length = edges[0::2], edges[1::2] - edges[0::2] + lag
    found = length >= least
    return [(s, n, lag) for s, n in zip(start[found].tolist(), length[found].tolist())]


def find_stretches(
    ids: np.ndarray, bounds: np.ndarray, exponent: int = EXPONENT, least_words: int = LEAST_WORDS
) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs, by start and period.

    ``ids`` holds the words of several documents, each followed by a negative number of its
    own, which equals nothing and so ends every stretch; ``bounds`` holds their starts and the end.
    """
    if exponent < EXPONENT:
        raise ValueError(f"runs of less than {EXPONENT} periods may hold no pair of windows")
    found: dict[tuple[int, int], int] = {}

    def add(start: int, length: int, period: int) -> None:
        # A stretch that also has a shorter period has been found with that one before.
        if length >= max(least_words, exponent * period):
            found.setdefault((start, length), period)

    for lag in range(1, SHORT + 1):
        for run in _lag_scan(ids, lag, max(least_words, exponent * lag)):
            add(*run)
    sizes = np.diff(bounds) - 1
    k, live = 1, np.arange(len(sizes))
    hashes, origin = mix(ids.astype(np.uint64) * _FACTOR + _FACTOR), np.arange(len(ids))
    while True:
        # Texts too short for a run of this scale are left out from here on.
        enough = sizes[live] >= EXPONENT * (max(SHORT, k) + 1)
        if not enough.any():
            break
        if not enough.all():
            keep = np.repeat(enough, sizes[live] + 1)
            hashes, origin, live = hashes[keep], origin[keep], live[enough]
        # Strings of twice the words; those over the end of a text hold its own number.
        hashes = mix(hashes * _FACTOR + np.roll(hashes, -k))
        k *= 2
        if k <= SHORT:
            continue
        seeds = minimizers(hashes, k // 2)
        order = seeds[np.argsort(hashes[seeds], kind="stable")]
        lag = order[1:] - order[:-1]
        pair = (hashes[order[1:]] == hashes[order[:-1]]) & (lag > k // 2) & (lag <= k)
        at, lag = origin[order[:-1][pair]], lag[pair]
        reached: dict[int, int] = {}
        for i in np.lexsort((at, lag)).tolist():
            place, period = int(at[i]), int(lag[i])
            if place >= reached.get(period, 0) and ids[place] == ids[place + period]:
                low, high = _agreeing(ids, place, period)
                reached[period] = high
                add(low, high - low + period, period)
    return sorted((s, n, q) for (s, n), q in found.items())


class _Group:
    """Some documents whose words are numbered together."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.ids: list[np.ndarray] = []
        self.docs: list[int | None] = []
        self.bounds = [0]

    def add(self, doc_id: int | None, data: bytes | None) -> None:
        number = self.numbers
        size = 0
        for words in split_words(data or b""):
            self.ids.append(np.array([number.setdefault(w, len(number)) for w in words], np.int64))
            size += len(words)
        self.docs.append(doc_id)
        self.ids.append(np.array([-len(self.docs)], np.int64))
        self.bounds.append(self.bounds[-1] + size + 1)

    def rows(self, exponent: int, least_words: int) -> pa.RecordBatch:
        ids = np.concatenate(self.ids)
        bounds = np.array(self.bounds)
        runs = find_stretches(ids, bounds, exponent, least_words)
        change = np.zeros(len(ids) + 1, np.int64)
        of_doc: list[list[dict]] = [[] for _ in self.docs]
        for (start, length, period), doc in zip(
            runs, (np.searchsorted(bounds, [r[0] for r in runs], "right") - 1).tolist()
        ):
            change[start + period] += 1
            change[start + length] -= 1
            of_doc[doc].append({"start": start - self.bounds[doc], "length": length, "period": period})
        keep = np.cumsum(change[:-1]) == 0
        names = list(self.numbers)
        texts = []
        for low, high in zip(self.bounds, self.bounds[1:]):
            kept = ids[low : high - 1][keep[low : high - 1]]
            texts.append(b" ".join(map(names.__getitem__, kept.tolist())).decode("utf-8", "replace"))
        n_words = (np.diff(bounds) - 1).tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array(x, f.type) for x, f in zip((self.docs, n_words, of_doc, texts), _ARROW)], schema=_ARROW
        )


def find_runs(docs: DataFrame, exponent: int = EXPONENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``[doc_id, n_words, runs, collapsed]``, one row per row of ``docs``.

    ``runs`` holds ``(start, length, period)``, counted in words from 0, by start and period: all
    runs of at least ``exponent`` (4 or more) periods and ``least_words`` words. ``collapsed`` is
    the text of the words that no run holds after its first period, joined by single spaces.

    Words stand between ASCII white space and must be equal byte by byte. Whole texts are read;
    null and empty texts have no words and no runs. Rows that repeat an id, and rows without
    one, are documents of their own. Other columns are not read. Nothing is shuffled; a task
    holds ``FLUSH_WORDS`` words, or one longer text, in arrays of about 60 bytes a word.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id_"), F.col("text").cast("string").cast("binary").alias("text_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = _Group()
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                group.add(doc_id, data.as_py())
                if group.bounds[-1] >= FLUSH_WORDS:
                    yield group.rows(exponent, least_words)
                    group = _Group()
        if group.docs:
            yield group.rows(exponent, least_words)

    return rows.mapInArrow(run, SCHEMA)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``[doc_id, text]`` with a repeated part in every tenth document, as the query's contract states.

    With h the crc32 of the id as text (null: empty), g = h div 10 and n words: where h % 10 = 0, the
    words from a = g % n on are replaced by repeats of the first 1 + (n - a) div (3 + g % 8) of them.
    """
    blanks = "[\\x20\\x09-\\x0D]+"
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    words = F.filter(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), blanks), lambda w: w != "")
    marked = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.when(h % 10 == 0, words).alias("w_"),
        F.floor(h / 10).alias("g_"),
    )
    sized = marked.withColumn("n_", F.size("w_")).withColumn("a_", F.expr("if(n_ > 0, cast(g_ % n_ as int), 0)"))
    sized = sized.withColumn("p_", F.expr("cast(1 + (n_ - a_) div (3 + g_ % 8) as int)"))
    planted = F.expr(
        "array_join(concat(slice(w_, 1, a_), slice(flatten(array_repeat(slice(w_, a_ + 1, p_),"
        " cast((n_ - a_ + p_ - 1) div p_ as int))), 1, n_ - a_)), ' ')"
    )
    return sized.select("doc_id", F.when(F.col("n_") > 0, planted).otherwise(F.col("text")).alias("text"))


def _digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the number of its runs, its longest run and digests of runs and collapsed text."""
    found = find_runs(with_planted_runs(read_table(spark, sf_dir, "documents")))
    # The longest; then the first, then that of the smaller period.
    best = F.array_max(F.expr("transform(runs, r -> struct(r.length as n, -r.start as s, -r.period as q))"))
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.q")).alias("period"),
        F.expr("(1000 * best.n) div (-best.q)").alias("exponent_milli"),
        _digest(lines).alias("runs_sha256"),
        _digest(F.col("collapsed")).alias("collapsed_sha256"),
        "n_words",
    )


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
ORACLES: dict[str, str] = {}
