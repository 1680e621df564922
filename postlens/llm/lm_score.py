"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised to levels of a geometric scale. The filter holds
an n-gram once for every level up to its own, so its level is found by probing level after
level until one is missing. Its size follows the corpus, so no process holds it whole: n-grams
are dealt into segments by their hash, an n-gram's bits all lie in its segment, and the task
that has a segment's counts fills the segment's part of the filter and answers for it.
The probability of a word is a mixture of the word's own and that after the word before it;
the mixture weights are fitted on all training documents, each without its own counts; tasks add
up the likelihood of every weight on trial, and only these sums come together.

Texts are cut once, into pieces of many documents. A piece sends its different n-grams to their
segments, with how often its training documents hold them; the same arrays are its questions.
Levels come back in the order in which the n-grams were sent, a byte each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postlens.llm.common import discard, fold, read_table, staged
from postlens.llm.shingles import mix, word_hashes

BASE = 1.5  # ratio of the counts of two levels
PROBES = 4
BITS_PER_ENTRY = 10
MIN_BITS = 1 << 20
FREQUENT_WORDS = 1 << 17  # words whose exact counts, for base scores, are broadcast, 16 bytes each
SEGMENT_BYTES = 4 << 20  # of text for each segment of n-grams
MIN_SEGMENTS = 16
HOME_SEGMENTS = 4  # at most so many segments in a row go to one task
FLUSH_TOKENS = 1_500_000  # of a piece
FIT_TOKENS = 200_000  # looked at together in the fit
MIXES = np.array([0.0, 0.01, 0.03, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95])
HISTORY_LEVELS = 32

_U = np.uint64
END = _U(xxhash.xxh3_64_intdigest(b""))  # the end counts as a token; no word is empty


def pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * _U(0x9E3779B97F4A7C15) + mix(word + _U(0x632BE59BD9B4E019)))


def token_hashes(text: str | None) -> np.ndarray:
    """All words, A-Z lower-cased, then the end."""
    found = word_hashes(text)
    out = np.empty(len(found) + 1, np.uint64)
    out[:-1] = found
    out[-1] = END
    return out


def with_histories(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The token before each token; the end stands before the first one of a text.

    The end is a text's last token, so anything known of tokens is moved in the same way.
    """
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.r_[0, ends[:-1]]] = tokens[ends - 1]
    return before


def level(counts: np.ndarray) -> np.ndarray:
    """Level of a count, from 1."""
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(BASE) + 1e-9).astype(np.int64)


# The counts that a level stands for: the middle of those it holds.
_MEANS = np.array([0.0] + [
    float(np.mean([np.ceil(BASE ** (i - 1) - 1e-9), max(np.ceil(BASE ** (i - 1) - 1e-9), np.ceil(BASE**i - 1e-9) - 1)]))
    for i in range(1, 120)
])


def entry_marks(hashes: np.ndarray, step: int, segment_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the entries of one level: the 64-bit word inside their segment, and the bits in it."""
    h = mix(hashes + _U(step * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
    bits = np.zeros(len(h), np.uint64)
    for probe in range(PROBES):
        bits |= _U(1) << (h >> _U(6 * probe) & _U(63))
    return (h >> _U(32)) * _U(segment_words) >> _U(32), bits


@dataclass
class Filter:
    """Bits of the segments from ``first`` on; ``segments`` counts those of the whole filter."""

    words: np.ndarray  # 64-bit words; all bits of an entry are in one of them
    segments: int
    first: int = 0
    width: int = 0  # 64-bit words of a segment; 0 where all segments are held

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """Level of each n-gram; 0 if it is not held. Never too low; seldom too high."""
        distinct, back = np.unique(hashes, return_inverse=True)
        return self.probe(distinct)[back]

    def _marks(self, hashes: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        width = self.width or len(self.words) // self.segments
        word, bits = entry_marks(hashes, step, width)
        return (hashes % _U(self.segments) - _U(self.first)) * _U(width) + word, bits

    def probe(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int64)
        active, rest, step = np.arange(len(hashes)), hashes, 0
        while len(active) and step < len(_MEANS) - 1:
            step += 1
            word, bits = self._marks(rest, step)
            held = np.flatnonzero(self.words[word] & bits == bits)
            active, rest = active[held], rest[held]
            out[active] = step
        return out

    def fill(self, hashes: np.ndarray, levels: np.ndarray) -> None:
        step = 0
        while len(hashes := hashes[more := levels > step]):
            levels, step = levels[more], step + 1
            np.bitwise_or.at(self.words, *self._marks(hashes, step))

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        return _MEANS[self.levels(hashes)]


def _staged_alone(df: DataFrame, name: str) -> DataFrame:
    """``staged``, for what only this write reads: Spark deletes its shuffles at the write's end."""
    conf, setting = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(setting, None)
    conf.set(setting, "true")
    try:
        return staged(df, name)
    finally:
        conf.unset(setting) if before is None else conf.set(setting, before)


# --- packed arrays ---------------------------------------------------------------------

def _pack(values: np.ndarray) -> bytes:
    """Whole numbers as their lowest bytes, then their second lowest, as far as one needs them."""
    values = np.ascontiguousarray(values, "<u8")
    used = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([used]) + values.view(np.uint8).reshape(-1, 8)[:, :used].T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8)[1:].reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.reshape(-1).view("<u8")


def _pack_sorted(values: np.ndarray) -> bytes:
    return values[:1].astype("<u8").tobytes() + _pack(np.diff(values)) if len(values) else b""


def _unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    return np.cumsum(np.r_[np.frombuffer(data, "<u8", 1), _unpack(data[8:])], dtype=np.uint64)


def _squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unsqueeze(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


# --- places: the order of n-grams by segment, then by hash --------------------------------

def _segment_places(segments: int) -> np.ndarray:
    """The first place of each segment. Hashes of a segment agree in hash % segments."""
    whole, over = divmod(1 << 64, segments)
    n = np.arange(segments, dtype=np.uint64)
    return n * _U(whole & (1 << 64) - 1) + np.minimum(n, _U(over))


def places_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    """Every hash has a place of its own."""
    return _segment_places(segments)[(hashes % _U(segments)).astype(np.int64)] + hashes // _U(segments)


def hashes_at(places: np.ndarray, segments: int) -> np.ndarray:
    starts = _segment_places(segments)
    segment = np.searchsorted(starts, places, side="right") - 1
    return (places - starts[segment]) * _U(segments) + segment.astype(np.uint64)


def home_segments(segments: int) -> int:
    """How many segments in a row share a task."""
    return max(1, min(HOME_SEGMENTS, segments // 64))


# --- pieces ----------------------------------------------------------------------------

@dataclass
class Piece:
    """Documents with their tokens: the number of each in ``words``, the piece's different ones."""

    may: np.ndarray  # of documents: whether their counts are learned
    ends: np.ndarray
    words: np.ndarray
    tokens: np.ndarray

    @classmethod
    def of(cls, row) -> Piece:
        return cls(
            np.frombuffer(row.may, np.bool_), np.frombuffer(row.ends, np.int64), np.frombuffer(row.words, np.uint64),
            _unpack(_unsqueeze(row.tokens)).astype(np.int64),
        )

    def lengths(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)

    def pairs(self) -> np.ndarray:
        """The pair that ends at each token, as a number."""
        return with_histories(self.tokens, self.ends) * len(self.words) + self.tokens

    def pair_places(self, pairs: np.ndarray, segments: int) -> np.ndarray:
        before, word = np.divmod(pairs, len(self.words))
        return places_of(pair_hash(self.words[before], self.words[word]), segments)


_PIECE = "piece long, ids binary, nulls binary, may binary, ends binary, words binary, tokens binary"


def cut_texts(rows: DataFrame) -> DataFrame:
    """Pieces of the rows ``[id_, text_, may_]`` of each task, one row for some ``FLUSH_TOKENS`` tokens."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, n = TaskContext.get().partitionId(), 0
        held, ids, may, size = [], [], [], 0

        def piece() -> pd.DataFrame:
            numbers, words = pd.factorize(np.concatenate(held))  # numbered as they come: frequent ones are low
            return pd.DataFrame([{
                "piece": task << 32 | n, "ids": np.array([int(i or 0) for i in ids], np.int64).tobytes(),
                "nulls": np.array([i is None for i in ids]).tobytes(), "may": np.array(may, np.bool_).tobytes(),
                "ends": np.cumsum([len(t) for t in held]).tobytes(), "words": words.tobytes(),
                "tokens": _squeeze(_pack(numbers)),
            }])

        for batch in batches:
            for i, text, learned in zip(batch["id_"], batch["text_"], batch["may_"]):
                held.append(token_hashes(text if isinstance(text, str) else None))
                ids.append(i if isinstance(i, str) else None)
                may.append(learned)
                size += len(held[-1])
                if size >= FLUSH_TOKENS:
                    yield piece()
                    n += 1
                    held, ids, may, size = [], [], [], 0
        if held:
            yield piece()

    return rows.select("id_", "text_", "may_").mapInPandas(cut, _PIECE)


# --- counting --------------------------------------------------------------------------

_ASKED = "home long, piece long, words binary, pairs binary, counts binary"


def ask_ngrams(pieces: DataFrame, segments: int) -> DataFrame:
    """What each piece tells and asks each home: places of its words and pairs, and how often the
    documents to learn from hold them, which may be never."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bounds = _segment_places(segments)[:: home_segments(segments)]
        for batch in batches:
            for row in batch.itertuples(index=False):
                piece = Piece.of(row)
                may = np.repeat(piece.may, piece.lengths())
                words, counts = places_of(piece.words, segments), np.bincount(piece.tokens[may], minlength=len(piece.words))
                by = np.argsort(words)
                words, counts = words[by], counts[by]
                both, times = np.unique(piece.pairs() * 2 + may, return_counts=True)
                new = np.flatnonzero(np.diff(both >> 1, prepend=-1))
                pairs, pair_counts = piece.pair_places(both[new] >> 1, segments), np.add.reduceat(times * (both & 1), new)
                by = np.argsort(pairs)
                pairs, pair_counts = pairs[by], pair_counts[by]
                cuts = np.r_[np.searchsorted(words, bounds), len(words)]
                pair_cuts = np.r_[np.searchsorted(pairs, bounds), len(pairs)]
                out = [
                    (home, row.piece, _pack_sorted(words[a:b]), _pack_sorted(pairs[c:d]), _pack(np.r_[counts[a:b], pair_counts[c:d]]))
                    for home, (a, b, c, d) in enumerate(zip(cuts, cuts[1:], pair_cuts, pair_cuts[1:])) if a < b or c < d
                ]
                yield pd.DataFrame(out, columns=["home", "piece", "words", "pairs", "counts"])

    return pieces.select("piece", "may", "ends", "words", "tokens").mapInPandas(ask, _ASKED)


def _summed(places: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different places in order, their sums, and where each entry went."""
    places, counts = np.concatenate(places), np.concatenate(counts)
    by = np.argsort(places, kind="stable")
    ordered = places[by]
    new = np.ones(len(ordered), np.bool_)
    new[1:] = ordered[1:] != ordered[:-1]
    at = np.empty(len(ordered), np.int64)
    at[by] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    return ordered[starts], np.add.reduceat(counts[by], starts) if len(starts) else counts, at


def _steps(at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Differences inside each of the rising runs of ``sizes`` numbers; a run's first number stays."""
    out = np.diff(at, prepend=0)
    starts = np.r_[0, np.cumsum(sizes)[:-1]][sizes > 0]
    out[starts] = at[starts]
    return out


def sum_ngrams(asked: DataFrame, segments: int) -> DataFrame:
    """``[home, words, pairs, counts, tokens, types, entries]`` summed over all that was told, a
    row for each home; ``[askers, sizes, word_steps, pair_steps]`` say what was asked by whom.

    What is told as piece -1 asks nothing.
    """

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        words, pairs = ([_unpack_sorted(x) for x in frame[c]] for c in ("words", "pairs"))
        counts = [_unpack(x).astype(np.int64) for x in frame["counts"]]
        asks = frame["piece"].to_numpy() >= 0
        sizes, out = [], {"home": int(frame["home"].iloc[0]), "askers": frame["piece"].to_numpy()[asks].tobytes()}
        sums = []
        for name, steps, told, times in (
            ("words", "word_steps", words, [c[: len(w)] for c, w in zip(counts, words)]),
            ("pairs", "pair_steps", pairs, [c[len(w) :] for c, w in zip(counts, words)]),
        ):
            size = np.array([len(x) for x in told], np.int64)
            different, summed, at = _summed(told, times)
            size, at = size[asks], at[np.repeat(asks, size)]
            sizes.append(size)
            sums.append(summed)
            out |= {name: _pack_sorted(different), steps: _pack(_steps(at, size))}
        both = np.concatenate(sums)
        return pd.DataFrame([out | {
            "sizes": np.concatenate(sizes).tobytes(), "counts": _pack(both), "tokens": int(sums[0].sum()),
            "types": int((sums[0] > 0).sum()), "entries": int(level(both[both > 0]).sum()),
        }])

    homes = -(-segments // home_segments(segments))
    schema = "home long, words binary, pairs binary, counts binary, askers binary, sizes binary, word_steps binary, pair_steps binary"
    # Twice as many tasks as homes, so that few homes meet in one and what a task reads does not
    # grow with the corpus.
    return asked.repartition(2 * homes, "home").groupBy("home").applyInPandas(add, f"{schema}, tokens long, types long, entries long")


def count_ngrams(texts: DataFrame, segments: int) -> DataFrame:
    """The rows of ``sum_ngrams`` for words and pairs of all texts ``[text_]``."""
    rows = texts.select(F.lit(None).cast("string").alias("id_"), "text_", F.lit(True).alias("may_"))
    return sum_ngrams(ask_ngrams(cut_texts(rows), segments), segments)


def _home_filter(row, segments: int, width: int) -> tuple[Filter, np.ndarray, np.ndarray, np.ndarray]:
    """The part of the filter of a home, and the hashes of its words, of its pairs, and the counts of both."""
    words, pairs = (hashes_at(_unpack_sorted(x), segments) for x in (row.words, row.pairs))
    counts = _unpack(row.counts).astype(np.int64)
    run = home_segments(segments)
    held = Filter(np.zeros(run * width, np.uint64), segments, row.home * run, width)
    held.fill(np.r_[words, pairs], np.where(counts > 0, level(counts), 0))
    return held, words, pairs, counts


def segment_width(segments: int, entries: int) -> int:
    """64-bit words of a segment. The filter's size follows the number of entries, so that the
    share of false answers does not rise with the corpus."""
    return -(-max(MIN_BITS, BITS_PER_ENTRY * entries) // segments // 64)


def build_filter(counted: DataFrame, segments: int, entries: int) -> Filter:
    """The filter over all counted n-grams, in this process, for models that are small enough to be
    looked at whole. Scores do without it: each home fills its own part and answers from it."""
    width, run = segment_width(segments, entries), home_segments(segments)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield pd.DataFrame([{"home": row.home, "bits": _home_filter(row, segments, width)[0].words.tobytes()}])

    whole = np.zeros(segments * width, np.uint64)
    for row in counted.select("home", "words", "pairs", "counts").mapInPandas(fill, "home long, bits binary").toLocalIterator():
        part = whole[row["home"] * run * width : (row["home"] + 1) * run * width]
        part[:] = np.frombuffer(row["bits"], np.uint64)[: len(part)]
    return Filter(whole, segments)


def frequent_words(counted: DataFrame, segments: int, limit: int = FREQUENT_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in order, and counts of the most frequent words.

    Each home offers its own most frequent ones, so what is gathered has a fixed bound.
    """

    def top(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                hashes = hashes_at(_unpack_sorted(row.words), segments)
                counts = _unpack(row.counts)[: len(hashes)].astype(np.int64)
                best = np.argsort(-counts, kind="stable")[:each]
                best = best[counts[best] > 0]
                yield pd.DataFrame([{"hashes": hashes[best].tobytes(), "counts": counts[best].tobytes()}])

    words = counted.select("words", "counts")
    each = max(1, limit // max(1, words.count()))
    rows = words.mapInPandas(top, "hashes binary, counts binary").collect()
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in rows])
    counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows])
    by = np.argsort(hashes)
    return hashes[by], counts[by]


def exact_counts(hashes: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Counts of frequent words; -1 for all others."""
    if not len(frequent[0]):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(frequent[0], hashes), len(frequent[0]) - 1)
    return np.where(frequent[0][at] == hashes, frequent[1][at], -1)


# --- scoring ---------------------------------------------------------------------------

@dataclass
class Model:
    tokens: int  # N
    types: int  # V
    segments: int
    entries: int
    counted: DataFrame = field(repr=False)
    frequent: tuple[np.ndarray, np.ndarray] = field(repr=False)
    mixes: np.ndarray  # by level of the word before
    docs: DataFrame = field(repr=False)  # those it was made of, held-out ones included
    found: DataFrame = field(repr=False)  # and what ``look_up`` found for them

    @cached_property
    def filter(self) -> Filter:
        return build_filter(self.counted, self.segments, self.entries)

    def parts(self, tokens: np.ndarray, ends: np.ndarray, own: bool = False):
        """Each word's own probability, that after the word before, and the level of the word
        before, all from the filter. With ``own`` the texts' own counts are taken off first.

        Gathers the whole filter, see ``build_filter``."""
        counts = self.filter.counts(tokens)
        before = with_histories(tokens, ends)
        before_counts = with_histories(counts, ends)
        pairs = pair_hash(before, tokens)
        pair_counts = self.filter.counts(pairs)
        if own:
            text = np.repeat(np.arange(len(ends), dtype=np.uint64), np.diff(np.r_[0, ends]))
            for values, hashes in ((counts, tokens), (pair_counts, pairs), (before_counts, before)):
                _, back, n = np.unique(mix(hashes + text * _U(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
                values -= n[back]
                np.maximum(values, 0, out=values)
        return _probabilities(counts, pair_counts, before_counts, self.tokens + self.types + 1)


def _probabilities(counts: np.ndarray, pair_counts: np.ndarray, before_counts: np.ndarray, total: int):
    single = (counts + 1) / total
    after = np.minimum(pair_counts / np.maximum(before_counts, 1), 1.0)
    step = np.minimum(level(np.maximum(before_counts, 1)), HISTORY_LEVELS - 1)
    return single, after, step


def _likely(piece: Piece, word_levels: np.ndarray, pair_levels: np.ndarray, pairs: np.ndarray, total: int) -> np.ndarray:
    """Log likelihood of the documents to learn from, each without its own counts, for every
    level of the word before and every mixture weight on trial. ``pairs`` are pairs by number."""
    out = np.zeros((HISTORY_LEVELS, len(MIXES)))
    first, lengths = 0, piece.lengths()
    while first < len(piece.ends):
        start = piece.ends[first] - lengths[first]
        last = max(first + 1, int(np.searchsorted(piece.ends, start + FIT_TOKENS, side="right")))
        here, ends = slice(start, piece.ends[last - 1]), piece.ends[first:last] - start
        text = np.repeat(np.arange(last - first), lengths[first:last])
        may = np.repeat(piece.may[first:last], lengths[first:last])
        own = []
        for numbers in (piece.tokens[here], pairs[here]):
            which, _ = pd.factorize(text * (int(numbers.max()) + 1) + numbers)
            own.append(np.bincount(which)[which])
        counts = np.maximum(_MEANS[word_levels[here]] - own[0], 0)
        pair_counts = np.maximum(_MEANS[pair_levels[here]] - own[1], 0)
        single, after, step = _probabilities(counts[may], pair_counts[may], with_histories(counts, ends)[may], total)
        for n, share in enumerate(MIXES):
            out[:, n] += np.bincount(step, np.log(share * after + (1 - share) * single), minlength=HISTORY_LEVELS)
        first = last
    return out


def look_up(pieces: DataFrame, counted: DataFrame, segments: int, entries: int, tokens: int, types: int, frequent, fit: bool) -> DataFrame:
    """What the model holds of each piece's tokens, one row each: ``[ids, nulls, ends, known, base,
    levels, likely]``.

    Homes answer with levels from their part of the filter, and with exact counts, which base
    scores need, of the words that are not frequent; the others are known everywhere.
    """
    width, total = segment_width(segments, entries), tokens + types + 1
    sent = pieces.sparkSession.sparkContext.broadcast(frequent)

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                held, words, pairs, counts = _home_filter(row, segments, width)
                levels = [held.probe(x).astype(np.uint8) for x in (words, pairs)]
                counts = np.where(exact_counts(words, sent.value) >= 0, 0, counts[: len(words)])
                askers, sizes = np.frombuffer(row.askers, np.int64), np.frombuffer(row.sizes, np.int64).reshape(2, -1)
                steps = [_unpack(x).astype(np.int64) for x in (row.word_steps, row.pair_steps)]
                cuts = [np.r_[0, np.cumsum(x)] for x in sizes]
                out = []
                for n, piece in enumerate(askers):
                    at, pair_at = (np.cumsum(s[c[n] : c[n + 1]]) for s, c in zip(steps, cuts))
                    out.append((piece, row.home, levels[0][at].tobytes(), levels[1][pair_at].tobytes(), _pack(counts[at])))
                if out:
                    yield pd.DataFrame(out, columns=["piece", "home", "words", "pairs", "counts"])

    def join(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame(columns=["ids", "nulls", "ends", "known", "base", "levels", "likely"])
        row = next(left.itertuples(index=False))
        piece, right = Piece.of(row), right.sort_values("home")
        starts = piece.ends - piece.lengths()

        def placed(answers: np.ndarray, places: np.ndarray) -> np.ndarray:
            if len(answers) != len(places):
                raise ValueError(f"{len(answers)} answers for {len(places)} questions")
            out = np.empty_like(answers)
            out[np.argsort(places)] = answers
            return out

        places = places_of(piece.words, segments)
        word_levels = placed(np.frombuffer(b"".join(right["words"]), np.uint8), places)
        counts = placed(np.concatenate([_unpack(x) for x in right["counts"]]).astype(np.int64), places)
        exact = exact_counts(piece.words, sent.value)
        exact = np.where(exact >= 0, exact, counts)
        known, base = (exact > 0).astype(np.int64), np.log10((exact + 1) / total)
        pairs, different = pd.factorize(piece.pairs())
        pair_levels = placed(np.frombuffer(b"".join(right["pairs"]), np.uint8), piece.pair_places(different, segments))
        word_levels, pair_levels = word_levels[piece.tokens], pair_levels[pairs]
        return pd.DataFrame([{
            "ids": row.ids, "nulls": row.nulls, "ends": row.ends,
            "known": np.add.reduceat(known[piece.tokens], starts).tobytes(), "base": np.add.reduceat(base[piece.tokens], starts).tobytes(),
            "levels": _squeeze(word_levels.tobytes() + pair_levels.tobytes()),
            "likely": _likely(piece, word_levels, pair_levels, pairs, total).reshape(-1) if fit else None,
        }])

    answers = counted.select("home", "words", "pairs", "counts", "askers", "sizes", "word_steps", "pair_steps").mapInPandas(
        answer, "piece long, home long, words binary, pairs binary, counts binary"
    )
    # As for homes; twice as many tasks as pieces, so that few pieces meet in one.
    tasks = max(1, 2 * pieces.count())
    left, right = (x.repartition(tasks, "piece").groupBy("piece") for x in (pieces, answers))
    return left.cogroup(right).applyInPandas(
        join, "ids binary, nulls binary, ends binary, known binary, base binary, levels binary, likely array<double>"
    )


def _rows(docs: DataFrame, may_learn: Column) -> DataFrame:
    # Ids as text, since a batch of numbers with a null becomes one of doubles.
    return docs.select(
        F.col("doc_id").cast("long").cast("string").alias("id_"), F.col("text").alias("text_"),
        F.coalesce(may_learn, F.lit(False)).alias("may_"),
    )


def train(docs: DataFrame, may_learn: Column) -> tuple[Model, DataFrame]:
    """The model, and the counts it was made of. Documents that may not be learned from are
    looked up along with the others, so that ``score`` has them."""
    rows = _rows(docs, may_learn)
    # Segments follow the corpus alone: an n-gram has the same bits on every cluster.
    size = rows.agg(F.sum(F.when(F.col("may_"), F.octet_length("text_")))).first()[0] or 0
    segments = max(MIN_SEGMENTS, -(-size // SEGMENT_BYTES))
    pieces = staged(cut_texts(rows), "lm-pieces")
    counted = _staged_alone(sum_ngrams(ask_ngrams(pieces, segments), segments), "ngrams")
    tokens, types, entries = (x or 0 for x in counted.agg(*(F.sum(c) for c in ("tokens", "types", "entries"))).first())
    frequent = frequent_words(counted, segments)
    found = _staged_alone(look_up(pieces, counted, segments, entries, tokens, types, frequent, fit=True), "lm-levels")
    discard(pieces)
    likely = np.zeros(HISTORY_LEVELS * len(MIXES))
    for r in found.select(F.posexplode("likely").alias("n", "likely")).groupBy("n").agg(F.sum("likely").alias("likely")).collect():
        likely[r["n"]] = r["likely"]
    # Rounded, as the order in which tasks are added up must not decide between equals.
    mixes = MIXES[np.argmax(np.round(likely.reshape(HISTORY_LEVELS, len(MIXES)), 6), axis=1)]
    return Model(tokens, types, segments, entries, counted, frequent, mixes, docs, found), counted


def score(docs: DataFrame, model: Model, counted: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_tokens, n_known, base_score, score.

    ``score`` takes all its counts from the filter, ``base_score`` exact ones. Null and empty
    texts are one token, the end. Ids may be null, ids and texts may repeat.
    """
    found, total, mixes = model.found, model.tokens + model.types + 1, model.mixes
    if docs is not model.docs:  # others ask for themselves
        pieces = staged(cut_texts(_rows(docs, F.lit(False))), "lm-pieces")
        told = counted.select("home", F.lit(-1).cast("long").alias("piece"), "words", "pairs", "counts")
        asked = sum_ngrams(ask_ngrams(pieces, model.segments).unionByName(told), model.segments)
        found = _staged_alone(
            look_up(pieces, asked, model.segments, model.entries, model.tokens, model.types, model.frequent, fit=False), "lm-levels"
        )
        discard(pieces)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ends = np.frombuffer(row.ends, np.int64)
                starts = np.r_[0, ends[:-1]]
                words, pairs = np.frombuffer(_unsqueeze(row.levels), np.uint8).reshape(2, -1).astype(np.int64)
                n, m = int(words.max()) + 1, int(pairs.max()) + 1
                # Levels are few: one logarithm for each combination.
                levels = np.arange(n * m * n)
                single, after, step = _probabilities(_MEANS[levels // (m * n)], _MEANS[levels // n % m], _MEANS[levels % n], total)
                share = mixes[step]
                table = np.log10(share * after + (1 - share) * single)
                scores = table[(words * m + pairs) * n + with_histories(words, ends)]
                yield pd.DataFrame({
                    "doc_id": pd.Series(np.frombuffer(row.ids, np.int64)).astype("Int64").mask(np.frombuffer(row.nulls, np.bool_)),
                    "n_tokens": ends - starts, "n_known": np.frombuffer(row.known, np.int64),
                    "base_score": np.frombuffer(row.base), "score": np.add.reduceat(scores, starts),
                })

    return found.select("ids", "nulls", "ends", "known", "base", "levels").mapInPandas(
        add, "doc_id long, n_tokens long, n_known long, base_score double, score double"
    )


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document; learned from documents outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 7) == 2
    model, counted = train(docs, ~held_out)
    return score(docs, model, counted).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


QUERIES = {"op7_lm_score": op7_lm_score}
ORACLES: dict[str, str] = {}
