"""Packing documents into sequences with a grouping genetic algorithm.

Texts are tokenised and cut into pieces of at most one sequence. Pieces are dealt into shards
of about a thousand; every shard is solved by several islands, each a population in a task of
its own. Crossover puts well-filled bins of one parent into another, removes the bins that
now hold a piece twice, and fits the displaced pieces best-first. After each round an island
sends its elite solution to the next one. Bins that stay too empty are taken apart, and their
pieces are packed again across shards.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from postlens.llm.common import partitions, read_table, staged

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"

SHARD_PIECES = (1000, 250)  # by level: first all pieces, then those of bins left too empty
ISLANDS = 3
ROUNDS = 3
POPULATION = 12
GENERATIONS = 200  # islands stop before where no solution can have fewer bins
FULL_SHARE = 0.985  # bins filled less than this are taken apart after the first level

BATCH_BYTES = 4_000_000  # texts encoded at a time; a longer one alone

_MAX_WORDS, _MAX_RUNS = 250_000, 250_000
_IDS = [struct.Struct(f"<{n}I") for n in range(16)]
# Words of these characters need no normalisation but lower case. The pattern by
# which the tokenizer cuts a word into runs, for these characters.
_PLAIN_WORD = re.compile(r"(?!.*<\|)[!-~À-ÖØ-öø-ÿ]+")
_RUN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+")

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _byte_symbols() -> dict[int, str]:
    """The table by which byte-level tokenizers write bytes: printable ones as themselves, the
    others as the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class WordEncoder:
    """Token ids of texts as little-endian unsigned 32-bit integers, word by word.

    Right for tokenizers that drop white space and never join across it: then the ids of a
    text are those of its words in order. The different words of some texts are encoded once
    and put back in their places; frequent ones are kept. Plain words go to the tokenizer's
    model in runs, if that gives the same ids on a trial; all others go through the whole
    tokenizer. With ``by_word=False`` whole texts do.
    """

    def __init__(self, path: str | None = None, by_word: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(str(path))
        self.model = self.tokenizer.model
        self.by_word = by_word
        self.known: dict[str, bytes] = {"": b""}
        self.runs: dict[str, bytes] = {}
        self.symbols = str.maketrans({chr(b): s for b, s in _byte_symbols().items()})
        trial = ["the", "Überall", "naïve", "tiontionhethereré", "ß", "Q", "It's", "x''d", "a10b--?!c", "(é7&&&", "'S9", "<a>|"]
        self.direct = all(self._plain(w) == self._encode(w) for w in trial)
        self.runs = {}

    def _encode(self, text: str) -> bytes:
        got = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.asarray(got[0].ids, dtype="<u4").tobytes()

    def _run(self, run: str) -> bytes:
        """Ids of a run of plain characters that the tokenizer does not cut."""
        ids = self.runs.get(run)
        if ids is None:
            symbols = run if run.isascii() else run.encode().decode("latin-1").translate(self.symbols)
            found = [t.id for t in self.model.tokenize(symbols)]
            ids = _IDS[len(found)].pack(*found) if len(found) < len(_IDS) else struct.pack(f"<{len(found)}I", *found)
            if len(self.runs) < _MAX_RUNS:
                self.runs[run] = ids
        return ids

    def _plain(self, word: str) -> bytes:
        return b"".join(map(self._run, _RUN.findall(word.lower())))

    def _word(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            ids = self._plain(word) if self.direct and _PLAIN_WORD.fullmatch(word) else self._encode(word)
            if len(self.known) < _MAX_WORDS:
                self.known[word] = ids
        return ids

    def ids_of(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of every text (null: none)."""
        if not self.by_word:
            return [np.frombuffer(self._encode(t or ""), "<u4") for t in texts.to_pylist()]
        # Any white space within these words is left to the tokenizer.
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = lists.flatten().dictionary_encode()
        found = [self._word(w) for w in words.dictionary.to_numpy(zero_copy_only=False)]
        ids = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        which = words.indices.to_numpy(zero_copy_only=False)
        size = sizes[which]
        ends = np.cumsum(size)
        first = (np.cumsum(sizes) - sizes)[which]
        held = ids[np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.r_[0, ends][np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]]
        return [held[a:b] for a, b in zip(bounds, bounds[1:])]

    def ids(self, text: str) -> bytes:
        return self.ids_of(pa.array([text], pa.string()))[0].tobytes()


@lru_cache(maxsize=2)
def _encoder(path: str | None, by_word: bool) -> WordEncoder:
    """One encoder, with the words that it knows, for all tasks of a worker."""
    return WordEncoder(path, by_word)


def _by_size(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, some ``BATCH_BYTES`` of text at a time."""
    size = pc.fill_null(pc.binary_length(batch.column("text_")), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // BATCH_BYTES
    edges = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def token_pieces(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID, by_word: bool = True
) -> DataFrame:
    """The pieces of every document, as ``PIECE_SCHEMA``.

    Whole texts are encoded (null: empty) and ended by ``end_id``, so every row gives at least
    one piece. Only documents of more than ``capacity`` tokens are cut.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, by_word)
        end = np.array([end_id], "<u4")
        for batch in (part for whole in batches for part in _by_size(whole)):
            row, piece, start, length, crc = [], [], [], [], []
            for r, found in enumerate(encoder.ids_of(batch.column("text_"))):
                ids = np.concatenate([found, end])
                for n, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    row.append(r)
                    piece.append(n)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id_").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("id_"), F.col("text").cast("string").alias("text_"))
    return rows.mapInArrow(run, PIECE_SCHEMA)


# --- one shard -------------------------------------------------------------------------

Solution = list[list[int]]  # bins, as lists of indexes into the lengths


def fills_of(bins: Solution, lengths: list[int]) -> list[int]:
    return [sum(map(lengths.__getitem__, b)) for b in bins]


def best_fit(bins: Solution, fills: list[int], items: list[int], lengths: list[int], capacity: int) -> None:
    """Put items, longest first, each into the fullest bin that has room; ``fills`` follow."""
    room = sorted((capacity - fill, b) for b, fill in enumerate(fills))
    for item in sorted(items, key=lambda i: (-lengths[i], i)):
        at = bisect_left(room, (lengths[item], -1))
        if at == len(room):
            bins.append([item])
            fills.append(lengths[item])
            insort(room, (capacity - lengths[item], len(bins) - 1))
        else:
            left, b = room.pop(at)
            bins[b].append(item)
            fills[b] += lengths[item]
            insort(room, (left - lengths[item], b))


def fitness(bins: Solution, lengths: list[int], capacity: int) -> tuple[int, int]:
    """Smaller is better: the number of bins, then how unevenly they are filled."""
    return len(bins), -sum(f * f for f in fills_of(bins, lengths))


def crossover(a: Solution, b: Solution, lengths: list[int], capacity: int, rng: np.random.Generator) -> Solution:
    """``a`` with some of the best-filled bins of ``b``."""
    fills = np.array(fills_of(b, lengths))
    best = np.argsort(-fills, kind="stable")[: max(1, len(b) // 2)]
    injected = [b[i] for i in best[rng.random(len(best)) < 0.5]] or [b[best[0]]]
    taken = {i for x in injected for i in x}
    child, displaced = [list(x) for x in injected], []
    for x in a:
        if taken.isdisjoint(x):
            child.append(list(x))
        else:
            displaced += [i for i in x if i not in taken]
    best_fit(child, fills_of(child, lengths), displaced, lengths, capacity)
    return child


def mutate(a: Solution, lengths: list[int], capacity: int, rng: np.random.Generator) -> Solution:
    """``a`` with its emptiest bin and a few others taken apart and fitted again."""
    fills = fills_of(a, lengths)
    gone = {int(np.argmin(fills)), *rng.integers(0, len(a), size=3).tolist()}
    child, fills = [list(x) for n, x in enumerate(a) if n not in gone], [f for n, f in enumerate(fills) if n not in gone]
    freed = [i for n in gone for i in a[n]]
    rng.shuffle(freed)
    order = freed[: len(freed) // 2]
    best_fit(child, fills, order, lengths, capacity)
    best_fit(child, fills, freed[len(freed) // 2 :], lengths, capacity)
    return child


def evolve(
    lengths: list[int], start: list[Solution], capacity: int, seed: int,
    population: int = POPULATION, generations: int = GENERATIONS,
) -> Solution:
    """The best solution of one island after some generations; stops where none can be better."""
    rng = np.random.default_rng(seed)
    least = -(-sum(lengths) // capacity)
    members = [[list(b) for b in s] for s in start]
    while len(members) < population and not any(len(m) <= least for m in members):
        bins: Solution = []
        if members:  # a random share first, then the rest: other starting points than best fit alone
            first = [i for i in range(len(lengths)) if rng.random() < 0.3]
            held = set(first)
            best_fit(bins, [], first, lengths, capacity)
            rest = [i for i in range(len(lengths)) if i not in held]
            best_fit(bins, fills_of(bins, lengths), rest, lengths, capacity)
        else:
            best_fit(bins, [], list(range(len(lengths))), lengths, capacity)
        members.append(bins)
    scored = sorted(((fitness(m, lengths, capacity), n, m) for n, m in enumerate(members)), key=lambda s: s[:2])
    for g in range(generations):
        if scored[0][0][0] <= least:
            break
        other = int(rng.integers(1, len(scored))) if len(scored) > 1 else 0
        child = crossover(scored[other][2], scored[0][2], lengths, capacity, rng)
        child = mutate(child, lengths, capacity, rng)
        scored[-1] = (fitness(child, lengths, capacity), 1000 + g, child)
        scored.sort(key=lambda s: s[:2])
    return scored[0][2]


# --- islands in Spark ------------------------------------------------------------------

_STATE = "shard long, island int, origin int, uid long, length long, bin int"


def _solutions(frame: pd.DataFrame) -> tuple[np.ndarray, list[int], list[Solution]]:
    """Pieces of an island, their lengths, and the solutions that reached it."""
    own = frame[frame["origin"] == frame["origin"].iloc[0]].sort_values("uid")
    uids, lengths = own["uid"].to_numpy(), own["length"].tolist()
    found = []
    for _, part in frame.groupby("origin", sort=True):
        part = part.sort_values("uid")
        bins = part["bin"].to_numpy()
        if bins[0] >= 0:
            order = np.argsort(bins, kind="stable")
            found.append([x.tolist() for x in np.split(order, np.flatnonzero(np.diff(bins[order])) + 1)])
    return uids, lengths, found


def _evolve_islands(state: DataFrame, capacity: int, islands: int, last: bool) -> DataFrame:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        shard, island = int(frame["shard"].iloc[0]), int(frame["island"].iloc[0])
        uids, lengths, found = _solutions(frame)
        best = evolve(lengths, found, capacity, seed=shard * 1009 + island)
        bins = np.zeros(len(uids), np.int32)
        for n, members in enumerate(best):
            bins[members] = n
        own = pd.DataFrame({"shard": shard, "island": np.int32(island), "origin": np.int32(island), "uid": uids, "length": lengths, "bin": bins})
        if last:
            return own
        return pd.concat([own, own.assign(island=np.int32((island + 1) % islands))])

    # Few rows but much work: not to be joined into few tasks.
    dealt = state.repartition(partitions(state.sparkSession), "shard", "island")
    return dealt.groupBy("shard", "island").applyInPandas(run, _STATE)


def _best_fits(pieces: DataFrame, capacity: int) -> DataFrame:
    """``_STATE`` with the best-fit solution of each shard, and whether one with fewer bins may exist."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("uid")
        lengths, found = frame["length"].tolist(), []
        best_fit(found, [], list(range(len(lengths))), lengths, capacity)
        bins = np.zeros(len(lengths), np.int32)
        for n, members in enumerate(found):
            bins[members] = n
        return frame.assign(island=np.int32(0), origin=np.int32(0), bin=bins, open=len(found) > -(-sum(lengths) // capacity))

    return pieces.groupBy("shard").applyInPandas(run, f"{_STATE}, open boolean")


def _pack_level(pieces: DataFrame, shard_pieces: int, level: int, capacity: int, islands: int, rounds: int) -> DataFrame:
    """``[uid, length, bin]`` with bins unique over all shards of the level.

    Every island starts from best fit; shards where that cannot be bettered need no islands.
    """
    n = pieces.count()
    shards = max(1, -(-n // shard_pieces))
    dealt = pieces.select(F.pmod(F.xxhash64(F.lit(level), "uid"), F.lit(shards)).alias("shard"), "uid", "length")
    fitted = staged(_best_fits(dealt, capacity), f"packing-fit-{level}")
    state = fitted.where("open").select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "origin", "uid", "length", "bin"
    )
    for r in range(rounds):
        state = _evolve_islands(state, capacity, islands, last=r == rounds - 1)
    state = staged(state, f"packing-{level}")
    # The island with the fewest bins wins in each shard.
    best = (
        state.groupBy("shard", "island").agg(F.max("bin").alias("bins"))
        .groupBy("shard").agg(F.min(F.struct("bins", "island")).alias("won"))
        .select("shard", F.col("won.island").alias("island"))
    )
    columns = ["shard", "uid", "length", "bin"]
    placed = fitted.where("not open").select(*columns).unionByName(state.join(best, ["shard", "island"]).select(*columns))
    return placed.select("uid", "length", ((F.col("shard") * 2 + level) * (1 << 24) + F.col("bin")).alias("sequence_id"))


def pack(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID,
    by_word: bool = True, islands: int = ISLANDS, rounds: int = ROUNDS, shard_pieces: tuple[int, int] = SHARD_PIECES,
) -> DataFrame:
    """Pack all documents; one row per piece: ``PIECE_SCHEMA``, sequence_id, offset.

    Null ids and texts are kept, empty texts are one token long, repeated rows are packed as
    often as they come, an empty table gives no rows. Each piece is placed once; sequences
    have no gaps and at most ``capacity`` tokens.
    """
    cut = token_pieces(docs, capacity, tokenizer, end_id, by_word)
    # The number is written with the row, so it stays the same from here on.
    pieces = staged(cut.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    whole = pieces.where(F.col("length") == capacity).select("uid", "length", (-1 - F.col("uid")).alias("sequence_id"))
    open_pieces = pieces.where(F.col("length") < capacity).select("uid", "length")
    first = _pack_level(open_pieces, shard_pieces[0], 0, capacity, islands, rounds)
    fill = first.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    first = first.join(fill, "sequence_id")
    good = F.col("fill") >= FULL_SHARE * capacity
    again = _pack_level(first.where(~good).select("uid", "length"), shard_pieces[1], 1, capacity, islands, rounds)
    placed = whole.unionByName(first.where(good).drop("fill")).unionByName(again)
    # A sequence holds at most ``capacity`` pieces, since each has a token or more.
    before = Window.partitionBy("sequence_id").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")
    placed = placed.withColumn("offset", offset).select("uid", "sequence_id", "offset")
    return pieces.join(placed, "uid").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return pack(read_table(spark, sf_dir, "documents"))


QUERIES = {"op3_pack": op3_pack}
ORACLES: dict[str, str] = {}
