"""Ranked lexical search: MaxScore whose bounds hold for pairs of terms, not for single terms alone.

Documents are indexed in segments of bounded size. For pairs of terms that queries ask for
together each segment also has the intersection of both lists with joint impacts and their
maximum. A query's terms are matched into pairs; the joint maximum of a pair bounds what both
terms can give one document, which is less than the sum of their own maxima where no document
is strong in both, and no more than the greater of them where no document has both. Terms are
read in the order of these bounds. As soon as all unread ones together cannot reach the
score of the k-th best, no document enters any more, and those that cannot reach it are dropped.

A first search over a few segments gives a score that the k-th best reaches at least; with it
the other segments skip from the start and give back hardly any documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from postlens.llm.common import LOWER, UPPER, discard, read_table, staged

# A segment is closed when it has this many terms, repeats counted, or documents.
SEGMENT_TERMS = 4_000_000
SEGMENT_DOCS = 65_535
# Texts are cut into terms in pieces of this many bytes.
PIECE = 1 << 22
# Items are handed to the workers in blocks of at most this many different terms.
BLOCK_TERMS = 40_000
# Each term of an item is paired with this many that follow it in the order of weights.
NEIGHBOURS = 2
# A pair's list tells the joint impacts that so many of its documents reach.
REACHED_BY = (1, 5, 20, 100)
# Segments of the first search, which finds scores to start from. Results do not depend on it.
FIRST_SEGMENTS = 16

# Fixed value: bytes of terms; A-Z become a-z, other ASCII characters separate.
_TO_TERM = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256)
)
_INDEX = "segment string, term string, df bigint, terms bigint, docs binary, counts binary"
_INDEX_ARROW = pa.schema([
    ("segment", pa.string()), ("term", pa.string()), ("df", pa.int64()), ("terms", pa.int64()),
    ("docs", pa.binary()), ("counts", pa.binary()),
])
_LISTS = "segment string, a int, b int, docs binary, counts binary, reached array<bigint>"
_LISTS_ARROW = pa.schema([
    ("segment", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary()),
    ("reached", pa.list_(pa.int64())),
])
_FOUND = "number int, item_id bigint, doc_id bigint, score bigint"
_FOUND_ARROW = pa.schema([("number", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
# The row of a segment that describes its documents has the empty term, which no text holds.
_DOCUMENTS, _ABOUT = "", -1


def split_terms(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, piece by piece."""
    plain, at = data.translate(_TO_TERM), 0
    while at < len(plain):
        stop = plain.find(b" ", at + PIECE)
        stop = len(plain) if stop < 0 else stop
        yield plain[at:stop].split()
        at = stop


def _binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Consecutive parts of ``values`` as binary values."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


class _Builder:
    """Documents of one segment until it is full."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.keys: list[np.ndarray] = []
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.held = 0

    def add(self, doc_id: int | None, data: bytes | None) -> None:
        number, size = self.numbers, 0
        for terms in split_terms(data or b""):
            if terms:
                ids = np.array([number.setdefault(t, len(number)) for t in terms], np.int64)
                self.keys.append(ids << 32 | len(self.ids))
                size += len(terms)
        if size:  # documents without a term are not in the collection
            self.ids.append(doc_id)
            self.sizes.append(size)
            self.held += size

    def batch(self, segment: str) -> pa.RecordBatch:
        """A row for every term with its documents and counts, one for the documents."""
        keys, counts = np.unique(np.concatenate(self.keys), return_counts=True)
        term, docs = keys >> 32, (keys & 0xFFFF).astype(np.uint16)
        bounds = np.r_[0, np.flatnonzero(np.diff(term)) + 1, len(term)]
        total = np.add.reduceat(counts, bounds[:-1])
        counts = counts.astype(np.uint16 if counts.max() < 1 << 16 else np.uint64)
        missing = np.array([i is None for i in self.ids])
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        about = [ids.tobytes() + missing.tobytes()], [np.array(self.sizes, np.int64).tobytes()]
        names = [t.decode("utf-8", "replace") for t in self.numbers]
        df = np.diff(bounds)
        columns = [
            pa.array([segment] * (len(df) + 1)),
            pa.array([*names, _DOCUMENTS]),
            pa.array(np.r_[df, len(ids)]),
            pa.array(np.r_[total, self.held]),
            pa.concat_arrays([_binaries(docs, bounds), pa.array(about[0], pa.binary())]),
            pa.concat_arrays([_binaries(counts, bounds), pa.array(about[1], pa.binary())]),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=_INDEX_ARROW)


def build_index(docs: DataFrame) -> DataFrame:
    """The documents as a stored index: one row for each segment and term.

    Columns ``segment, term, df, terms, docs, counts``: how many documents of the segment hold the
    term, how often all of them, which (places in the segment, 2 bytes each) and how often each (2
    bytes, 8 where one of the segment's counts needs them). The row with the empty term has the
    documents' ids and their numbers of terms.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id_"), F.col("text").cast("string").cast("binary").alias("text_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder, part, closed = _Builder(), TaskContext.get().partitionId(), 0
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                builder.add(doc_id, data.as_py())
                if builder.held >= SEGMENT_TERMS or len(builder.ids) >= SEGMENT_DOCS:
                    yield builder.batch(f"{part}-{closed}")
                    builder, closed = _Builder(), closed + 1
        if builder.held:
            yield builder.batch(f"{part}-{closed}")

    return staged(rows.mapInArrow(run, _INDEX), "search-index")


@dataclass
class Block:
    """Some items, their terms by number, and what the whole collection says about these."""

    n_docs: int
    n_terms: int
    terms: list[str] = field(default_factory=list)
    weights: list[int] = field(default_factory=list)
    ids: list[int | None] = field(default_factory=list)
    queries: list[dict[int, int]] = field(default_factory=list)  # term: how often the item has it
    pairs: dict[int, list[int]] = field(default_factory=dict)

    def choose_pairs(self) -> None:
        """Terms next to each other in the order of weights, within an item."""
        chosen = set()
        for query in self.queries:
            order = sorted(query, key=lambda t: (-self.weights[t], t))
            for i, a in enumerate(order):
                chosen |= {(min(a, b), max(a, b)) for b in order[i + 1 : i + 1 + NEIGHBOURS]}
        for a, b in sorted(chosen):
            self.pairs.setdefault(a, []).append(b)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _length_part(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of every document; in whole numbers of any size where 64 bits may not do."""
    if 25 * int(sizes.max(initial=0)) * n_docs < 1 << 63:
        return 75 + 25 * sizes * n_docs // n_terms
    return np.array([75 + 25 * n * n_docs // n_terms for n in sizes.tolist()], np.int64)


class Segment:
    """The lists of a segment that a block of items needs, with impacts."""

    def __init__(self, table: pa.Table, block: Block):
        self.name = table["segment"][0].as_py()
        columns = [table[c].to_pylist() for c in ("a", "b", "docs", "counts", "reached")]
        self.docs: dict[int, np.ndarray] = {}
        self.impacts: dict[int, np.ndarray] = {}
        self.both: dict[tuple[int, int], np.ndarray] = {}
        self.reached: dict[tuple[int, int], list[int]] = {}
        about = columns[0].index(_ABOUT)
        ids, sizes = columns[2][about], np.frombuffer(columns[3][about], np.int64)
        self.ids = np.frombuffer(ids, np.int64, len(sizes))
        self.missing = np.frombuffer(ids, np.bool_, len(sizes), 8 * len(sizes))
        m = _length_part(sizes, block.n_docs, block.n_terms)
        for a, b, docs, counts, reached in zip(*columns):
            if b >= 0:
                self.both[a, b], self.reached[a, b] = np.frombuffer(docs, np.uint16).astype(np.int64), reached
            elif a >= 0:
                at = np.frombuffer(docs, np.uint16).astype(np.int64)
                tf = np.frombuffer(counts, np.uint16 if len(counts) == len(docs) else np.uint64).astype(np.int64)
                self.docs[a] = at
                self.impacts[a] = block.weights[a] * (1_000_000_000 * tf // (1000 * tf + 12 * m[at]))
        self.most = {a: int(x.max()) for a, x in self.impacts.items()}

    def pair_lists(self, pairs: dict[int, list[int]]) -> pa.Table:
        """The documents that hold both terms of a pair; the greatest joint impact and those that 5, 20, 100 documents reach."""
        rows: list[tuple] = []
        other = np.full(len(self.ids), -1, np.int64)
        for a, partners in pairs.items():
            if a not in self.docs:
                continue
            other[self.docs[a]] = self.impacts[a]
            for b in partners:
                if b in self.docs:
                    of_a = other[self.docs[b]]
                    both = of_a >= 0
                    if both.any():
                        joint = np.sort(of_a[both] + self.impacts[b][both])[::-1]
                        reached = [int(joint[n - 1]) for n in REACHED_BY if n <= len(joint)]
                        rows.append((self.name, a, b, self.docs[b][both].astype(np.uint16).tobytes(), b"", reached))
            other[self.docs[a]] = -1
        columns = zip(*rows) if rows else [[]] * len(_LISTS_ARROW)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LISTS_ARROW)], schema=_LISTS_ARROW)

    def _units(self, query: dict[int, int], pairs: dict[int, list[int]], k: int) -> tuple[list[tuple[int, list[int]]], int]:
        """(bound, terms) of single and paired terms, greatest bound first, and a score that k documents reach."""
        own = {t: n * self.most[t] for t, n in query.items() if t in self.docs}
        savings, floor = [], 0
        for a in own:
            for b in pairs.get(a, ()):
                if b not in own:
                    continue
                bound, reached = max(own[a], own[b]), self.reached.get((a, b))
                if reached:
                    n = min(query[a], query[b])
                    # What one of them comes more often than the other counts by its own maximum.
                    joint = n * reached[0] + (query[a] - n) * self.most[a] + (query[b] - n) * self.most[b]
                    bound = max(bound, min(joint, own[a] + own[b]))
                    floor = max([floor, *(n * x for of, x in zip(REACHED_BY, reached) if of >= k)])
                savings.append((own[a] + own[b] - bound, a, b, bound))
        units, free = [], set(own)
        for _, a, b, bound in sorted(savings, reverse=True):
            if a in free and b in free:
                free -= {a, b}
                units.append((bound, [a, b]))
        units += [(own[t], [t]) for t in free]
        return sorted(units, reverse=True), floor

    def search(self, query: dict[int, int], pairs: dict[int, list[int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the k best documents, those below ``floor`` left out."""
        units, reached = self._units(query, pairs, k)
        floor = max(floor, reached, 1)
        left = sum(bound for bound, _ in units)
        score = np.zeros(len(self.ids), np.int64)
        at, more = 0, np.zeros(0, np.int64)
        while at < len(units) and left >= floor:
            bound, terms = units[at]
            alone = max(query[t] * self.most[t] for t in terms)
            if left - bound + alone < floor:
                # With one of the two terms a new document cannot get there: only those with both may enter.
                more = self.both.get((min(terms), max(terms)), more)
                break
            for t in terms:
                score[self.docs[t]] += query[t] * self.impacts[t]
            if len(score) >= k:
                floor = max(floor, int(np.partition(score, -k)[-k]))
            left -= bound
            at += 1
        # What holds only unread terms stays below the floor: from here on, only these can be among the best.
        open_ = (score > 0) & (score + left >= floor)
        open_[more] = True
        docs = np.flatnonzero(open_)
        values = score[docs]
        for bound, terms in units[at:]:
            for t in terms:
                place = np.minimum(np.searchsorted(self.docs[t], docs), len(self.docs[t]) - 1)
                values += np.where(self.docs[t][place] == docs, query[t] * self.impacts[t][place], 0)
            left -= bound
            possible = values + left >= floor
            docs, values = docs[possible], values[possible]
            if not len(docs):
                break
        good = values >= floor
        docs, values = docs[good], values[good]
        best = np.lexsort((self.ids[docs], self.missing[docs], -values))[:k]
        return docs[best], values[best]


def _blocks(items: DataFrame) -> Iterator[tuple[list[int | None], list[Counter]]]:
    """Items as counted terms, in blocks of bounded size, one on the driver at a time."""
    rows = items.select(
        F.col("item_id").cast("bigint").alias("id_"), F.col("text").cast("string").alias("text_")
    ).where("text_ is not null").orderBy("id_", "text_")
    ids, queries, held = [], [], set()
    for row in rows.toLocalIterator():
        counted = Counter(t.decode("utf-8", "replace") for part in split_terms(row["text_"].encode("utf-8", "replace")) for t in part)
        if counted:
            if held and len(held | set(counted)) > BLOCK_TERMS:
                yield ids, queries
                ids, queries, held = [], [], set()
            ids.append(row["id_"])
            queries.append(counted)
            held |= set(counted)
    if ids:
        yield ids, queries


def _lists_of(index: DataFrame, terms: list[str]) -> DataFrame:
    """The rows of the index for some terms (numbered), and those that describe documents."""
    numbered = index.sparkSession.createDataFrame(
        [*((t, a) for a, t in enumerate(terms)), (_DOCUMENTS, _ABOUT)], "term string, a int"
    )
    return index.join(F.broadcast(numbered), "term").select(
        "segment", "a", F.lit(-1).alias("b"), "docs", "counts", F.lit(None).cast("array<bigint>").alias("reached")
    )


def _block(index: DataFrame, ids: list[int | None], counted: list[Counter]) -> Block:
    """Numbers and weights for the terms of some items that the collection holds."""
    n_docs, n_terms = index.where(F.col("term") == _DOCUMENTS).agg(F.sum("df"), F.sum("terms")).first()
    block = Block(n_docs or 0, n_terms or 0, ids=ids)
    wanted = sorted(set().union(*counted))
    listed = index.sparkSession.createDataFrame([(t,) for t in wanted], "term string")
    df = dict(index.join(F.broadcast(listed), "term").groupBy("term").agg(F.sum("df")).collect())
    block.terms = sorted(df)
    block.weights = [weight(block.n_docs, df[t]) for t in block.terms]
    number = {t: a for a, t in enumerate(block.terms)}
    block.queries = [{number[t]: n for t, n in c.items() if t in number} for c in counted]
    block.choose_pairs()
    return block


def _pair_lists(lists: DataFrame, block: Block) -> DataFrame:
    """The intersections of every segment, stored."""

    def run(table: pa.Table) -> pa.Table:
        return Segment(table, block).pair_lists(block.pairs)

    return staged(lists.groupBy("segment").applyInArrow(run, _LISTS), "search-pairs")


def _search_segments(lists: DataFrame, block: Block, k: int, floors: dict[int, int]) -> DataFrame:
    """``[number, item_id, doc_id, score]``: the k best of every segment, as far as they reach the floors."""

    def run(table: pa.Table) -> pa.Table:
        segment = Segment(table, block)
        found: list[tuple] = []
        for number, query in enumerate(block.queries):
            docs, scores = segment.search(query, block.pairs, k, floors.get(number, 1))
            found += [
                (number, block.ids[number], None if segment.missing[d] else int(segment.ids[d]), int(s))
                for d, s in zip(docs, scores)
            ]
        columns = zip(*found) if found else [[]] * len(_FOUND_ARROW)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND_ARROW)], schema=_FOUND_ARROW)

    return lists.groupBy("segment").applyInArrow(run, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``[item_id, rank, doc_id, score]``: for each item the k documents with the highest scores above 0.

    Terms are runs of ASCII letters and digits and other than ASCII characters, A-Z as a-z, in
    whole texts. Equal scores rank by ascending id, documents without an id last. Documents that
    repeat an id, or are repeated, are documents of their own, and so are items; items without an
    id are searched like others. Null and empty texts and texts without a term are neither found
    nor part of the collection's counts. Further columns of ``items`` are not read.

    What goes to the workers is bounded by the terms of a block of items; what comes back to the
    driver are the counts of these terms and one score an item.
    """
    out = None
    for ids, counted in _blocks(items):
        block = _block(index, ids, counted)
        if not block.terms:
            continue
        lists = _lists_of(index, block.terms)
        lists = lists.unionByName(_pair_lists(lists, block))
        segments = index.where(F.col("term") == _DOCUMENTS).select("segment")
        first = [r[0] for r in segments.orderBy(F.xxhash64("segment"), "segment").limit(FIRST_SEGMENTS).collect()]
        tried = _ranked(_search_segments(lists.where(F.col("segment").isin(first)), block, k, {}), k)
        floors = {r["number"]: r["score"] for r in tried.where(F.col("rank") == k).select("number", "score").collect()}
        part = _ranked(_search_segments(lists, block, k, floors), k)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return index.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return out.select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    index = build_index(read_table(spark, sf_dir, "documents"))
    found = staged(search(index, read_table(spark, sf_dir, "benchmark")), "search-found")
    discard(index)
    return found


_TERMS = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

QUERIES = {"op11_ranked_search": op11_ranked_search}
ORACLES: dict[str, str] = {
    "op11_ranked_search": f"""
        WITH term AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM term GROUP BY doc_id, term),
        size AS (SELECT doc_id, count(*) AS n FROM term GROUP BY doc_id),
        total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS bigint) AS n_terms FROM size),
        weight AS (
            SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS bigint) AS w
            FROM tf, total GROUP BY term, n_docs
        ),
        doc AS (SELECT doc_id, 100 - 25 + ((25 * n * n_docs) // n_terms) AS m FROM size, total),
        asked AS (
            SELECT item_id, term, count(*) AS times
            FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term
        ),
        scored AS (
            SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS bigint) AS score
            FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN doc USING (doc_id)
            GROUP BY item_id, doc_id
        ),
        ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS integer) AS rank,
                doc_id, score
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
    """
}
