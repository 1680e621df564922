"""Exact removal of repeated passages with suffix arrays.

A passage of ``LENGTH`` bytes that also starts earlier is removed, wherever it lies. Equal
windows of that length hold the same least 16-gram (their anchor), so windows are dealt into
shards by anchor, neighbouring windows around one anchor together as one string. Equal strings
are merged before they travel. Strings that agree with others around the anchor are sorted in
their shard, all suffixes of them, by external induced sorting; windows next to each other in
that order that share ``LENGTH`` bytes are the same passage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from postlens.llm.common import bounded_sample, partitions, read_table, staged, work_folder
from postlens.llm.shingles import mix
from postlens.llm.suffix_sort import CAP, Spill, sorted_suffixes

LENGTH = 100
GRAM = 16
# 16-grams in HOT_DOCS or more of at most SLICES * EACH sampled documents are anchors only
# where a window has no other: this moves work, the result is the same for any order.
SLICES, EACH, HOT_DOCS = 64, 16, 5
HOT_BITS = 22
CHUNK = 1 << 20  # bytes of a text that are looked at together
PLACE_BITS = 21  # for a place in a chunk and the window that reaches over its end
FLUSH = 400_000
QUEUE_BYTES = 64 << 20
NO_ID = (1 << 63) - 1

_U = np.uint64
_POWER = _U(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes from each place on; four doublings of single bytes."""
    h = mix(data.astype(np.uint64) + _U(1))
    for width, factor in ((1, 0xBF58476D1CE4E5B9), (2, 0x94D049BB133111EB), (4, 0xD6E8FEB86659FD93), (8, 0xA0761D6478BD642F)):
        h = h[:-width] * _U(factor) + h[width:]
    return mix(h)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    out, reach = values, 1
    while reach * 2 <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    back = _U(pow(int(_POWER), -1, 1 << 64))
    return (
        np.cumprod(np.r_[_U(1), np.full(n, _POWER)]), np.cumprod(np.r_[_U(1), np.full(n, back)])
    )


class Strings:
    """Cuts texts into strings of windows with one anchor."""

    def __init__(self, hot: np.ndarray, length: int = LENGTH):
        self.hot, self.length = hot, length
        self.forth, self.back = _powers(CHUNK + 2 * length)

    def cut(self, data: bytes) -> tuple[np.ndarray, ...]:
        """Of each string: anchor with what lies left of it, what lies right of it, hash of the
        content, first window, number of windows."""
        out = []
        windows = len(data) - self.length + 1
        for at in range(0, max(0, windows), CHUNK):
            part = np.frombuffer(data, np.uint8, min(len(data) - at, CHUNK + self.length - 1), at)
            out.append(self._cut(part, at))
        if not out:
            return tuple(np.zeros(0, kind) for kind in (np.uint64, np.uint32, np.uint64, np.int64, np.int64))
        return tuple(np.concatenate(x) for x in zip(*out))

    def _cut(self, part: np.ndarray, base: int):
        h = gram_hashes(part)
        late = self.hot[(h & _U((1 << HOT_BITS) - 1)).astype(np.int64)]
        # Hot or not, then the hash, then the place: the least is the first of the least grams.
        place = np.arange(len(h), dtype=np.uint64)
        keys = late.astype(np.uint64) << _U(63) | h >> _U(PLACE_BITS + 1) << _U(PLACE_BITS) | place
        anchors = _sliding_least(keys, self.length - GRAM + 1)
        # Equal windows have their anchor at the same offset, so no string holds a window twice.
        new = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
        count = np.diff(np.r_[new, len(anchors)])
        # Content: the 16-grams of the string, weighed by their place in it.
        total = np.r_[_U(0), np.cumsum(h * self.forth[: len(h)])]
        grams = lambda start, n: mix((total[start + n] - total[start]) * self.back[start] + np.asarray(n).astype(np.uint64))
        content = grams(new, count + self.length - GRAM) >> _U(16)  # 48 bits, beside 64 of the anchor and left of it
        # Two strings that hold the same window agree on so many grams left or right of the
        # anchor; a side that does not lie in the string is 0, so equal strings agree on both.
        chosen = anchors[new]
        at, side = (chosen & _U((1 << PLACE_BITS) - 1)).astype(np.int64), (self.length - GRAM) // 2
        left = np.where(at - side >= new, grams(np.maximum(at - side, 0), side + 1) >> _U(64 - PLACE_BITS) | _U(1), _U(0))
        fits = at + side + GRAM < new + count + self.length
        right = np.where(fits, grams(np.minimum(at, len(h) - side - 1), side + 1) >> _U(32) | _U(1), _U(0))
        return chosen >> _U(PLACE_BITS) << _U(PLACE_BITS) | left, right.astype(np.uint32), content, new + base, count


def hot_grams(texts: DataFrame) -> np.ndarray:
    """Marks, by the low bits of a 16-gram's hash, of grams frequent in a bounded sample."""
    ids = texts.where("id_ is not null").select("id_").withColumn("all_", F.lit(1))
    chosen = bounded_sample(ids, "all_", "id_", SLICES, EACH).select("id_").distinct()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            held = []
            for key, data in zip(batch["u_"], batch["data_"]):
                if key not in seen and len(data) >= GRAM:
                    seen.add(key)
                    found = [np.unique(gram_hashes(np.frombuffer(data, np.uint8, min(len(data) - at, CHUNK + GRAM - 1), at)))
                             for at in range(0, len(data) - GRAM + 1, CHUNK)]
                    held.append(np.unique(np.concatenate(found)))
            if held:
                found, n = np.unique(np.concatenate(held), return_counts=True)
                yield pd.DataFrame({"gram": found.view(np.int64), "n": n})

    # At most SLICES * EACH ids.
    sample = texts.join(F.broadcast(chosen), "id_", "left_semi").select("u_", "data_")
    low = F.expr(f"gram & {(1 << HOT_BITS) - 1}").cast("int")
    hot = (
        sample.mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= HOT_DOCS).select(low.alias("mark")).distinct()
    )
    marks = np.zeros(1 << HOT_BITS, bool)
    marks[hot.toPandas()["mark"].to_numpy(np.int64)] = True  # at most 1 << HOT_BITS rows
    return marks


# --- packed arrays that travel between tasks ---------------------------------------------

def _pack(*arrays: np.ndarray) -> bytes:
    """Sizes, then the arrays byte by byte: first bytes, second bytes, and so on, which compress
    well where numbers are small."""
    planes = [a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in map(np.ascontiguousarray, arrays)]
    return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(planes)


def _unpack(blob: bytes, *types) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(blob, np.int64, len(types)), 8 * len(types), []
    for size, kind in zip(sizes, types):
        width, size = np.dtype(kind).itemsize, int(size)
        planes = np.frombuffer(blob, np.uint8, size * width, at).reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(size))
        at += size * width
    return out


def _by(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value of a key with the places where it stands."""
    order = np.argsort(key, kind="stable")
    cuts = np.flatnonzero(np.diff(key[order])) + 1
    for members in np.split(order, cuts):
        if len(members):
            yield int(key[members[0]]), members


_ENTRY = (np.int64, np.int64, np.uint64, np.uint32, np.uint64, np.int32, np.int32, np.uint8)
_FOUND = (np.int64, np.int64, np.int32, np.int32, np.int32)


def _merge_equal(doc_id, doc_u, anchor, content, owner, start, count):
    """Order of the strings by anchor and content, and which of them is the first of its kind."""
    by = np.lexsort((start, doc_u[owner], doc_id[owner], content, anchor))
    a, c = anchor[by], content[by]
    first = np.r_[True, (a[1:] != a[:-1]) | (c[1:] != c[:-1])] if len(by) else np.zeros(0, bool)
    return by, first


def string_segments(texts: DataFrame, hot: np.ndarray, length: int, segments: int) -> DataFrame:
    """``[segment, kind, blob]``: strings by the segment of their anchor (kind 0), the first of
    equal ones in a batch; the others, known to be repeated, by that of their document (1)."""
    sent = texts.sparkSession.sparkContext.broadcast(np.packbits(hot))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        strings = Strings(np.unpackbits(sent.value).astype(bool), length)
        seen: dict[int, tuple[int, int, int]] = {}  # text: least id, flush and place where it was held
        held, docs, size, flushes = [], [], 0, 0

        def flush() -> pd.DataFrame:
            doc_id, doc_u = np.array([d[0] for d in docs], np.int64), np.array([d[1] for d in docs], np.int64)
            anchor, right, content, start, count = (np.concatenate(x) for x in zip(*held))
            owner = np.repeat(np.arange(len(held)), [len(x[0]) for x in held])
            by, first = _merge_equal(doc_id, doc_u, anchor, content, owner, start, count)
            rows = []
            keep = by[first]
            for segment, at in _by(((anchor[keep] >> _U(PLACE_BITS)) % _U(segments)).astype(np.int64)):
                at = keep[at]
                own, place = np.unique(owner[at], return_inverse=True)
                rows.append((segment, 0, _pack(
                    doc_id[own], doc_u[own], anchor[at], right[at], content[at], place.astype(np.int32),
                    start[at].astype(np.int32), count[at].astype(np.uint8))))
            again = by[~first]
            for segment, at in _by((doc_u[owner[again]] % segments).astype(np.int64)):
                at = again[at]
                own, place = np.unique(owner[at], return_inverse=True)
                rows.append((segment, 1, _pack(
                    doc_id[own], doc_u[own], place.astype(np.int32), start[at].astype(np.int32), count[at].astype(np.int32))))
            return pd.DataFrame(rows, columns=["segment", "kind", "blob"])

        for batch in batches:
            for doc_id, u, data in zip(batch["id_"], batch["u_"], batch["data_"]):
                if len(data) < length:
                    continue
                # Of the copies of a text that this task sees, the one with the least id counts.
                least, flushed, place = seen.get(u, (NO_ID, -1, -1))
                if place >= 0 and flushed == flushes:
                    docs[place] = (min(least, doc_id), u)
                if place >= 0 and (flushed == flushes or least <= doc_id):
                    if doc_id < least:
                        seen[u] = (doc_id, flushed, place)
                    continue
                if len(seen) < 1_000_000:
                    seen[u] = (doc_id, flushes, len(docs))
                held.append(strings.cut(data))
                docs.append((doc_id, u))
                size += len(held[-1][0])
                if size >= FLUSH:
                    yield flush()
                    held, docs, size, flushes = [], [], 0, flushes + 1
        if held:
            yield flush()

    known = F.coalesce("id_", F.lit(NO_ID)).alias("id_")
    return texts.select(known, "u_", "data_").mapInPandas(run, "segment int, kind int, blob binary")


def _repeated(values: np.ndarray) -> np.ndarray:
    """Which values stand more than once."""
    _, place, n = np.unique(values, return_inverse=True, return_counts=True)
    return n[place] > 1


def _decide(frame: pd.DataFrame) -> pd.DataFrame:
    """Strings of a segment: repeated ones, and those whose anchor has other strings as well."""
    segment = int(frame["segment"].iloc[0])
    out = []

    def note(doc_id, doc_u, owner, start, count, ask: bool) -> None:
        for n, at in _by(owner):
            pair = np.stack([start[at], count[at]], axis=1).astype(np.int32).tobytes()
            out.append((int(doc_id[n]), int(doc_u[n]), segment, None if ask else pair, pair if ask else None))

    for blob in frame.loc[frame["kind"] == 1, "blob"]:
        doc_id, doc_u, owner, start, count = _unpack(blob, *_FOUND)
        note(doc_id, doc_u, owner, start, count, False)
    parts = [_unpack(b, *_ENTRY) for b in frame.loc[frame["kind"] == 0, "blob"]]
    if parts:
        shift = np.cumsum([0] + [len(p[0]) for p in parts[:-1]])
        doc_id, doc_u, anchor, right, content = (np.concatenate([p[i] for p in parts]) for i in range(5))
        owner = np.concatenate([p[5] + s for p, s in zip(parts, shift)])
        start, count = np.concatenate([p[6] for p in parts]), np.concatenate([p[7] for p in parts]).astype(np.int32)
        # The same document may have come from several batches.
        ids, owner_of = np.unique(np.stack([doc_id, doc_u], axis=1), axis=0, return_inverse=True)
        doc_id, doc_u, owner = ids[:, 0], ids[:, 1], owner_of.reshape(-1)[owner]
        by, first = _merge_equal(doc_id, doc_u, anchor, content, owner, start, count)
        # The same string of the same document may have come twice, from repeated rows.
        same = np.r_[False, (owner[by][1:] == owner[by][:-1]) & (start[by][1:] == start[by][:-1])] if len(by) else first
        again, kept = by[~first & ~same], by[first]
        note(doc_id, doc_u, owner[again], start[again], count[again], False)
        # Sorted are the strings that agree with another on one side of the anchor.
        a, low = anchor[kept], _U((1 << PLACE_BITS) - 1)
        around = mix((a | low) ^ mix(right[kept].astype(np.uint64)))
        asked = kept[(_repeated(a) & (a & low != 0)) | (_repeated(around) & (right[kept] != 0))]
        note(doc_id, doc_u, owner[asked], start[asked], count[asked], True)
    return pd.DataFrame(out, columns=["id_", "u_", "segment", "gone", "asked"])


def _sort_shard(length: int, folder: str, queue_bytes: int, base: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """Windows of a shard's strings that also start earlier, by document."""
        pieces, at, starts, owners, places, docs = [], 0, [], [], [], []
        unique = frame.drop_duplicates(["id_", "u_"])  # repeated rows are one document
        for doc_id, u, places_blob, data in zip(unique["id_"], unique["u_"], unique["places"], unique["data_"]):
            for begin, size in np.frombuffer(places_blob, np.int64).reshape(-1, 2):
                starts.append(at)
                owners.append(len(docs))
                places.append(begin)
                at += int(size) + 1
            pieces.append(data)
            docs.append((doc_id, u))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        # Strings end with a 255, which no text holds; it becomes 1, and 0 ends the whole.
        text = np.empty(len(raw) + 1, np.uint8)
        text[:-1] = np.where(raw == 255, 1, raw + 2)
        text[-1] = 0
        starts, owners, places = (np.array(x, np.int64) for x in (starts, owners, places))
        order = sorted(range(len(docs)), key=docs.__getitem__)
        rank = np.empty(len(docs), np.int64)
        rank[order] = np.arange(len(docs))
        ends = np.r_[starts[1:], len(text) - 1] - 1  # of the strings, at their separators
        found: list[np.ndarray] = []
        spill = Spill(folder)
        try:
            for suffixes, shared in sorted_suffixes(text, length, spill, queue_bytes, base):
                near = np.flatnonzero(shared >= length)
                if not len(near):
                    continue
                use = np.unique(np.concatenate([near - 1, near]))
                group = np.cumsum(shared[use] < length)
                suffix = suffixes[use]
                string = np.searchsorted(starts, suffix, side="right") - 1
                whole = (string >= 0) & (suffix + length <= ends[string])
                suffix, string, group = suffix[whole], string[whole], group[whole]
                if not len(suffix):
                    continue
                place = places[string] + suffix - starts[string]
                key = np.lexsort((place, rank[owners[string]], group))
                later = np.r_[False, group[key][1:] == group[key][:-1]]
                at = key[later]
                found.append(np.stack([owners[string[at]], place[at]], axis=1))
        finally:
            spill.close()
        out = []
        if found:
            all_found = np.concatenate(found)
            for n, at in _by(all_found[:, 0]):
                first = np.sort(all_found[at, 1])
                new = np.r_[True, np.diff(first) > 1]
                begin = first[new]
                count = np.diff(np.r_[np.flatnonzero(new), len(first)])
                out.append((docs[n][0], docs[n][1], np.stack([begin, count], axis=1).astype(np.int32).tobytes()))
        return pd.DataFrame(out, columns=["id_", "u_", "gone"])

    return run


def _covered(size: int, blobs: list[bytes], length: int) -> np.ndarray:
    """Which bytes the windows cover; a blob holds (first window, number of windows)."""
    change = np.zeros(size + 1, np.int64)
    for blob in blobs:
        pairs = np.frombuffer(blob, np.int32).reshape(-1, 2).astype(np.int64)
        np.add.at(change, pairs[:, 0], 1)
        np.add.at(change, pairs[:, 0] + pairs[:, 1] + length - 1, -1)
    return np.cumsum(change[:-1]) > 0


_RESULT = "id_ long, u_ long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string, rest_ string"
_COLUMNS = [c.split()[0] for c in _RESULT.split(", ")]


def _result(doc_id, u, rest, data: bytes, blobs: list[bytes], length: int, texts: bool) -> tuple:
    covered = _covered(len(data), blobs, length) if blobs else np.zeros(len(data), bool)
    kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
    spans = int((np.diff(np.r_[0, covered.astype(np.int8)]) == 1).sum())
    text = kept.decode("utf-8", "ignore") if texts else None
    return doc_id, u, len(data), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest(), text, rest


def dedup_passages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH,
    texts: bool = True, carry: Sequence[str] = (), queue_bytes: int = QUEUE_BYTES, base: int = 1 << 22,
) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256, kept_text, and the
    columns to ``carry``, which are otherwise not looked at.

    Every byte covered by a string of ``length`` bytes that also starts earlier is removed: in
    a document with a smaller id, or in the same one before. Documents without an id come after
    all others; documents that share an id but not the text come in the order of a hash of the
    text; rows that repeat both are one document and get the same answer. Null and empty texts
    are empty and nothing is removed from them. The hash is that of the bytes
    that remain; ``kept_text`` is null without ``texts``, and leaves out parts of characters,
    as passages are bytes. A ``length`` below ``GRAM`` or beyond ``CAP``, up to which prefixes are
    told apart, is refused.
    """
    if not GRAM <= length <= CAP:
        raise ValueError(f"passages must have {GRAM} to {CAP} bytes")
    spark = docs.sparkSession
    data = F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary")
    rest = F.to_json(F.struct(*carry)) if carry else F.lit(None).cast("string")
    all_texts = docs.select(F.col(id_column).cast("long").alias("id_"), data.alias("data_"), rest.alias("rest_")).withColumn(
        "u_", F.xxhash64(F.lit(1), "data_")
    )
    segments = 2 * partitions(spark)

    # Copies of whole texts: the first of them stands for all.
    rows = all_texts.select(
        F.coalesce("id_", F.lit(NO_ID)).alias("id_"), "u_", F.xxhash64(F.lit(2), "data_").alias("u2_"),
        F.octet_length("data_").alias("size_"),
    ).where(F.col("size_") >= length)
    first = rows.groupBy("u_", "u2_").agg(F.min("id_").alias("first_"))
    copies = rows.join(first, ["u_", "u2_"]).where("id_ > first_").select("id_", "u_").distinct()

    hot = hot_grams(all_texts)
    sent = string_segments(all_texts, hot, length, segments)
    decided = sent.groupBy("segment").applyInPandas(
        _decide, "id_ long, u_ long, segment int, gone binary, asked binary"
    )
    # What is known of a document: one item per segment at most, and per batch that it came in.
    found = (
        decided.withColumn("copy", F.lit(False))
        .unionByName(copies.select("id_", "u_", F.lit(None).cast("int").alias("segment"), F.lit(None).cast("binary").alias("gone"), F.lit(None).cast("binary").alias("asked"), F.lit(True).alias("copy")))
        .groupBy("id_", "u_")
        .agg(
            F.max("copy").alias("copy"), F.collect_list("gone").alias("gone"),
            F.collect_list(F.when(F.col("asked").isNotNull(), F.struct("segment", "asked"))).alias("asked"),
        )
    )
    # Read twice below, and written once: no text is in it.
    known = staged(found, "passages")
    # Repeated rows of id and text are one document here.
    joined = (
        all_texts.withColumn("id_", F.coalesce("id_", F.lit(NO_ID)))
        .join(known, ["id_", "u_"], "left").select("id_", "u_", "rest_", "data_", "copy", "gone", "asked")
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The strings that are to be sorted, by segment."""
        for batch in batches:
            out = []
            for doc_id, u, _, data, _, _, asked in batch.itertuples(index=False):
                by_segment: dict[int, list[bytes]] = {}
                for item in asked:
                    by_segment.setdefault(item["segment"], []).append(item["asked"])
                for segment, blobs in by_segment.items():
                    pairs = np.concatenate([np.frombuffer(b, np.int32).reshape(-1, 2) for b in blobs]).astype(np.int64)
                    pairs[:, 1] += length - 1  # from windows to bytes
                    strings = b"".join(data[a : a + n] + b"\xff" for a, n in pairs.tolist())
                    out.append((segment, doc_id, u, pairs.tobytes(), strings))
            yield pd.DataFrame(out, columns=["segment", "id_", "u_", "places", "data_"])

    # All columns go into ``cut``, also those it does not use: the texts are then dealt out just as for
    # the join below, which reads the same exchange, so that they move once and are not written.
    strings = joined.where("not copy and size(asked) > 0").mapInPandas(
        cut, "segment int, id_ long, u_ long, places binary, data_ binary"
    )
    folder = work_folder(spark, "sort")
    sorted_out = (
        strings.groupBy("segment").applyInPandas(_sort_shard(length, folder, queue_bytes, base), "id_ long, u_ long, gone binary")
        .groupBy("id_", "u_").agg(F.collect_list("gone").alias("more"))
    )
    complete = joined.drop("asked").join(sorted_out, ["id_", "u_"], "left").select("id_", "u_", "rest_", "data_", "copy", "gone", "more")

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, u, rest, data, copy, gone, more in batch.itertuples(index=False):
                if copy is not None and copy == True:  # noqa: E712
                    blobs = [np.array([[0, len(data) - length + 1]], np.int32).tobytes()]
                else:
                    blobs = [blob for part in (gone, more) if part is not None for blob in part]
                out.append(_result(doc_id, u, rest, data, blobs, length, texts))
            yield pd.DataFrame(out, columns=_COLUMNS)

    results = complete.mapInPandas(finish, _RESULT)
    carried = F.from_json("rest_", docs.select(*carry).schema) if carry else F.lit(None)
    return results.withColumn("rest_", carried).select(
        F.when(F.col("id_") != NO_ID, F.col("id_")).alias(id_column), "n_bytes", "n_removed", "n_spans", "kept_sha256",
        "kept_text", *[F.col("rest_")[c].alias(c) for c in carry],
    )


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of 100 bytes in all documents."""
    got = dedup_passages(read_table(spark, sf_dir, "documents"), texts=False)
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES = {"op1_suffix_dedup": op1_suffix_dedup}
ORACLES: dict[str, str] = {}
