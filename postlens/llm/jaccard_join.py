"""Exact set similarity join on word shingles, with skipping by set relations.

Equal sets are one set. Every set is listed under the shingles of its prefix: rare ones first,
so many that two similar sets share one. A list is ordered by size and position, and whole
blocks of it are skipped where sizes and positions rule out the similarity; inside blocks, shingles
that no other set has and the parities of hashed shingles do. In each list the set with the
fewest shingles of its own leads: its answers are computed first, and sets found similar to it
take over its class. What is left to look at are pairs of sets of different classes. A set's
answers follow from those of its leader as far as their difference allows: if they share all but
few shingles, the leader's overlap with a third set bounds its own from both sides. Only pairs
that stay open are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from postlens.llm.common import bounded_sample, discard, partitions, read_table, staged
from postlens.llm.graph import components
from postlens.llm.shingles import Shingler, mix, set_key

PERCENT = 90
WORDS = 3
# Shingles in HOT_DOCS or more of at most SLICES * EACH sampled documents come last in a
# prefix. This moves work only: any common order of the shingles gives the same result.
SLICES, EACH, HOT_DOCS = 64, 32, 4
FLUSH = 400_000
BLOCK = 256
# A bitmap of so many rows, and so many shingles of sets that a task keeps: both move work only.
MAP_BITS, HELD = 1 << 24, 1 << 21
# The parities of the shingles in each of so many classes go with a set: 64 bytes.
PARITIES = 512

_U = np.uint64


def prefix_length(n: np.ndarray | int, percent: int = PERCENT):
    """So many shingles, in the common order, that similar sets share one of them."""
    return n - (percent * n + 99) // 100 + 1


def needed_overlap(n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The least overlap o with 100 * o >= percent * (n + m - o)."""
    return -(-percent * (n + m) // (100 + percent))


def parities(shingles: np.ndarray) -> bytes:
    """Whether the number of shingles is odd, for each class of their hashes."""
    odd = np.bincount((shingles % _U(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def most_overlap(n: np.ndarray, m: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """What sets of n and m shingles share at most: every parity that differs costs one of them a shingle."""
    return (n + m - np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)) // 2


def _hot_shingles(texts: DataFrame, words: int) -> np.ndarray:
    """Shingles frequent in a bounded sample of the documents."""
    ids = texts.where("id_ is not null").select("id_").withColumn("all_", F.lit(1))
    chosen = bounded_sample(ids, "all_", "id_", SLICES, EACH).select("id_").distinct()

    def shingle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, seen = Shingler(words), set()
        for batch in batches:
            held = []
            for text in batch["text_"]:
                own = shingler.set_of(text if isinstance(text, str) else None)
                if set_key(own) not in seen:  # copies within a task count once
                    seen.add(set_key(own))
                    held.append(own)
            if held:
                found, n = np.unique(np.concatenate(held), return_counts=True)
                yield pd.DataFrame({"shingle": found.view(np.int64), "n": n})

    # At most SLICES * EACH ids.
    sample = texts.join(F.broadcast(chosen), "id_", "left_semi").select("text_")
    counts = sample.mapInPandas(shingle, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    hot = counts.where(F.col("n") >= HOT_DOCS).select("shingle").toPandas()["shingle"].to_numpy(np.int64)
    return np.sort(hot.view(np.uint64))


def _prefix(shingles: np.ndarray, hot: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles in the common order: those not hot, by hash, then the hot ones."""
    p = prefix_length(len(shingles), percent)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, shingles), len(hot) - 1)
        is_hot = hot[at] == shingles
        cold = shingles[~is_hot]
        if len(cold) >= p:
            return cold[np.argsort(mix(cold))][:p]
        late = shingles[is_hot]
        return np.concatenate([cold[np.argsort(mix(cold))], late[np.argsort(mix(late))]])[:p]
    return shingles[np.argsort(mix(shingles))][:p]


def _end_marks(last: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Where prefixes end in the common order, in 16 bits: a lesser mark ends earlier."""
    late = np.zeros(len(last), bool)
    if len(hot):
        late = hot[np.minimum(np.searchsorted(hot, last), len(hot) - 1)] == last
    return (late.astype(np.uint16) << np.uint16(15)) | (mix(last) >> _U(49)).astype(np.uint16)


def _segment_blobs(tokens, owner, place, keys, sizes, marks, segments: int) -> list[tuple[int, bytes]]:
    segment = (tokens % _U(segments)).astype(np.int64)
    by = np.argsort(segment, kind="stable")
    tokens, owner, place, segment = tokens[by], owner[by], place[by], segment[by]
    cuts = np.flatnonzero(np.diff(segment)) + 1
    out = []
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(tokens)]):
        own = owner[a:b]
        out.append((int(segment[a]), b"".join((
            tokens[a:b].tobytes(), keys[own].tobytes(), sizes[own].astype(np.int32).tobytes(),
            place[a:b].astype(np.int32).tobytes(), marks[own].tobytes(),
        ))))
    return out


# An entry takes as many bytes in few segments as in many: what is sent follows the entries alone.
_FIELDS = (np.int64, np.int64, np.int32, np.int32, np.uint16)


def _read_blob(blob: bytes) -> list[np.ndarray]:
    """Token, set, size, place and end mark of the entries."""
    widths = [np.dtype(kind).itemsize for kind in _FIELDS]
    size = len(blob) // sum(widths)
    return [np.frombuffer(blob, kind, size, size * sum(widths[:i])) for i, kind in enumerate(_FIELDS)]


def least_lists(n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """So many lists similar sets share at least.

    Of the two prefixes one ends first in the common order, and what the sets share beyond that
    prefix is no more than the rest of its set.
    """
    rest = np.maximum(n - prefix_length(n, percent), m - prefix_length(m, percent))
    return needed_overlap(n, m, percent) - rest


def _company(token: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether the list of an entry holds another set of a size that a similar set may have, and
    how many lists the entry's set shares with any of these, if similar, at least.

    Entries are ordered by token and size. The farther the size, the fewer the lists: but for
    rounding, at most 2 here, those of the least and the greatest fitting size bound the others.
    """
    n = n.astype(np.int64)
    group = np.cumsum(np.r_[True, np.diff(token) != 0]) << 32
    low = np.searchsorted(group + n, group - (-percent * n // 100))
    high = np.searchsorted(group + n, group + 100 * n // percent, side="right") - 1
    return high > low, np.minimum(least_lists(n, n[low], percent), least_lists(n, n[high], percent)) - 2


def prefix_lists(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``[token, k, n, pos, mark, rank, listed]``: the index lists, a row per entry.

    With an entry come the number of its set's entries and how many of these stand before it.
    Left out are entries without another set of a fitting size in their list, and those whose set
    has fewer entries than it must share with any such set. Similar sets lose none: a shingle in
    the prefixes of both is listed for both. Entries travel packed, by segments of the tokens; a
    task sends equal sets once.
    """
    hot = _hot_shingles(texts, words)
    segments = 2 * partitions(texts.sparkSession)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, seen = Shingler(words), set()
        tokens, keys, sizes, size = [], [], [], 0

        def flush() -> pd.DataFrame:
            lengths = np.array([len(t) for t in tokens])
            owner = np.repeat(np.arange(len(tokens)), lengths)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            marks = _end_marks(np.array([t[-1] for t in tokens], np.uint64), hot)
            blobs = _segment_blobs(
                np.concatenate(tokens), owner, place, np.array(keys, np.int64), np.array(sizes, np.int64), marks, segments
            )
            return pd.DataFrame(blobs, columns=["segment", "blob"])

        for batch in batches:
            for text in batch["text_"]:
                own = shingler.set_of(text if isinstance(text, str) else None)
                key = set_key(own)
                if not len(own) or key in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(key)
                tokens.append(_prefix(own, hot, percent))
                keys.append(key)
                sizes.append(len(own))
                size += len(tokens[-1])
                if size >= FLUSH:
                    yield flush()
                    tokens, keys, sizes, size = [], [], [], 0
        if tokens:
            yield flush()

    def lists(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [_read_blob(b) for b in frame["blob"]]
        token, k, n, place, mark = (np.concatenate([p[i] for p in parts]) for i in range(5))
        by = np.lexsort((k, token))
        token, k, n, place, mark = token[by], k[by], n[by], place[by], mark[by]
        new = np.r_[True, (np.diff(token) != 0) | (np.diff(k) != 0)]  # equal sets of several tasks
        by = np.flatnonzero(new)
        by = by[np.lexsort((n[by], token[by]))]
        any_, least = _company(token[by], n[by], percent)
        by, least = by[any_], least[any_]
        return pd.DataFrame({
            "token": token[by], "k": k[by], "n": n[by], "pos": place[by], "mark": mark[by].astype(np.int32), "least": least.astype(np.int32),
        })

    blobs = texts.where("id_ is not null and text_ is not null").select("text_").mapInPandas(index, "segment long, blob binary")
    entries = blobs.groupBy("segment").applyInPandas(lists, "token long, k long, n int, pos int, mark int, least int")
    before = Window.partitionBy("k").orderBy("pos")
    listed = F.count("*").over(before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).cast("int")
    entries = entries.withColumn("listed", listed).where("least <= listed").drop("least")
    return entries.withColumn("listed", listed).withColumn("rank", F.row_number().over(before) - 1)


def _possible(a: dict, b: dict, percent: int) -> np.ndarray:
    """Whether the bounds allow the pairs to be similar.

    A prefix shingle that is in no list may still lie beyond the prefix of the other set. It is surely not shared if it stands before the common one, or anywhere in the
    prefix that ends first. So of the shingles before the common one at most the listed ones
    can be shared, and in the prefix that ends first this holds of those after it, too.
    """
    n, m = a["n"].astype(np.int64), b["n"].astype(np.int64)

    def rest(x: dict, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        unlisted = prefix_length(size, percent) - x["pos"] - (x["listed"] - x["rank"])
        return size - x["pos"] - np.where(first, unlisted, 0)

    after = np.minimum(rest(a, n, a["mark"] < b["mark"]), rest(b, m, b["mark"] < a["mark"]))
    return np.minimum(a["rank"], b["rank"]) + after >= needed_overlap(n, m, percent)


_BOUNDS = ("n", "pos", "mark", "rank", "listed")
_PAIR = "a long, b long"


def _pairs_frame(x: np.ndarray, y: np.ndarray) -> pd.DataFrame:
    pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0) if len(x) else np.zeros((0, 2), np.int64)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def _leader_pairs(percent: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        col = {c: frame[c].to_numpy(np.int64) for c in ("token", "k", *_BOUNDS)}
        own = prefix_length(col["n"], percent) - col["listed"]
        by = np.lexsort((col["k"], own, col["token"]))
        col = {c: v[by] for c, v in col.items()}
        starts = np.r_[True, np.diff(col["token"]) != 0]
        leader = np.flatnonzero(starts)[np.cumsum(starts) - 1]
        other = np.flatnonzero(~starts)
        a = {c: v[leader[other]] for c, v in col.items()}
        b = {c: v[other] for c, v in col.items()}
        keep = _possible(a, b, percent)
        return _pairs_frame(a["k"][keep], b["k"][keep])

    return run


def _blocks_apart(col: dict, a: slice, b: slice, percent: int) -> bool:
    """Whether no set of one block of a list can be similar to one of the other.

    What two sets share stands before the common shingle, as far as it is listed, or from it on.
    """
    def on(x: slice) -> int:
        return int((col["n"][x] - col["pos"][x]).max())

    most = min(int(col["rank"][a].max()), int(col["rank"][b].max())) + min(on(a), on(b))
    return most < int(needed_overlap(col["n"][a].min(), col["n"][b].min(), percent))


def _remaining_pairs(percent: int):
    """Pairs of different classes, list by list; blocks whose bounds exclude each other are skipped.

    With each pair come the lists that it shares here, and how many it must share in all.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        col = {c: frame[c].to_numpy(np.int64) for c in ("token", "k", "class", *_BOUNDS)}
        odd = np.frombuffer(b"".join(frame["odd"]), np.uint64).reshape(len(frame), -1)
        by = np.lexsort((col["pos"], col["n"], col["token"]))
        col, odd = {c: v[by] for c, v in col.items()}, odd[by]
        edges = np.r_[np.flatnonzero(np.r_[True, np.diff(col["token"]) != 0]), len(by)]
        xs, ys = [], []
        for start, stop in zip(edges, edges[1:]):
            if (col["class"][start:stop] == col["class"][start]).all():
                continue
            blocks = [(at, min(at + BLOCK, stop)) for at in range(start, stop, BLOCK)]
            for i, (a0, a1) in enumerate(blocks):
                for b0, b1 in blocks[i:]:
                    # Sizes rise along the list: from here on all sets are too large.
                    if 100 * int(col["n"][a1 - 1]) < percent * int(col["n"][b0]):
                        break
                    if _blocks_apart(col, slice(a0, a1), slice(b0, b1), percent):
                        continue
                    x, y = np.meshgrid(np.arange(a0, a1), np.arange(b0, b1), indexing="ij")
                    pick = (x < y) & (col["class"][x] != col["class"][y])
                    x, y = x[pick], y[pick]
                    keep = _possible({c: col[c][x] for c in _BOUNDS}, {c: col[c][y] for c in _BOUNDS}, percent)
                    x, y = x[keep], y[keep]
                    n, m = col["n"][x], col["n"][y]
                    keep = most_overlap(n, m, odd[x], odd[y]) >= needed_overlap(n, m, percent)
                    xs.append(x[keep])
                    ys.append(y[keep])
        if not xs:
            return pd.DataFrame({"a": [], "b": [], "lists": [], "need": []}, dtype=np.int64)
        at, other = np.concatenate(xs), np.concatenate(ys)
        x, y, n, m = col["k"][at], col["k"][other], col["n"][at], col["n"][other]
        ends = np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1)
        pairs, first, lists = np.unique(ends, axis=0, return_index=True, return_counts=True)
        need = least_lists(n, m, percent)[first]
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1], "lists": lists, "need": need})

    return run


_ANSWER = "a long, b long, n long, m long, overlap long"


def _similar(overlap: str, percent: int) -> str:
    return f"100 * ({overlap}) >= {percent} * (n + m - ({overlap}))"


def _wanted(texts: DataFrame, ends: DataFrame) -> DataFrame:
    """The texts of the rows that ``ends`` names by id and hash, and few others, each once.

    A bitmap of MAP_BITS hashed rows sorts most texts out before they move. Its size is fixed: the
    more rows are wanted, the more others pass, at worst all.
    """
    def place(id_: str, h: str):
        return F.pmod(F.xxhash64(id_, h), F.lit(MAP_BITS))

    bit = ends.select(place("id_", "h").alias("bit"))
    held = bit.groupBy(F.shiftright("bit", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    found = texts.withColumn("bit", place("id_", "h")).withColumn("cell", F.shiftright("bit", 6)).join(F.broadcast(held), "cell")
    found = found.where(F.expr("bits & shiftleft(1L, cast(bit & 63 as int)) <> 0"))
    return found.select("id_", "h", "text_").dropDuplicates(["id_", "h"])


def _compared(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """``[a, b, n, m, overlap]``: the pairs with both sizes and what they share.

    Pairs come with the rows ``a_`` and ``b_`` (id, hash) that have the sets. Texts travel, which
    are shorter than their sets; these are made again where both meet.
    """
    ends = pairs.select(F.explode(F.array("a_", "b_")).alias("row")).select("row.id_", "row.h")
    wanted = _wanted(texts, ends)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, made, size = Shingler(words), {}, 0

        def set_of(k: int, text: str) -> np.ndarray:
            nonlocal size
            if k not in made:
                if size > HELD:
                    made.clear()
                    size = 0
                made[k] = shingler.set_of(text)
                size += len(made[k])
            return made[k]

        for batch in batches:
            shared = []
            for a, b, x, y in zip(batch["a"], batch["b"], batch["x"], batch["y"]):
                x, y = set_of(a, x), set_of(b, y)
                few, many = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(many, few), len(many) - 1)
                shared.append((len(x), len(y), int((many[at] == few).sum())))
            n, m, overlap = zip(*shared) if shared else ((), (), ())
            yield batch[["a", "b"]].assign(n=list(n), m=list(m), overlap=list(overlap))

    left = wanted.select(F.col("id_").alias("a_id"), F.col("h").alias("a_h"), F.col("text_").alias("x"))
    right = wanted.select(F.col("id_").alias("b_id"), F.col("h").alias("b_h"), F.col("text_").alias("y"))
    asked = pairs.select(
        "a", "b", F.col("a_.id_").alias("a_id"), F.col("a_.h").alias("a_h"), F.col("b_.id_").alias("b_id"), F.col("b_.h").alias("b_h")
    )
    both = asked.join(left, ["a_id", "a_h"]).join(right, ["b_id", "b_h"])
    return both.select("a", "b", "x", "y").mapInPandas(compare, _ANSWER)


def _derived(pairs: DataFrame, answers: DataFrame, percent: int) -> DataFrame:
    """``[a, b, linked]``: what follows for some pairs from answers computed before; null where nothing does.

    For a set x close to a leader, with its overlap with a third set y known, |x n y| lies between
    |leader n y| less what the leader has beyond x, and |leader n y| and what x has beyond the leader.
    """
    both = answers.unionByName(answers.select(
        F.col("b").alias("a"), F.col("a").alias("b"), F.col("m").alias("n"), F.col("n").alias("m"), "overlap"
    ))
    # One leader a set: the one it shares most with.
    lead = both.where(_similar("overlap", percent)).groupBy("a").agg(
        F.max(F.struct("overlap", F.col("b").alias("leader"), (F.col("m") - F.col("overlap")).alias("gone"), (F.col("n") - F.col("overlap")).alias("new"))).alias("by")
    ).select(F.col("a").alias("x"), "by.leader", "by.gone", "by.new", (F.col("by.overlap") + F.col("by.new")).alias("n"))
    known = both.select(F.col("a").alias("leader"), F.col("b").alias("y"), "m", F.col("overlap").alias("held"))
    asked = pairs.select("a", "b", F.col("a").alias("x"), F.col("b").alias("y")).unionByName(
        pairs.select("a", "b", F.col("b").alias("x"), F.col("a").alias("y"))
    )
    bounds = asked.join(lead, "x").join(known, ["leader", "y"])
    linked = F.when(F.expr(_similar("held - gone", percent)), True).when(~F.expr(_similar("held + new", percent)), False)
    found = bounds.select("a", "b", linked.alias("linked")).groupBy("a", "b").agg(F.bool_or("linked").alias("linked"))
    return pairs.join(found, ["a", "b"], "left").select("a", "b", "linked")


def jaccard_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT, words: int = WORDS
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    Two documents link when 100 * intersection >= percent * union of their shingle sets. Null
    and empty texts and texts without a word have an empty set and link with nothing; their
    component is their own id. Rows without an id link with nothing and have no component.
    Rows that repeat an id are documents of their own: each has the component of its text. The
    order and number of rows do not matter.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("long").alias("id_"), F.col(text_column).cast("string").alias("text_"))
    # Rows may share an id: the hash of the text tells them apart.
    texts = texts.withColumn("h", F.xxhash64("text_"))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        for batch in batches:
            sets = [shingler.set_of(t if isinstance(t, str) else None) for t in batch["text_"]]
            yield pd.DataFrame({
                "id_": batch["id_"], "h": batch["h"], "n": [len(s) for s in sets], "k": [set_key(s) for s in sets],
                "odd": [parities(s) for s in sets],
            })

    # Ids as text, since a batch of numbers with a null becomes one of doubles.
    described = texts.withColumn("id_", F.col("id_").cast("string")).mapInPandas(
        describe, "id_ string, h long, n long, k long, odd binary"
    )
    rows = staged(described.withColumn("id_", F.col("id_").cast("long")), "jaccard-rows")
    sets = rows.where("n > 0 and id_ is not null").groupBy("k").agg(
        F.min(F.struct("id_", "h")).alias("row"), F.first("odd").alias("odd")
    )
    classes = sets.select("k", F.col("row.id_").alias("class"))
    lists = staged(prefix_lists(texts, words, percent), "jaccard-lists")

    def answers_of(pairs: DataFrame) -> DataFrame:
        """Some pairs compared. Only the sets that are in a pair are made again."""
        first, second = (sets.select(F.col("k").alias(c), F.col("row").alias(f"{c}_")) for c in "ab")
        wanted = staged(pairs.select("a", "b").join(first, "a").join(second, "b"), "jaccard-wanted")
        found = staged(_compared(wanted, texts, words), "jaccard-answers")
        discard(wanted)
        return found

    segments = partitions(spark)
    segment = F.pmod("token", F.lit(segments)).alias("segment")
    led = staged(
        lists.select(segment, "token", "k", *_BOUNDS).groupBy("segment")
        .applyInPandas(_leader_pairs(percent), _PAIR).distinct(),
        "jaccard-pairs",
    )
    answers = answers_of(led)
    links = answers.where(_similar("overlap", percent)).select("a", "b")
    joined = components(links, "a", "b")
    of_set = sets.select("k", "odd").join(joined.withColumnRenamed("node", "k"), "k", "left").select(
        "k", "odd", F.coalesce("component", "k").alias("class")
    )
    labelled = lists.join(of_set, "k").select(segment, "token", "k", *_BOUNDS, "class", "odd")
    rest = (
        labelled.groupBy("segment").applyInPandas(_remaining_pairs(percent), f"{_PAIR}, lists long, need long")
        .groupBy("a", "b").agg(F.sum("lists").alias("lists"), F.max("need").alias("need"))
        .where("lists >= need").select("a", "b")
    )
    # Read several times below: written once.
    open_ = staged(rest.join(led, ["a", "b"], "left_anti"), "jaccard-pairs")
    rest = staged(_derived(open_, answers, percent), "jaccard-pairs")
    discard(open_)
    if not rest.isEmpty():
        more = answers_of(rest.where("linked is null").select("a", "b"))
        found = more.where(_similar("overlap", percent)).unionByName(rest.where("linked"), allowMissingColumns=True)
        joined = components(links.unionByName(found.select("a", "b")), "a", "b")
        discard(more)
    discard(lists, led, rest, answers)
    least = joined.join(classes.withColumnRenamed("k", "node"), "node")
    of_class = least.groupBy("component").agg(F.min("class").alias("least"))
    named = least.join(of_class, "component").select(F.col("node").alias("k"), "least")
    by_key = classes.join(named, "k", "left").select("k", F.coalesce("least", "class").alias("component_id"))
    linked = F.when((F.col("n") > 0) & F.col("id_").isNotNull(), F.col("k"))
    return rows.withColumn("k", linked).join(by_key, "k", "left").select(
        F.col("id_").alias(id_column), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id_").alias("component_id"),
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near-duplicate documents."""
    return jaccard_classes(read_table(spark, sf_dir, "documents"))


QUERIES = {"op5_jaccard_join": op5_jaccard_join}
ORACLES: dict[str, str] = {}
