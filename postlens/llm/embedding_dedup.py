"""Near-duplicate embeddings by iterative quantisation.

A rotation of the principal components is learned so that signs make balanced codes with
little loss. Codes of several rotations are cut into substrings; every substring is a table
in which vectors with equal bits meet, so that any pair within a few bits meets somewhere.
Pairs that meet are compared by the cosine of their original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from postlens.llm.common import bounded_sample, read_table, staged
from postlens.llm.graph import components

THRESHOLD = 0.9
MISSED = 0.03  # share of pairs at the threshold that may meet in no table
SAMPLE_SLICES, SAMPLE_EACH = 64, 64  # the rotations are learned from at most 4096 vectors
ITERATIONS = 40
TRIALS = 2000  # pairs of a kind on which tables are planned
TRIAL_BITS = 256
MAX_SIZE = 24  # bits of a substring, at most
ROW_COST = 200  # comparisons that take as long as moving a vector to a bucket
BLOCK = 2000  # members of a bucket that are compared at once
SLICES = 8  # of a component, when its classes take its name
GROUP_ROWS = 4000  # rows of a table that are handled together, but for the blocks of large buckets


def learn_rotations(sample: np.ndarray, rotations: int, bits: int, seed: int = 0) -> tuple[np.ndarray, list[np.ndarray]]:
    """Mean and projections; each projection is the principal axes turned by its own rotation."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    v = centred @ axes
    out = []
    for r in range(rotations):
        rotation, _ = np.linalg.qr(np.random.default_rng(seed + r).normal(size=(bits, bits)))
        for _ in range(ITERATIONS):
            left, _, right = np.linalg.svd(np.sign(v @ rotation).T @ v)
            rotation = (left @ right).T
        out.append(axes @ rotation)
    return mean, out


def trial_pairs(sample: np.ndarray, threshold: float, seed: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """Kinds of pairs at the threshold: sampled vectors moved in any direction, the same moved in
    the direction of a difference between two of them, and sampled pairs just above the threshold."""
    rng = np.random.default_rng(seed)
    n, dimensions = sample.shape
    at = rng.integers(0, n, TRIALS)
    a = sample[at]
    kinds = []
    for away in (rng.normal(size=a.shape), sample[rng.integers(0, n, TRIALS)] - sample[rng.integers(0, n, TRIALS)]):
        away = away - (away * a).sum(axis=1, keepdims=True) * a
        norm = np.linalg.norm(away, axis=1, keepdims=True)
        moved = norm[:, 0] > 1e-9
        b = threshold * a[moved] + math.sqrt(1 - threshold**2) * away[moved] / norm[moved]
        if len(b):
            kinds.append((a[moved], b))
    cosines = np.triu(sample @ sample.T, 1)
    x, y = np.nonzero((cosines >= threshold) & (cosines < threshold + (1 - threshold) / 5))
    if len(x) >= TRIALS // 20:
        some = rng.permutation(len(x))[:TRIALS]
        kinds.append((sample[x[some]], sample[y[some]]))
    return kinds


def code_bits(vectors: np.ndarray, mean: np.ndarray, projections: list[np.ndarray]) -> np.ndarray:
    """``bool[n, rotations, bits]``: the codes."""
    return np.stack([(vectors - mean) @ p > 0 for p in projections], axis=1)


def tables_needed(agreement: list[np.ndarray], size: int, missed: float) -> float:
    """Tables with which at most a share ``missed`` of each kind of pairs meets nowhere."""
    tables = 1
    for shares in agreement:
        apart = 1 - shares**size
        while np.mean(apart**tables) > missed:
            tables = math.ceil(tables * 1.05) if tables >= 20 else tables + 1
            if tables > 100_000:
                return math.inf
    return tables


def plan_tables(n: int, sample_bits: np.ndarray, agreement: list[np.ndarray], missed: float = MISSED) -> tuple[int, int]:
    """Bits of a substring, and tables.

    ``agreement`` holds, for each kind of pairs at the threshold, the share of bits in which
    each pair's codes agree, ``sample_bits`` the codes of sampled vectors. Of all sizes that
    is taken with the least work: rows moved, one a vector and table, and comparisons, which
    follow how often the sampled codes share a substring.
    """
    count, rotations, bits = sample_bits.shape
    best = (math.inf, 1, 1)
    for size in range(1, min(bits, MAX_SIZE) + 1):
        tables = tables_needed(agreement, size, missed)
        if tables == math.inf:
            continue
        weights = 1 << np.arange(size)
        met = [
            np.square(np.unique(sample_bits[:, r, :size] @ weights, return_counts=True)[1].astype(float)).sum()
            for r in range(rotations)
        ]
        share = (np.mean(met) - count) / max(1, count * (count - 1))
        best = min(best, (tables * (ROW_COST + n * share), size, tables))
    return best[1], int(best[2])


def learn_tables(sample: np.ndarray, n: int, threshold: float, missed: float = MISSED) -> tuple[np.ndarray, list[np.ndarray], int, int]:
    """Mean, projections, bits of a substring and substrings of a code, for ``n`` vectors.

    Centring widens angles, most where vectors share a direction, so tables are planned from
    how far codes of pairs at the threshold agree, not from their angle. The tables learned
    are tried on these pairs, and rotations are added until enough of each kind meet.
    """
    bits = sample.shape[1]
    kinds = trial_pairs(sample, threshold)
    mean, projections = learn_rotations(sample, max(2, -(-TRIAL_BITS // bits)), bits)
    agreement = [
        np.maximum((code_bits(a, mean, projections) == code_bits(b, mean, projections)).mean(axis=(1, 2)), 1 / TRIAL_BITS)
        for a, b in kinds
    ]
    size, tables = plan_tables(n, code_bits(sample, mean, projections), agreement, missed)
    per_code = max(1, bits // size)
    wanted = -(-tables // per_code)
    if wanted > len(projections):
        projections += learn_rotations(sample, wanted - len(projections), bits, seed=len(projections))[1]
    projections = projections[:wanted]
    apart = [~_meet(a, b, mean, projections, size, per_code) for a, b in kinds]
    while any(x.mean() > missed for x in apart):
        # Learned rotations may come out alike, above all for short vectors; random ones do not.
        turn, _ = np.linalg.qr(np.random.default_rng(1000 + len(projections)).normal(size=(bits, bits)))
        projections.append(turn)
        apart = [x & ~_meet(a, b, mean, [turn], size, per_code) for x, (a, b) in zip(apart, kinds)]
    return mean, projections, size, per_code


def _meet(a: np.ndarray, b: np.ndarray, mean: np.ndarray, projections: list[np.ndarray], size: int, per_code: int) -> np.ndarray:
    return (substrings(a, mean, projections, size, per_code) == substrings(b, mean, projections, size, per_code)).any(axis=1)


def substrings(vectors: np.ndarray, mean: np.ndarray, projections: list[np.ndarray], size: int, per_code: int) -> np.ndarray:
    """``uint32[n, tables]``: the substrings of all codes."""
    weights = (1 << np.arange(size)).astype(np.int64)
    out = []
    for projection in projections:
        bits = ((vectors - mean) @ projection > 0).astype(np.int64)
        out += [bits[:, i * size : (i + 1) * size] @ weights for i in range(per_code)]
    return np.stack(out, axis=1).astype(np.uint32)


def _unit(column: pd.Series) -> np.ndarray:
    rows = np.stack([np.asarray(x, dtype=np.float64) for x in column])
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def vector_classes(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """``[id_, key_, vector_, ok_]``: one row per id and vector, with a key equal vectors share."""
    value = F.col(column).cast("array<double>")
    bad = F.exists("vector_", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists("vector_", lambda x: x != 0)
    rows = vectors.select(F.col(id_column).cast("long").alias("id_"), value.alias("vector_")).withColumn(
        "ok_", F.coalesce(F.col("id_").isNotNull() & ~bad & ~zero, F.lit(False))
    )
    key = F.struct(F.xxhash64(F.lit(1), "vector_").alias("a"), F.xxhash64(F.lit(2), "vector_").alias("b"))
    # -0.0 and 0.0 are the same component.
    rows = rows.withColumn("vector_", F.transform("vector_", lambda x: x + F.lit(0.0)))
    return rows.withColumn("key_", key).dropDuplicates(["id_", "key_"])


def _compare(threshold: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        table = int(frame["table_"].iloc[0])
        frame = frame.sort_values("class_", kind="stable")
        vectors = _unit(frame["vector_"])
        subs = np.stack([np.frombuffer(x, np.uint32) for x in frame["subs_"]])
        ids, sizes = frame["class_"].to_numpy(np.int64), frame["size_"].to_numpy(np.int64)
        own = subs[:, table]
        i, j, block = (frame[c].to_numpy() for c in ("i_", "j_", "block_"))
        where = np.lexsort((j, i, own))
        marks = np.stack([own[where].astype(np.int64), i[where], j[where]])
        cuts = np.flatnonzero((np.diff(marks) != 0).any(axis=0)) + 1
        counts = np.zeros(len(frame), np.int64)
        links = []
        for members in np.split(where, cuts):
            same = i[members[0]] == j[members[0]]
            left = members if same else members[block[members] == i[members[0]]]
            right = members if same else members[block[members] == j[members[0]]]
            for at in range(0, len(left), BLOCK):
                a = left[at : at + BLOCK]
                x, y = np.nonzero(vectors[a] @ vectors[right].T >= threshold)
                x, y = a[x], right[y]
                keep = x < y if same else x != y
                x, y = x[keep], y[keep]
                if table and len(x):  # a pair counts in the first table where it meets
                    first = np.ones(len(x), bool)
                    for t in range(table):
                        first &= subs[x, t] != subs[y, t]
                    x, y = x[first], y[first]
                np.add.at(counts, x, sizes[y])
                np.add.at(counts, y, sizes[x])
                if len(x):
                    links.append(_forest(x, y))
        counted = np.flatnonzero(counts)
        out = [pd.DataFrame({"a": ids[counted], "b": None, "n": counts[counted]})]
        if links:
            x, y = np.concatenate([p[0] for p in links]), np.concatenate([p[1] for p in links])
            out.append(pd.DataFrame({"a": ids[x], "b": ids[y], "n": 0}))
        got = pd.concat(out)
        return got.assign(b=got["b"].astype("Int64"))

    return run


def _forest(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the given links join: each node to the least it is joined with."""
    nodes, both = np.unique(np.concatenate([x, y]), return_inverse=True)
    a, b = both[: len(x)], both[len(x) :]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def link_vectors(
    vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per id and vector: id, n_links, component_id, kept.

    Equal vectors are one class and are compared once; a class counts with all its members.
    Vectors that are null, zero, or hold nulls, NaN or infinities link with nothing, and so do
    rows without an id (their component is null and they are not kept). Rows that repeat id
    and vector are one row. Vectors of different length do not link. Rows that share an id but
    not the vector are vectors of their own, with links and components of their own.
    """
    spark = vectors.sparkSession
    rows = staged(vector_classes(vectors, id_column, column), "vectors")
    good = rows.where("ok_")
    classes = good.groupBy("key_").agg(
        F.min("id_").alias("least_"), F.count("*").alias("size_"), F.first("vector_").alias("vector_")
    )
    # Classes are numbered when they are written; ids may be shared by several of them.
    classes = classes.withColumn("class_", F.monotonically_increasing_id()).withColumn("length_", F.size("vector_"))
    classes = staged(classes, "vector-classes")
    found = None
    lengths = classes.groupBy("length_").count().collect()  # a row per length of vectors
    for length, n in sorted((r["length_"], r["count"]) for r in lengths):
        part = _links_of(spark, classes.where(F.col("length_") == length), length, n, threshold)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "a long, b long, n long")
    found = staged(found, "vector-links")
    joined = components(found.where("b is not null"), "a", "b")
    # A component may hold most classes: it takes its least id in slices.
    sliced = classes.select("class_", "least_").join(joined.withColumnRenamed("node", "class_"), "class_").withColumn(
        "slice_", F.pmod(F.xxhash64("class_"), F.lit(SLICES))
    )
    least = sliced.groupBy("component").agg(F.min("least_").alias("component_")).withColumn(
        "slice_", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLICES - 1).cast("long")))
    )
    named = sliced.join(least, ["component", "slice_"]).select("class_", "component_")
    counts = found.where("b is null").groupBy(F.col("a").alias("class_")).agg(F.sum("n").alias("n"))
    by_class = (
        classes.select("key_", "class_", "size_", "least_")
        .join(counts, "class_", "left")
        .join(named, "class_", "left")
        .select("key_", F.coalesce("component_", "least_").alias("component"), (F.col("size_") - 1 + F.coalesce("n", F.lit(0))).alias("n"))
    )
    out = rows.select("id_", "key_", "ok_").join(by_class, "key_", "left").select(
        F.col("id_").alias(id_column),
        F.when(F.col("ok_"), F.col("n")).otherwise(0).cast("long").alias("n_links"),
        F.when(F.col("ok_"), F.col("component")).otherwise(F.col("id_")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(False)))


def _links_of(spark: SparkSession, classes: DataFrame, length: int, n: int, threshold: float) -> DataFrame:
    """``[a, b, n]``: linked members by class (b null), and links that join the components."""
    marked = classes.select(F.col("key_.a").alias("mark_"), "vector_", F.lit(1).alias("all_"))
    chosen = bounded_sample(marked, "all_", "mark_", SAMPLE_SLICES, SAMPLE_EACH)
    sample = chosen.select("mark_", "vector_").toPandas().sort_values("mark_")
    mean, projections, size, per_code = learn_tables(_unit(sample["vector_"]), n, threshold)
    groups = -(-n // GROUP_ROWS)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                subs = substrings(_unit(batch["vector_"]), mean, projections, size, per_code)
                yield pd.DataFrame({
                    "class_": batch["class_"], "size_": batch["size_"], "vector_": batch["vector_"],
                    "subs_": [s.tobytes() for s in subs], "sub_": [s.astype(np.int32) for s in subs],
                })

    schema = "class_ long, size_ long, vector_ array<double>, subs_ binary, sub_ array<int>"
    coded = staged(classes.select("class_", "size_", "vector_").mapInPandas(encode, schema), "vector-codes")
    met = coded.select("class_", F.posexplode("sub_").alias("table_", "bucket_"))
    busy = met.groupBy("table_", "bucket_").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks_"), F.count("*").alias("m_")).where("m_ > 1")
    # A bucket of several blocks becomes all pairs of its blocks, each a group of its own.
    placed = met.join(busy, ["table_", "bucket_"]).withColumn(
        "block_", F.pmod(F.xxhash64(F.lit(5), "class_"), F.col("blocks_")).cast("int")
    )
    placed = placed.withColumn("other_", F.explode(F.sequence(F.lit(0), F.col("blocks_") - 1))).select(
        "class_", "table_", "bucket_", "block_", F.least("block_", "other_").alias("i_"), F.greatest("block_", "other_").alias("j_"),
        (F.col("blocks_") > 1).alias("large_"),
    )
    group = F.when(F.col("large_"), F.xxhash64("bucket_", "i_", "j_")).otherwise(F.pmod(F.xxhash64("bucket_"), F.lit(groups)))
    full = placed.withColumn("group_", group).join(coded.select("class_", "size_", "vector_", "subs_"), "class_")
    return full.select("table_", "group_", "i_", "j_", "block_", "class_", "size_", "vector_", "subs_").groupBy(
        "table_", "group_"
    ).applyInPandas(_compare(threshold), "a long, b long, n long")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return link_vectors(read_table(spark, sf_dir, "embeddings"))


QUERIES = {"op2_embedding_dedup": op2_embedding_dedup}
ORACLES: dict[str, str] = {}
