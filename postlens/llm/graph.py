"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from postlens.llm.common import discard, staged

MAX_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # For an edge u > v, only v has u as a greater neighbour.
    joined = edges.select(F.col("v").alias("u"), F.col("u").alias("other")).join(least, "u")
    return joined.select(F.col("other").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``[node, component]``: the least node reachable, for all nodes that have a link.

    Alternates large-star and small-star steps, each of which is a minimum by node and a join,
    until nothing changes. Every round is written, so a lost executor costs one round at most.
    Links with a null end and loops are left out.
    """
    edges = staged(
        links.where(f"{a} is not null and {b} is not null")
        .select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
        .where("u > v").distinct(),
        "links",
    )
    mark = None
    for _ in range(MAX_ROUNDS):
        before, edges = edges, staged(_small_star(_large_star(edges)), "links")
        discard(before)
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if mark == now:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
