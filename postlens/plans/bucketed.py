"""Contact tables in buckets: profiles, requests and lookups meet them without an exchange.

A user with a large part of all contacts would fill one bucket. Such users are few and known
by name; their contacts are kept apart, in a table sorted for lookups, and joined in slices.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from postlens.operators.contacts import attach_profiles, mirror_contacts
from postlens.operators.skew import heavy_keys
from postlens.plans import contact_query
from postlens.sources.readers import read_table
from postlens.sources.sinks import cluster, write_bucketed, write_table


class BucketedContacts(NamedTuple):
    """``profiles`` in buckets of ``id``, ``mirrored`` contacts in those of ``user2_id``, and the facts:
    ``light`` in buckets of ``user1_id``, ``heavy`` sorted, for the ``heavy_users`` ``[user1_id, slices]``.
    """

    profiles: DataFrame
    mirrored: DataFrame
    light: DataFrame
    heavy: DataFrame
    heavy_users: DataFrame

    def facts(self) -> DataFrame:
        return self.light.unionByName(self.heavy)


def with_profiles(mirrored: DataFrame, profiles: DataFrame) -> DataFrame:
    """Profiles of counterparts from tables in the same buckets: rows stay where they are."""
    return attach_profiles(mirrored, profiles)


def _apart(df: DataFrame, heavy: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the other keys, and rows of the heavy ones. Their list grows with the cluster, not the data."""
    keys = F.broadcast(heavy.select(key))
    return df.join(keys, key, "left_anti"), df.join(keys, key, "left_semi")


def _heavy(df: DataFrame, key: str, share: int | None) -> DataFrame:
    return heavy_keys(df.groupBy(key).agg(F.count("*").alias("n")), [key], "n", share)


def run_bucketed_serving(
    spark: SparkSession, profiles_path: str, scored_path: str, output_path: str, prefix: str, buckets: int,
    share: int | None = None,
) -> None:
    """The serving tables as ``prefix_profiles``, ``prefix_mirrored`` and ``prefix_contact_fact`` of the
    session's catalog, with files below ``output_path``; ``share`` as in ``heavy_keys``.
    """

    def path(name: str) -> str:
        return f"{output_path.rstrip('/')}/{prefix}_{name}"

    mirrored = mirror_contacts(read_table(spark, scored_path))
    write_bucketed(read_table(spark, profiles_path), f"{prefix}_profiles", path("profiles"), ["id"], buckets)
    write_table(_heavy(mirrored, "user2_id", share), path("heavy_counterparts"))
    write_table(_heavy(mirrored, "user1_id", share), path("heavy_users"))
    counterparts, users = (read_table(spark, path(name)) for name in ("heavy_counterparts", "heavy_users"))
    light, hot = _apart(mirrored, counterparts, "user2_id")
    write_bucketed(light, f"{prefix}_mirrored", path("mirrored"), ["user2_id"], buckets)
    profiles = spark.table(f"{prefix}_profiles")
    facts = with_profiles(spark.table(f"{prefix}_mirrored"), profiles).unionByName(attach_profiles(hot, profiles, counterparts))
    write_table(facts, path("facts"))
    light, hot = _apart(read_table(spark, path("facts")), users, "user1_id")
    order = ["user1_id", "user2_id", "created_at"]
    write_bucketed(light, f"{prefix}_contact_fact", path("contact_fact"), ["user1_id"], buckets, order)
    write_table(cluster(hot, order, ["text"]), path("contact_fact_heavy"))


def read_bucketed(spark: SparkSession, output_path: str, prefix: str) -> BucketedContacts:
    """The tables that ``run_bucketed_serving`` has written."""
    base = f"{output_path.rstrip('/')}/{prefix}"
    tables = (spark.table(f"{prefix}_{name}") for name in ("profiles", "mirrored", "contact_fact"))
    return BucketedContacts(*tables, read_table(spark, f"{base}_contact_fact_heavy"), read_table(spark, f"{base}_heavy_users"))


def contact_requests(requests: DataFrame, held: BucketedContacts) -> DataFrame:
    """Ranked contacts for every request: in the buckets for most users, in slices for the heavy ones."""
    slices = held.heavy_users.withColumnRenamed("user1_id", "user_id")
    light = contact_query.contact_requests(requests, held.light, cut_heavy=False)
    return light.unionByName(contact_query.contact_requests(requests, held.heavy, slices))
