"""Bucketed contact tables and word postings."""

import glob
import random
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from postlens.operators import contacts as c, topics
from postlens.plans import bucketed, contact_query, topic_query
from postlens.sources.sinks import write_table
from test_plans import plan_of
from test_topics import CENSOR, make_posts

FACT = "user1_id long, user2_id long, text string, created_at long, intimacy_score double"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Contacts of which one user has a third, in buckets."""
    rng = random.Random(1)
    rows = {(1 if i % 3 == 0 else rng.randint(2, 60), rng.randint(61, 120), f"the t{rng.randint(0, 400)}") for i in range(3000)}
    scored = spark.createDataFrame([(*r, hash(r) % 1000, 1.5) for r in sorted(rows)], FACT)
    profiles = spark.createDataFrame([(i, f"n{i}", "d") for i in range(1, 121, 2)], "id long, screen_name string, description string")
    out = str(tmp_path_factory.mktemp("buckets"))
    scored.write.parquet(f"{out}/contact_scored")
    profiles.write.parquet(f"{out}/profiles")
    prefix = f"t{uuid.uuid4().hex}"
    bucketed.run_bucketed_serving(spark, f"{out}/profiles", f"{out}/contact_scored", out, prefix, buckets=4, share=8)
    # So that plans show what they do with buckets and filters, in full.
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
        "spark.sql.maxMetadataStringLength": "5000",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield bucketed.read_bucketed(spark, out, prefix), c.contact_fact(scored, profiles)
    for key in settings:
        spark.conf.unset(key)
    for name in ("profiles", "mirrored", "contact_fact"):
        spark.sql(f"drop table if exists {prefix}_{name}")


def _rows(df, like):
    return sorted(map(str, df.select(*like.columns).collect()))


def test_bucketed_tables_hold_the_facts(tables):
    held, facts = tables
    assert _rows(held.facts(), facts) == _rows(facts, facts)
    assert [r["user1_id"] for r in held.heavy_users.collect()] == [1]
    assert held.light.where("user1_id = 1").count() == 0 < held.heavy.count()


def test_profiles_are_joined_without_an_exchange(spark, tables):
    held, _ = tables
    plan = plan_of(bucketed.with_profiles(held.mirrored, held.profiles))
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_lookups_open_one_bucket(tables):
    held, facts = tables
    own = c.contacts_of(held.facts(), 7)
    assert "SelectedBucketsCount: 1 out of 4" in plan_of(own)
    for user in (1, 7):
        assert _rows(c.contacts_of(held.facts(), user), facts) == _rows(c.contacts_of(facts, user), facts)


def test_requests_do_not_move_the_facts(spark, tables):
    held, facts = tables
    requests = spark.createDataFrame(
        [(i, str(u), p, str(n)) for i, (u, p, n) in enumerate([(1, "the", 3), (7, "the", 5), (8, "t1", 2), (1, "t7", 9), (99, "x", 1), (0, "", 1)])],
        "request_id long, user_id string, phrase string, n string",
    )
    got = bucketed.contact_requests(requests, held)
    want = contact_query.contact_requests(requests, facts)
    assert _rows(got, want) == _rows(want, want)
    light = plan_of(contact_query.contact_requests(requests, held.light, cut_heavy=False))
    # Requests are dealt out to the buckets of their users, the facts stay where they are.
    scans = [line for line in light.splitlines() if "Bucketed: true" in line]
    assert scans and all("Exchange" not in line for line in scans)
    assert light.count("Exchange hashpartitioning(user2_id") == 0


def test_postings_are_read_for_the_top_words_alone(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    posts = spark.createDataFrame(make_posts(3000, 3), "post_id long, user_id long, created_at long, text string, impact long")
    words = topics.post_words(posts)
    path = str(tmp_path / "postings")
    write_table(topic_query.postings(words), path, row_group_bytes=4_000)
    stored = spark.read.parquet(path)
    span = (0, 40, 0, 5000)
    got = topic_query.topic_posts(posts, *span, 2, 9, (), CENSOR, words_table=words, postings=stored)
    assert sorted(got.collect()) == sorted(topic_query.topic_posts(posts, *span, 2, 9, (), CENSOR).collect())
    top = [r["word"] for r in topic_query.topic_words(posts, *span, 2, words_table=words).collect()]
    assert all(f"EqualTo(word,{w})" in plan_of(got) for w in top)
    groups = []
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.to_arrow_schema().get_field_index("word")
        groups += [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
    hit = [g for g in groups if any(g.min <= w <= g.max for w in top)]
    assert len(groups) > 10 and len(hit) < len(groups) / 3
    # More words than a filter should list are joined instead.
    many = topic_query.topic_posts(posts, *span, 500, 9, words_table=words, postings=stored)
    assert "EqualTo(word" not in plan_of(many)
    assert sorted(many.collect()) == sorted(topic_query.topic_posts(posts, *span, 500, 9).collect())
