"""Stored layouts: what lookups have to read, and what travels."""

import glob
import json
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from postlens.operators import nesting
from postlens.sources import readers
from postlens.sources.sinks import cluster, cluster_on_curve, curve_position, write_table
from test_clean import post


def _row_groups(path, column):
    """Least and greatest value of a column in every row group."""
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.to_arrow_schema().get_field_index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            yield stats.min, stats.max


def _share_read(path, column, low, high):
    groups = list(_row_groups(path, column))
    return sum(a <= high and b >= low for a, b in groups) / len(groups)


def test_filters_on_either_column_skip_row_groups(spark, tmp_path):
    """Users are skewed: one has a third of all rows."""
    rows = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, 5L, cast(pmod(xxhash64(id), 4000) as bigint)) as user_id",
        "cast(pmod(xxhash64(id, 1), 1000000) as bigint) as created_at", "id as post_id",
    )
    by = ["user_id", "created_at"]
    # With so few rows, adaptive execution would put all ranges in one file.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_table(cluster_on_curve(rows, by, ["post_id"]), str(tmp_path / "curve"), row_group_bytes=8_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    write_table(cluster(rows, by, ["post_id"]), str(tmp_path / "sorted"), row_group_bytes=8_000)
    curve, plain = str(tmp_path / "curve"), str(tmp_path / "sorted")
    assert len(list(_row_groups(curve, "user_id"))) > 60
    assert _share_read(curve, "user_id", 2000, 2050) < 0.25
    assert _share_read(curve, "created_at", 500_000, 510_000) < 0.25
    # Sorting prunes by the first column alone.
    assert _share_read(plain, "created_at", 500_000, 510_000) > 0.6
    stored = spark.read.parquet(curve)
    assert stored.count() == 60_000 and stored.exceptAll(rows.select(*stored.columns)).count() == 0
    hot = stored.where("user_id = 5").groupBy(F.input_file_name()).count().count()
    assert hot > 1


def test_curve_positions(spark):
    df = spark.range(64).selectExpr("cast(id % 8 as int) as a", "cast(floor(id / 8) as int) as b")
    for r in df.withColumn("z", curve_position([F.col("a"), F.col("b")], 3)).collect():
        want = sum(((r.a >> i & 1) << (2 * i)) | ((r.b >> i & 1) << (2 * i + 1)) for i in range(3))
        assert r.z == want


def test_curve_of_odd_tables(spark):
    for rows in ([], [(None, 1)], [(1, None), (None, None), (1, 2)], [(7, 7)] * 20):
        df = spark.createDataFrame(rows, "a long, b long")
        assert sorted(cluster_on_curve(df, ["a", "b"]).collect(), key=str) == sorted(df.collect(), key=str)


def test_rejected_lines_have_reasons(spark):
    good = json.dumps(post(id=1))
    lines = [good, "", "   ", None, "{broken", "[1]", "3", "null", good[:-5], json.dumps(post(id="x")), json.dumps(post(entities=3)),
             json.dumps(post(user={"id": "u"})), json.dumps(post(id=2))]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [(r["value"], r["reason"]) for r in readers.rejected_lines(df).collect()]
    assert sorted(got, key=str) == sorted([
        ("", "blank"), ("   ", "blank"), (None, "blank"), ("{broken", "no json"), ("[1]", "no object"), ("3", "no object"),
        ("null", "no object"), (good[:-5], "no json"), (json.dumps(post(id="x")), "field id"), (json.dumps(post(entities=3)), "field entities"),
        (json.dumps(post(user={"id": "u"})), "field user"),
    ], key=str)
    assert readers.parse_posts(df).count() + len(got) == len(lines)


def test_contact_lists_hold_all_counterparts(spark):
    rng = random.Random(4)
    rows = sorted({(rng.randint(1, 3), rng.randint(1, 90), f"t{rng.randint(0, 9)}", rng.randint(0, 10**7)) for _ in range(900)})
    facts = spark.createDataFrame(
        [(*r, r[1] / 2, None if r[1] % 5 == 0 else f"n{r[1]}", "d") for r in rows],
        "user1_id long, user2_id long, text string, created_at long, intimacy_score double, user2_screen_name string, user2_desc string",
    )
    nested = nesting.nest_contacts(facts, chunks=8).persist()
    assert nested.groupBy(*nesting.KEYS).count().where("count > 1").count() == 0
    # A row holds several counterparts, and no chunk of a month holds more than its share of them.
    sizes = [len(r["contacts"]) for r in nested.collect()]
    assert 1 < max(sizes) <= 30
    chunks = nested.select("chunk", F.explode("contacts.user2_id").alias("u")).distinct().groupBy("u").count()
    assert chunks.where("count > 1").count() == 0
    for user in (1, 2, 3, 4):
        got = [c.asDict(recursive=True) for r in nesting.contact_list(nested, user).collect() for c in r["contacts"]]
        want = []
        for u2 in sorted({r[1] for r in rows if r[0] == user}):
            posts = sorted((at, text) for u, v, text, at in rows if (u, v) == (user, u2))
            want.append({
                "user2_id": u2, "user2_screen_name": None if u2 % 5 == 0 else f"n{u2}", "user2_desc": "d", "intimacy_score": u2 / 2,
                "posts": [{"created_at": at, "text": text} for at, text in posts],
            })
        assert got == want
