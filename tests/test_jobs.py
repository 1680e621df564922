import json

import pytest
from pyspark.sql import functions as F

from postlens.operators.contacts import contacts_of
from postlens.plans import contact_jobs, contact_query, topic_jobs, topic_query
from postlens.sources.readers import read_table
from postlens.sources.sinks import cluster, table_path, write_jdbc, write_table
from postlens.sources.staging import shared_folder, stage
from test_clean import TIME, post


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    later = TIME.replace("20:19:24", "20:30:00")
    user = lambda i: {"id": i, "id_str": str(i), "screen_name": f"u{i}", "description": f"d{i}", "followers_count": 10}
    posts = [
        post(id=1, user=user(1), in_reply_to_user_id=2, text="hello cloud darn world"),
        post(id=1, user=user(1), in_reply_to_user_id=2, text="hello cloud darn world"),
        post(id=2, user=user(2), in_reply_to_user_id=None, text="RT cloud cloud", created_at=later,
             retweeted_status={"id": 1, "user": user(1)}),
        post(id=3, user=user(1), in_reply_to_user_id=3, text="cloudy the day"),
        post(id=4, user=user(4), in_reply_to_user_id=None, text="no contact here"),
        post(id=5, user=user(4), in_reply_to_user_id=4, lang="fr", text="moi"),
    ]
    (base / "posts.json").write_text("\n".join(map(json.dumps, posts)) + "\n{broken\n")
    (base / "stop.txt").write_text("the\nno\n")
    (base / "censor.txt").write_text("qnea\n\n")
    out = str(base / "out")
    contact_jobs.run_contact_etl(spark, str(base / "posts.json"), out)
    contact_jobs.run_contact_serving(spark, f"{out}/profiles", f"{out}/contact_scored", out)
    topic_jobs.run_topic_etl(spark, str(base / "posts.json"), str(base / "stop.txt"), str(base / "censor.txt"), out, "v2")
    return out


def test_contact_tables(spark, paths):
    scored = read_table(spark, f"{paths}/contact_scored")
    assert sorted((r["user1_id"], r["user2_id"], r["text"]) for r in scored.collect()) == [
        (1, 2, "hello cloud darn world"), (1, 3, "cloudy the day"), (2, 1, "RT cloud cloud"),
    ]
    profiles = read_table(spark, f"{paths}/profiles")
    assert {r["id"]: r["screen_name"] for r in profiles.collect()} == {1: "u1", 2: "u2"}


def test_contact_query_on_the_stored_table(spark, paths):
    facts = read_table(spark, f"{paths}/contact_fact")
    assert facts.count() == 6
    got = contact_query.contact_rank(facts, 1, "cloud", 2).collect()
    assert [(r["user2_id"], r["phrase_hits"], round(r["score"], 6), r["screen_name"]) for r in got] == [
        (2, 3, 9.545177, "u2"), (3, 0, 2.098612, ""),
    ]
    plan = contacts_of(facts, 1)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user1_id,1)" in plan


def test_topic_tables(spark, paths):
    posts = read_table(spark, f"{paths}/scored_posts_v2")
    got = {r["post_id"]: (r["censored_text"], r["impact"]) for r in posts.collect()}
    assert got == {
        1: ("hello cloud d**n world", 4 * 15), 2: ("RT cloud cloud", 3 * 15),
        3: ("cloudy the day", 2 * 15), 4: ("no contact here", 2 * 15),
    }
    words = read_table(spark, f"{paths}/post_words_v2")
    assert words.where("word = 'the'").count() == 0
    assert [tuple(r) for r in words.where("post_id = 2").select("word", "cnt", "num_words").orderBy("word").collect()] == [
        ("cloud", 2, 3), ("rt", 1, 3),
    ]
    from_words = topic_query.topic_words(posts, 0, 99, 0, 2**40, 5, words_table=words).collect()
    assert sorted(from_words) == sorted(topic_query.topic_words(posts, 0, 99, 0, 2**40, 5, ["the", "no"]).collect())


def test_clustered_tables_cut_a_hot_key(spark, tmp_path):
    df = spark.range(20000).selectExpr("if(id % 3 = 0, 0, id) as user_id", "id as created_at", "id as post_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        clustered = cluster(df.repartition(6), ["user_id", "created_at"], ["post_id"])
        per_task = clustered.groupBy(F.spark_partition_id()).count().collect()
        write_table(clustered, str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in per_task]
    assert sum(sizes) == 20000 and max(sizes) < 20000 / 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20000


def test_paths():
    assert table_path("base/", "t") == "base/t"
    assert table_path("base", "t", "v1") == "base/t_v1"


def test_staging_uses_the_folder_of_the_session(spark):
    folder = shared_folder(spark, "elsewhere")
    assert folder == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(5), "numbers")
    assert staged.count() == 5
    assert all(folder in f for f in staged.inputFiles())


class Recorder:
    """Stands in for a table and its writer: no database is started for tests."""

    def __init__(self):
        self.options, self.calls = {}, []

    write = property(lambda self: self)

    def mode(self, mode):
        self.options["mode"] = mode
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def repartition(self, n):
        self.options["repartition"] = n
        return self

    def jdbc(self, url, table, properties):
        self.calls.append((url, table, properties))

    def drop(self, *columns):
        self.options["dropped"] = columns
        return self


def test_jdbc_settings():
    df = Recorder()
    write_jdbc(df, "jdbc:x", "t", {"user": "u"}, "a bigint", connections=4)
    assert df.calls == [("jdbc:x", "t", {"user": "u"})]
    assert df.options == {
        "repartition": 4, "mode": "overwrite", "numPartitions": 4, "batchsize": 5000, "truncate": "false",
        "createTableColumnTypes": "a bigint",
    }
    kept = Recorder()
    write_jdbc(kept, "jdbc:x", "t", {}, "a bigint", keep_table=True)
    assert kept.options["truncate"] == "true" and "createTableColumnTypes" not in kept.options


def test_topic_export_leaves_the_censored_text_out():
    df = Recorder()
    topic_jobs.export_topics(df, "jdbc:x", "topics", {}, "clob")
    assert df.options["dropped"] == ("censored_text",)
    assert "text clob" in df.options["createTableColumnTypes"]
