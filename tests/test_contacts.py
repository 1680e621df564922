import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import phrase_hits
from postlens.operators import contacts as c, nesting
from postlens.operators.skew import heavy_keys, salted_join, top_per_group
from postlens.plans import contact_query as q, reports

SCHEMA = (
    "post_id long, user1_id long, user2_id long, kind string, text string, created_at long, "
    "screen_name string, description string, reshared_user_id long, reshared_screen_name string, "
    "reshared_description string"
)


@pytest.fixture(scope="module")
def posts(spark):
    rows = [
        (101, 1, 2, "reply", "hello cloud world", 100, "one", "first", None, None, None),
        (102, 2, 1, "reshare", "RT cloud cloud", 200, "two", "second", 1, "uno", None),
        (103, 1, 3, "reply", "cloudy day", 150, "one-b", "", None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def facts(posts):
    return c.contact_fact(c.score_contacts(posts), c.latest_profile(c.profiles_seen(posts)))


def test_pair_weights_and_scores(posts):
    weights = {(r[0], r[1]): r[2] for r in c.pair_weight(posts).collect()}
    assert weights == {(1, 2): 3, (1, 3): 2}
    scores = {(r[0], r[1]): round(r[2], 6) for r in c.pair_scores(c.pair_weight(posts)).collect()}
    assert scores == {(1, 2): 2.386294, (2, 1): 2.386294, (1, 3): 2.098612, (3, 1): 2.098612}


def test_equal_texts_weigh_twice_but_are_listed_once(posts):
    again = posts.union(posts.where("post_id = 101").withColumn("post_id", F.lit(104)).withColumn("created_at", F.lit(120)))
    got = {(r[0], r[1], r[2]): (r[3], round(r[4], 6)) for r in c.score_contacts(again).collect()}
    assert len(got) == 3
    assert got[(1, 2, "hello cloud world")] == (120, round(1 + math.log(6), 6))


def test_latest_profile(posts):
    got = {r[0]: (r[1], r[2]) for r in c.latest_profile(c.profiles_seen(posts)).collect()}
    assert got == {1: ("uno", None), 2: ("two", "second")}


def test_profile_ties_and_empty_profiles(spark):
    seen = spark.createDataFrame(
        [(1, None, "z", 5), (1, "a", None, 5), (1, "b", "x", 4), (2, "n", None, 1), (2, "n", "d", 1)],
        "id long, screen_name string, description string, created_at long",
    )
    got = {r[0]: (r[1], r[2]) for r in c.latest_profile(seen).collect()}
    assert got == {1: ("a", None), 2: ("n", "d")}
    empty = spark.createDataFrame([(9, 4, 5, "reply", "t", 1, "", None, None, None, None)], SCHEMA)
    assert c.profiles_seen(empty).count() == 0


def test_both_users_see_a_contact(facts):
    got = sorted((r["user1_id"], r["user2_id"], r["text"]) for r in facts.collect())
    assert got == [
        (1, 2, "RT cloud cloud"), (1, 2, "hello cloud world"), (1, 3, "cloudy day"),
        (2, 1, "RT cloud cloud"), (2, 1, "hello cloud world"), (3, 1, "cloudy day"),
    ]


def test_contact_rank(facts):
    got = [tuple(r) for r in q.contact_rank(facts, 1, "cloud", 2).collect()]
    assert [(r[0], r[1], r[2], r[4], r[5], round(r[6], 6)) for r in got] == [
        (1, 2, "two", "RT cloud cloud", 3, 9.545177),
        (2, 3, "", "cloudy day", 0, 2.098612),
    ]
    assert q.contact_rank(facts, "1", "cloud", "1").count() == 1


@pytest.mark.parametrize("user,phrase,n", [
    (None, "a", 1), ("x", "a", 1), (1, "", 1), (1, None, 1), (1, "a", 0), (1, "a", -3), (1, "a", "1.5"),
    (2**63, "a", 1), (1, "a", 2**31), ("", "a", 1),
])
def test_bad_arguments_give_an_empty_ranking(facts, user, phrase, n):
    empty = q.contact_rank(facts, user, phrase, n)
    assert empty.count() == 0
    assert empty.columns == q.contact_rank(facts, 1, "a", 1).columns


def test_contact_report(facts):
    text = reports.format_contacts(q.contact_rank(facts, 1, "cloud", 2)).first()[0]
    assert text == "two\tsecond\tRT cloud cloud\n\t\tcloudy day"
    assert reports.format_contacts(q.contact_rank(facts, 77, "cloud", 2)).first()[0] == ""


def make_facts(spark, users=12, rows=400, seed=5):
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        u1 = 1 if i % 3 == 0 else rng.randint(1, users)
        u2 = rng.randint(users + 1, users + 6)
        text = " ".join(rng.choices(["the", "cloud", "of the", "x"], k=rng.randint(1, 6)))
        data.append((u1, u2, text, rng.randint(0, 50), 1 + math.log(1 + u2), f"n{u2}", None))
    return data, spark.createDataFrame(
        data,
        "user1_id long, user2_id long, text string, created_at long, intimacy_score double, "
        "user2_screen_name string, user2_desc string",
    )


def test_request_tables_agree_with_single_requests(spark):
    data, facts = make_facts(spark)
    requests = [(i, str(1 + i % 13), ["the", "of the", "cloud x"][i % 3], str(i % 5)) for i in range(40)]
    requests += [(100, "abc", "the", "3"), (101, "1", "", "3"), (102, "1", "the", "-1"), (103, " 1", "the", "3"), (104, None, "the", "1")]
    table = spark.createDataFrame(requests, "request_id long, user_id string, phrase string, n string")
    got = {}
    for r in q.contact_requests(table, facts).collect():
        got.setdefault(r["request_id"], []).append((r["rank"], r["user2_id"], r["text"], r["phrase_hits"], round(r["score"], 6)))
    want = {}
    for rid, user, phrase, n in requests[:40]:
        per = {}
        for u1, u2, text, at, s, _, _ in data:
            if u1 == int(user):
                per.setdefault((u2, s), []).append((phrase_hits(text, phrase), at, text))
        ranked = sorted(((s * (sum(h for h, _, _ in v) + 1), u2, max(v)[2], sum(h for h, _, _ in v)) for (u2, s), v in per.items()),
                        key=lambda x: (-x[0], x[1]))[: int(n)]
        if ranked:
            want[rid] = [(i + 1, u2, text, hits, round(score, 6)) for i, (score, u2, text, hits) in enumerate(ranked)]
    assert {k: sorted(v) for k, v in got.items()} == want


def test_nesting_keeps_every_text(spark):
    data, facts = make_facts(spark)
    facts = facts.withColumn("created_at", F.col("created_at") * 86400)
    nested = nesting.nest_contacts(facts)
    assert nested.groupBy(*nesting.KEYS).count().where("count > 1").count() == 0
    assert sorted({r["month"] for r in nested.collect()}) == ["1970-01", "1970-02"]
    flat = nesting.flatten_json_contacts(nesting.contacts_from_json(nesting.contacts_to_json(nested)))
    got = sorted((r["user1_id"], r["user2_id"], r["text"], r["created_at"], r["user2_desc"]) for r in flat.collect())
    assert got == sorted((d[0], d[1], d[2], d[3] * 86400, "") for d in data)


def test_nesting_reads_the_facts_once(spark):
    _, facts = make_facts(spark, rows=10)
    plan = nesting.nest_contacts(facts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_heavy_keys_are_few_and_the_join_is_whole(spark):
    facts = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"), F.col("id").alias("row")
    )
    counts = facts.groupBy("key").agg(F.count("*").alias("n"))
    heavy = heavy_keys(counts, ["key"], "n", share=50)
    rows = heavy.collect()
    assert [r["key"] for r in rows] == [-1] and 1 < rows[0]["slices"] <= 50
    lookup = counts.where("key % 2 <> 0").select("key", (F.col("key") * 10).alias("value"))
    plain = facts.join(lookup, "key", "left")
    salted = salted_join(facts, lookup, ["key"], heavy, ["row"], "left")
    assert salted.count() == 30000
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_top_per_group_is_exact(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("g"),
        ((F.col("id") * 37) % 997).alias("v"), "id", ((F.col("id") % 3 * 0) + 4).cast("int").alias("n"),
    )
    top = top_per_group(df, ["g"], [F.desc("v"), F.asc("id")], F.col("n"), ["id"])
    got = sorted((r["g"], r["rank"], r["id"]) for r in top.collect())
    by_group = {}
    for r in df.collect():
        by_group.setdefault(r["g"], []).append((-r["v"], r["id"]))
    want = sorted((g, i + 1, x[1]) for g, xs in by_group.items() for i, x in enumerate(sorted(xs)[:4]))
    assert got == want
