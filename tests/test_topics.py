import random

import pytest
from pyspark.sql import functions as F

import helpers as plain
from postlens.operators import dictionaries, topics
from postlens.plans import reports, topic_query as q, topic_requests as r
from postlens.plans.topic_jobs import score_posts

STOP = ["is", "please", "give", "me", "another"]
CENSOR = ["darn"]
ALL = (0, 10**12, 0, 10**12)
POSTS = [
    (1, "rain gauges is quiet 1809", 19),
    (2, "please give me me s-l-o-w rain'gauges", 53),
    (3, "another walk, rain darn http://t.co/x quiet", 3),
]


@pytest.fixture(scope="module")
def posts(spark):
    rows = [(i, 10 * i, 100 * i, text, impact) for i, text, impact in POSTS]
    return spark.createDataFrame(rows, "post_id long, user_id long, created_at long, text string, impact long")


def make_posts(count=120, seed=11):
    rng = random.Random(seed)
    vocabulary = ["cloud", "Cloud", "is", "a-b", "x1", "77", "darn", "http://t.co/a", "me", "it's", "rain"] + [f"w{i}" for i in range(30)]
    return [(i, rng.randint(0, 40), rng.randint(0, 5000), " ".join(rng.choices(vocabulary, k=rng.randint(0, 15))), rng.randint(0, 60))
            for i in range(count)]


@pytest.fixture(scope="module")
def many(spark):
    return spark.createDataFrame(make_posts(), "post_id long, user_id long, created_at long, text string, impact long")


def ranking(df):
    return [(x["word"], x["posts"], x["score"]) for x in df.orderBy("rank").collect()]


def test_topic_words(posts):
    got = q.topic_words(posts, *ALL, 6, STOP, CENSOR).orderBy("rank").collect()
    assert [(x["shown_word"], x["score"]) for x in got] == [
        ("gauges", 0.822787), ("rain'gauges", 0.730391), ("s-l-o-w", 0.730391),
        ("quiet", 0.416085), ("rain", 0.416085), ("d**n", 0.3046),
    ]
    assert [x["rank"] for x in got] == [1, 2, 3, 4, 5, 6]


def test_topic_posts(posts):
    got = q.topic_posts(posts, *ALL, 2, 5, STOP, CENSOR).orderBy("rank").collect()
    assert [(x["post_id"], x["impact"]) for x in got] == [(2, 53), (1, 19)]
    got = q.topic_posts(posts, *ALL, 6, 5, STOP, CENSOR).orderBy("rank").collect()
    assert [x["post_id"] for x in got] == [2, 1, 3]
    assert got[2]["text"] == "another walk, rain d**n http://t.co/x quiet"
    assert q.topic_posts(posts, *ALL, 6, 0, STOP, CENSOR).count() == 0


def test_equal_impacts_put_the_higher_id_first(spark):
    rows = [(1, 0, 0, "tea", 3), (2, 0, 0, "tea", 5), (3, 0, 0, "tea", 3), (4, 0, 0, "", 9)]
    df = spark.createDataFrame(rows, "post_id long, user_id long, created_at long, text string, impact long")
    got = q.topic_posts(df, *ALL, 5, 5).orderBy("rank").collect()
    assert [x["post_id"] for x in got] == [2, 3, 1]


def test_topic_report(posts):
    text = reports.topic_report(posts, *ALL, 2, 1, stop=STOP, censor=CENSOR).first()[0]
    assert text == "gauges:0.82\train'gauges:0.73\n53\t2\tplease give me me s-l-o-w rain'gauges"
    assert reports.topic_report(posts, *ALL, 1, 0, stop=STOP).first()[0] == "gauges:0.82\n"
    assert reports.topic_report(posts, 900, 901, 0, 1, 2, 2).first()[0] == ""
    assert reports.topic_report(posts, 2, 1, 0, 1, 2, 2).first()[0] == ""


def test_large_impacts_are_shown_clamped_and_scores_round_half_up(spark):
    words = spark.createDataFrame([(1, "a", 0.125), (2, "b", 1.0)], "rank int, shown_word string, score double")
    assert reports.word_line(words).first()[0] == "a:0.13\tb:1.00"
    posts = spark.createDataFrame([(1, 5, 2**40, "t")], "rank int, post_id long, impact long, text string")
    assert reports.post_lines(posts).first()[0] == "2147483647\t5\tt"


@pytest.mark.parametrize("bad", [
    (2, 1, 0, 9, 5, 5), (0, 9, 2, 1, 5, 5), (0, 9, 0, 9, 0, 5), (0, 9, 0, 9, 5, -1),
    (None, 9, 0, 9, 5, 5), (0, "x", 0, 9, 5, 5), (0, 9, 0, 2**63, 5, 5), (0, 9, 0, 9, 2**31, 5),
])
def test_bad_arguments_give_empty_results(posts, bad):
    assert q.topic_posts(posts, *bad).count() == 0
    if bad[5] == 5:
        assert q.topic_words(posts, *bad[:5]).count() == 0


def test_topic_queries_agree_with_the_rules(many):
    span = (5, 30, 500, 4500)
    chosen = [(i, t, m) for i, u, at, t, m in make_posts() if 5 <= u <= 30 and 500 <= at <= 4500]
    want = [(w, n, round(s, 6)) for w, n, s in plain.topic_words(chosen, STOP, 12)]
    assert ranking(q.topic_words(many, *span, 12, STOP)) == want
    posts = q.topic_posts(many, *span, 12, 7, STOP, CENSOR).orderBy("rank").collect()
    assert [(x["post_id"], x["impact"], x["text"]) for x in posts] == [
        (i, m, plain.censor(t, CENSOR)) for i, t, m in plain.topic_posts(chosen, STOP, 12, 7)
    ]


def test_stored_words_and_texts_give_the_same_answer(many):
    stored = topics.post_words(many, STOP)
    span = (0, 40, 0, 5000)
    assert ranking(q.topic_words(many, *span, 15, words_table=stored)) == ranking(q.topic_words(many, *span, 15, STOP))
    from_words = q.topic_posts(many, *span, 3, 9, STOP, words_table=stored).collect()
    assert sorted(from_words) == sorted(q.topic_posts(many, *span, 3, 9, STOP).collect())


def test_the_other_variant_leaves_out_posts_without_impact(many):
    rows = [(i, t, m - 1) for i, _, _, t, m in make_posts() if m > 0]
    want = [(w, n, round(s, 6)) for w, n, s in plain.topic_words(rows, STOP, 10)]
    assert ranking(q.topic_words(many, *ALL, 10, STOP, variant="ln_impact")) == want
    with pytest.raises(ValueError):
        q.topic_words(many, *ALL, 10, variant="ln")


def test_tables_and_collections_mean_the_same(spark):
    words = ["Darn", "darn", "", None, "iS"]
    table = spark.createDataFrame([(w,) for w in words], "word string")
    assert dictionaries.normal_words(words) == ["darn", "is"]
    assert sorted(r[0] for r in dictionaries.normal_words(table).collect()) == ["darn", "is"]
    # Rows may share an id, and texts may repeat.
    rows = [(1, "ab Danny x"), (1, "darn DARN it is"), (2, "darn DARN it is"), (3, None), (3, ""), (4, "d-darn")]
    posts = spark.createDataFrame(rows, "post_id long, text string")
    key = lambda r: tuple(str(x) for x in r)
    for step in (dictionaries.with_censored_text, dictionaries.with_effective_words):
        assert sorted(step(posts, table).collect(), key=key) == sorted(step(posts, words).collect(), key=key)
    top = spark.createDataFrame([("darn",), ("is",), ("ok",)], "word string")
    assert sorted(q.with_shown_word(top, table).collect()) == sorted(q.with_shown_word(top, words).collect())
    assert [r[0] for r in dictionaries.drop_stopwords(top, table).collect()] == ["ok"]


def test_scores_do_not_depend_on_the_order_of_addition(spark):
    rows = spark.range(4000).selectExpr(
        "concat('w', id % 3) as word", "cast(1 + id % 5 as int) as cnt", "7 as num_words",
        "cast(pow(10, 1 + id % 17) as bigint) as impact", "id",
    )
    rows = rows.unionByName(rows.withColumn("cnt", F.col("cnt") + 10**9))
    results = []
    for n in (1, 7, 16):
        weights = topics.word_weight(rows.repartition(n, F.xxhash64("id", F.lit(n))))
        results.append(sorted((r["word"], r["weight"]) for r in weights.collect()))
    assert results[0] == results[1] == results[2]
    assert min(w for _, w in results[0]) > 1e8


def test_large_dictionaries_give_the_same_scores(spark, many):
    posts = many.drop("impact").withColumns({"followers_count": F.lit(2), "reshare_count": F.lit(3), "favorite_count": F.col("user_id")})
    stop = spark.createDataFrame([(w,) for w in STOP], "word string")
    censor = spark.createDataFrame([("darn",), ("cloud",)], "word string")
    small = score_posts(posts, STOP, ["darn", "cloud"]).collect()
    large = score_posts(posts, stop, censor).collect()
    assert sorted(small) == sorted(large)
    for row in small:
        kept = [w for w in plain.words(row["text"]) if w.lower() not in STOP]
        assert row["impact"] == len(kept) * (5 + row["user_id"])
        assert row["censored_text"] == plain.censor(row["text"], ["darn", "cloud"])


def test_shown_words_come_from_the_dictionary(spark):
    top = spark.createDataFrame([(1, "darn"), (2, "a-darn")], "rank int, word string")
    masks = spark.createDataFrame([("darn", "d##n")], "word string, mask string")
    got = {x["word"]: x["shown_word"] for x in q.with_shown_word(top, masks).collect()}
    assert got == {"darn": "d##n", "a-darn": "a-darn"}


REQUESTS = [
    (1, 0, 40, 0, 5000, 5, 3), (2, 10, 10, 0, 5000, 4, 2), (3, 5, 20, 1000, 1600, 6, 4), (4, -(2**62), 2**62 + 5, -(2**62), 2**62 + 9, 7, 3),
    (5, 0, 40, 2500, 2500, 5, 5), (6, 7, 7, 100, 4000, 3, 0), (7, 20, 10, 0, 9, 5, 5), (8, 0, 40, 0, 5000, 0, 5),
    (9, 0, 40, 0, 5000, 5, -1), (10, 39, 40, 15, 17, 5, 5), (11, 15, 16, 4095, 4097, 5, 5), (12, 0, 63, 0, 4095, 40, 30),
]


def test_request_tables_agree_with_single_queries(spark, many):
    table = spark.createDataFrame(REQUESTS, "request_id long, uid_lo long, uid_hi long, t_lo long, t_hi long, n1 int, n2 int")
    words, posts = {}, {}
    for x in r.request_words(table, many, STOP, CENSOR).collect():
        words.setdefault(x["request_id"], []).append((x["rank"], x["word"], x["posts"], x["score"]))
    for x in r.request_posts(table, many, STOP, CENSOR).collect():
        posts.setdefault(x["request_id"], []).append((x["rank"], x["post_id"], x["text"]))
    for rid, u0, u1, t0, t1, n1, n2 in REQUESTS:
        valid = u0 <= u1 and t0 <= t1 and n1 > 0 and n2 >= 0
        chosen = [(i, t, m) for i, u, at, t, m in make_posts() if valid and u0 <= u <= u1 and t0 <= at <= t1]
        want = [(k + 1, w, n, round(s, 6)) for k, (w, n, s) in enumerate(plain.topic_words(chosen, STOP, n1) if valid else [])]
        assert sorted(words.get(rid, [])) == want, rid
        want = [(k + 1, i, plain.censor(t, CENSOR)) for k, (i, t, m) in enumerate(plain.topic_posts(chosen, STOP, n1, n2) if valid else [])]
        assert sorted(posts.get(rid, [])) == want, rid


def test_requests_given_as_text(spark, many):
    table = spark.createDataFrame(
        [(1, "0", "40", "0", "5000", "3", "2"), (2, "x", "40", "0", "5000", "3", "2"), (3, "0", "", "0", "9", "3", "2")],
        "request_id long, uid_lo string, uid_hi string, t_lo string, t_hi string, n1 string, n2 string",
    )
    got = r.request_words(table, many, STOP).collect()
    assert [x["request_id"] for x in got] == [1, 1, 1]


def test_large_censor_tables_in_request_posts(spark, many):
    table = spark.createDataFrame(REQUESTS[:3], "request_id long, uid_lo long, uid_hi long, t_lo long, t_hi long, n1 int, n2 int")
    censor = spark.createDataFrame([("darn",)], "word string")
    assert sorted(r.request_posts(table, many, STOP, censor).collect()) == sorted(r.request_posts(table, many, STOP, CENSOR).collect())
