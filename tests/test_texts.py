"""Texts as numbers: the order of the texts, the same results, and no text in the shuffles of rows."""

import random

from postlens.operators import contacts as c
from postlens.operators.texts import TEXT_ID, number_texts, with_texts
from postlens.plans import contact_query as q
from test_contacts import SCHEMA


def _posts(spark):
    rng = random.Random(4)
    texts = ["", "a cloud", "cloud cloud", "é cloud", "z" * 50, "a", "Cloud", None]
    rows = [
        (i, rng.randint(1, 6), rng.randint(7, 9), rng.choice(["reply", "reshare"]), rng.choice(texts), rng.randint(1, 5), f"n{i}", None, None, None, None)
        for i in range(300)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_numbers_follow_the_order_of_texts_and_turn_back(spark):
    posts = _posts(spark)
    rows, texts = number_texts(posts)
    held = [tuple(r) for r in texts.orderBy(TEXT_ID).collect()]
    assert [t for _, t in held] == [r[0] for r in posts.select("text").distinct().orderBy("text").collect()]
    assert sorted(map(tuple, with_texts(rows, texts).collect()), key=repr) == sorted(map(tuple, posts.collect()), key=repr)


def test_requests_answer_alike_with_numbers(spark):
    posts = _posts(spark).where("text is not null")
    rows, texts = number_texts(posts)
    requests = spark.createDataFrame([(1, 2, "cloud", 3), (2, 7, "cloud", 2), (3, 7, "a", 9)], "request_id int, user_id long, phrase string, n int")

    def facts(of):
        return c.contact_fact(c.score_contacts(of), c.latest_profile(c.profiles_seen(of)))

    want = sorted(map(tuple, q.contact_requests(requests, facts(posts)).collect()))
    assert want and sorted(map(tuple, q.contact_requests(requests, facts(rows), texts=texts).collect())) == want


def test_scores_move_numbers_and_texts_once(spark):
    rows, texts = number_texts(_posts(spark))
    scored = c.score_contacts(rows)
    assert dict(scored.dtypes)["text"] == "bigint" and dict(with_texts(scored, texts).dtypes)["text"] == "string"
