import json

import pytest
from pyspark.sql import functions as F

from postlens.functions.posts import parse_post_time
from postlens.operators import clean
from postlens.sources.readers import read_censor, read_posts, read_words

TIME = "Wed Oct 10 20:19:24 +0000 2018"
EPOCH = 1539202764


def post(**fields):
    base = {
        "id": 1, "created_at": TIME, "text": "hi there", "lang": "en",
        "in_reply_to_user_id": 9, "retweet_count": 2, "favorite_count": 3,
        "entities": {"hashtags": [{"text": "x"}]},
        "user": {"id": 5, "id_str": "5", "screen_name": "five", "description": "d", "followers_count": 7},
    }
    base.update(fields)
    return base


@pytest.fixture
def load(spark, tmp_path):
    def write(*posts, extra=()):
        path = tmp_path / "posts.json"
        path.write_text("\n".join([json.dumps(p) for p in posts] + list(extra)))
        return read_posts(spark, str(path))

    return write


def ids(df):
    return sorted(r["post_id"] for r in df.collect())


def test_malformed_lines_are_dropped(load):
    raw = load(post(id=1), post(id=2), extra=['{"id": 3, "text": ', "", "no json"])
    assert sorted(r["id"] for r in raw.collect()) == [1, 2]


def test_required_fields_and_ids_from_text(load):
    raw = load(
        post(id=1),
        post(id=None),
        post(id=3, user={"id": None, "id_str": "33"}),
        post(id=4, user={"id": None, "id_str": None}),
        post(id=5, user={"id": None, "id_str": "abc"}),
        post(id=6, text=""),
        post(id=7, text=None),
        post(id=8, created_at=""),
        post(id=9, created_at="garbage"),
    )
    kept = clean.parse_times(clean.require_fields(clean.flatten_posts(raw)))
    assert {r["post_id"]: (r["user_id"], r["created_at"]) for r in kept.collect()} == {
        1: (5, EPOCH), 3: (33, EPOCH),
    }


def test_counters_default_to_zero(load):
    raw = load(post(retweet_count=None, favorite_count=None, user={"id": 5, "followers_count": None}))
    row = clean.clean_topic_posts(raw).first()
    assert (row["followers_count"], row["reshare_count"], row["favorite_count"]) == (0, 0, 0)


def test_languages(load):
    raw = load(post(id=1), post(id=2, lang="de"), post(id=3, lang="tr"), post(id=4, lang=None))
    assert ids(clean.clean_topic_posts(raw)) == [1]
    assert ids(clean.clean_contact_posts(raw)) == [1, 3]


def test_contacts(load):
    other = {"id": 50, "user": {"id": 8, "id_str": "8", "screen_name": "eight"}}
    unnumbered = {"id": 50, "user": {"id": None, "id_str": "88"}}
    unknown = {"id": 50, "user": {"id": None, "id_str": None}}
    own = {"id": 50, "user": {"id": 5, "id_str": "5"}}
    raw = load(
        post(id=1),
        post(id=2, in_reply_to_user_id=None, retweeted_status=other),
        post(id=3, retweeted_status=other),
        post(id=4, in_reply_to_user_id=None),
        post(id=5, in_reply_to_user_id=5),
        post(id=6, in_reply_to_user_id=None, retweeted_status=own),
        post(id=7, in_reply_to_user_id=None, retweeted_status=unnumbered),
        post(id=8, in_reply_to_user_id=None, retweeted_status=unknown),
        post(id=9, entities={"hashtags": []}),
        post(id=10, entities=None),
        post(id=11, retweeted_status=own),
    )
    got = {r["post_id"]: (r["kind"], r["user2_id"]) for r in clean.clean_contact_posts(raw).collect()}
    assert got == {
        1: ("reply", 9), 2: ("reshare", 8), 3: ("reply", 9), 7: ("reshare", 88), 11: ("reply", 9),
    }


def test_the_lowest_copy_of_a_post_is_kept(load):
    later = "Wed Oct 10 20:19:25 +0000 2018"
    raw = load(
        post(id=1, text="b", created_at=later), post(id=1, text="z"), post(id=1, text="c"),
        post(id=2, text="only"), *[post(id=3, text="copy")] * 50,
    )
    got = clean.dedupe_posts(clean.clean_topic_posts(raw)).collect()
    assert sorted((r["post_id"], r["text"]) for r in got) == [(1, "c"), (2, "only"), (3, "copy")]


def test_post_time(spark):
    df = spark.createDataFrame(
        [(TIME,), ("garbage",), ("",), (None,), ("Xyz Oct 10 20:19:24 +0000 2018",), ("Wed Oct 10 22:19:24 +0200 2018",)],
        "c string",
    )
    got = [r[0] for r in df.select(parse_post_time(F.col("c"))).collect()]
    assert got == [EPOCH, None, None, None, None, EPOCH]


def test_word_lists(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("The\n\nof\n")
    (tmp_path / "rot.txt").write_text("qnea\n\nUrpx\n")
    (tmp_path / "censor.csv").write_text('Darn,D**n\nit"s,i**s\n')
    assert [r[0] for r in read_words(spark, str(tmp_path / "stop.txt")).collect()] == ["the", "of"]
    obscured = read_words(spark, str(tmp_path / "rot.txt"), obscured=True)
    assert [r[0] for r in obscured.collect()] == ["darn", "heck"]
    got = [tuple(r) for r in read_censor(spark, str(tmp_path / "censor.csv")).collect()]
    assert got == [("darn", "d**n"), ('it"s', "i**s")]
