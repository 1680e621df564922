"""Plans that keep work near the data."""

from pyspark.sql import functions as F

from postlens.functions.text import lower_words
from postlens.operators import clean, contacts, topics
from postlens.plans import contact_query, topic_query
from postlens.sources.schema import RAW_POST


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_profile_keeps_one_row_per_task_before_the_shuffle(spark):
    seen = spark.createDataFrame([], "id long, screen_name string, description string, created_at long")
    plan = plan_of(contacts.latest_profile(seen))
    assert plan.count("WindowGroupLimit") == 2


def test_copies_are_merged_before_the_shuffle(spark):
    posts = clean.clean_topic_posts(spark.createDataFrame([], RAW_POST))
    plan = plan_of(clean.dedupe_posts(posts))
    assert plan.index("Exchange") < plan.index("partial_min")
    assert plan.count("Exchange") == 1


def test_words_are_merged_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "posts")
    spark.sql("select 1L post_id, 2L user_id, 3L created_at, 'a b' text, 'x' other, 4L impact").write.parquet(path)
    posts = spark.read.parquet(path)
    weights = topics.word_weight(topics.post_words(posts))
    plan = plan_of(weights)
    assert plan.count("Exchange") == 1 and "partial_sum" in plan
    # The text is cut once, and only the columns in use are read.
    assert plan.count("regexp_extract_all") == 1
    assert "ReadSchema: struct<text:string,impact:bigint>" in plan

    top = plan_of(topic_query.topic_posts(posts, 1, 5, 1, 5, 3, 3))
    assert "PushedFilters: [IsNotNull(user_id)" in top and "GreaterThanOrEqual(user_id,1)" in top
    assert "TakeOrderedAndProject" in top


def test_counting_words_of_a_post_needs_no_shuffle(spark):
    posts = spark.createDataFrame([], "post_id long, text string, impact long")
    assert "Exchange" not in plan_of(topics.post_words(posts))
    assert "Exchange" not in plan_of(posts.select(lower_words(F.col("text"))))


def test_pair_weights_take_one_shuffle(spark):
    posts = spark.createDataFrame([], "user1_id long, user2_id long, kind string")
    plan = plan_of(contacts.pair_weight(posts))
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_contacts_of_a_heavy_user_are_counted_before_they_meet(spark):
    facts = spark.createDataFrame(
        [], "user1_id long, user2_id long, text string, created_at long, intimacy_score double, "
        "user2_screen_name string, user2_desc string",
    )
    requests = spark.createDataFrame([(1, "2", "the", "5")], "request_id long, user_id string, phrase string, n string")
    plan = plan_of(contact_query.contact_requests(requests, facts))
    # The join is on user and slice, so it does not stand in for the shuffle of the counts.
    assert "partial_sum(hits" in plan
    assert [line for line in plan.splitlines() if "Join [user_id#" in line and "slice#" in line]
