"""New posts taken into stored contact tables, against one run over all posts."""

import random

from postlens.operators import contact_state as s, contacts as c
from test_contacts import SCHEMA


def _posts(rng, n):
    """Posts of which many come again: equal, earlier, later, or from another author."""
    rows = []
    for _ in range(n):
        shown = rng.choice([(None, None, None), (rng.randint(1, 9), rng.choice(["r", "q", None]), None)])
        rows.append((
            rng.randint(1, n // 2), rng.randint(1, 6), rng.randint(7, 9), rng.choice(["reply", "reshare"]), f"t{rng.randint(0, 3)}",
            rng.randint(0, 50), rng.choice(["a", "b", None]), rng.choice(["x", ""]), *shown,
        ))
    return rows


def _same(a, b):
    for name, x, y in zip(s.ContactState._fields, a, b):
        columns = sorted(x.columns)
        assert columns == sorted(y.columns), name
        assert sorted(x.select(*columns).collect(), key=str) == sorted(y.select(*columns).collect(), key=str), name


def test_merged_halves_equal_one_run(spark):
    rng = random.Random(2)
    rows = _posts(rng, 300)
    frame = lambda part: spark.createDataFrame(part, SCHEMA)
    whole = s.contact_state(frame(rows))
    state = s.contact_state(frame(rows[:120]))
    _, added, removed = s.changed_posts(state, frame(rows[120:]))
    assert removed.count() > 5 and added.count() > removed.count()
    _same(s.merge_contacts(state, frame(rows[120:])), whole)
    # Once more the same posts: nothing changes.
    _same(s.merge_contacts(whole, frame(rows[50:200])), whole)


def test_stored_states_take_posts_in(spark, tmp_path):
    import json

    from postlens.plans.contact_jobs import contact_tables, read_contact_state, run_contact_update, scored_of_state
    from postlens.sources.readers import read_posts
    from test_clean import TIME, post

    rng = random.Random(3)
    user = lambda i: {"id": i, "id_str": str(i), "screen_name": f"u{i}{rng.randint(0, 2)}", "description": "d", "followers_count": 1}
    posts = [
        post(id=rng.randint(1, 40), user=user(rng.randint(1, 5)), in_reply_to_user_id=rng.randint(6, 8), text=f"hello {rng.randint(0, 4)}",
             created_at=TIME.replace("20:19:24", f"20:{rng.randint(10, 59)}:24"))
        for _ in range(90)
    ]
    for name, part in (("a", posts[:40]), ("b", posts[40:]), ("all", posts)):
        (tmp_path / f"{name}.json").write_text("\n".join(map(json.dumps, part)))
    out = str(tmp_path / "out")
    run_contact_update(spark, str(tmp_path / "a.json"), out, "1")
    run_contact_update(spark, str(tmp_path / "b.json"), out, "2", before="1")
    profiles, scored = contact_tables(read_posts(spark, str(tmp_path / "all.json")))
    state = read_contact_state(spark, out, "2")
    key = lambda rows: sorted(map(str, rows))
    assert key(scored_of_state(state).select(*scored.columns).collect()) == key(scored.collect())
    assert key(state.profiles.select(*profiles.columns).collect()) == key(profiles.collect())


def test_empty_states(spark):
    empty = spark.createDataFrame([], SCHEMA)
    rows = _posts(random.Random(5), 40)
    whole = s.contact_state(spark.createDataFrame(rows, SCHEMA))
    _same(s.merge_contacts(s.contact_state(empty), spark.createDataFrame(rows, SCHEMA)), whole)
    _same(s.merge_contacts(whole, empty), whole)
    assert c.pair_weight(empty).count() == 0
