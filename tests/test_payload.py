import random

from pyspark.sql import functions as F

from postlens.functions.payload import first_bad_position, frame_payload, payload_text
from postlens.operators.payloads import audit_payloads, quarantine_payloads


def test_framing(spark):
    df = spark.createDataFrame([("Test",), ("",), ("é",), ("x" * 127,), ("x" * 128,)], "s string")
    got = [r[0] for r in df.select(frame_payload(F.col("s"))).collect()]
    assert got[0] == [4, 84, 1, 101, 0, 115, 1, 116, 0]
    assert got[1] == [0]
    assert got[2] is None and got[4] is None
    assert len(got[3]) == 255


def test_framing_turns_back(spark):
    rng = random.Random(1)
    texts = ["".join(chr(rng.randint(1, 127)) for _ in range(rng.randint(0, 22))) for _ in range(300)]
    df = spark.createDataFrame([(s,) for s in texts], "s string").withColumn("p", frame_payload(F.col("s")))
    for s, p, back, bad in df.select("s", "p", payload_text(F.col("p")), first_bad_position(F.col("p"))).collect():
        assert p == [len(s)] + [x for c in s for x in (ord(c), bin(ord(c)).count("1") % 2)]
        assert back == s and bad is None


def test_audit(spark):
    good, flipped, short = [2, 84, 1, 101, 0], [2, 84, 1, 101, 1], [2, 84, 1]
    rows = [(1, "a", good), (2, "a", flipped), (3, "b", short), (4, "b", [-1]), (5, "b", [0]), (6, "c", None), (7, "c", [])]
    df = spark.createDataFrame(rows, "id int, source string, payload array<int>")
    assert {r[0]: (r[1], r[2]) for r in audit_payloads(df).collect()} == {"a": (1, 1), "b": (2, 1), "c": (0, 2)}
    assert sorted((r["id"], r["first_bad"]) for r in quarantine_payloads(df).collect()) == [(2, 1), (3, 1), (6, 0), (7, 0)]
    assert [r[0] for r in df.orderBy("id").select(payload_text(F.col("payload"))).collect()] == ["Te", None, None, "", "", None, None]


def test_a_payload_is_computed_once_per_row(spark):
    framed = frame_payload(F.col("s"))
    df = spark.createDataFrame([("Test",)], "s string")
    for checked in (first_bad_position(framed), payload_text(framed)):
        plan = df.select(checked.alias("x"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == 1
