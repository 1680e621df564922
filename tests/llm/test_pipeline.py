"""The pipeline on a small corpus where each stage has something to do."""

import random

import corpus_pipeline
from postlens.llm.registry import ORACLES, QUERIES


def test_stages(spark, tmp_path):
    rng = random.Random(6)
    letters = {"aa": "abcdefgh", "bb": "mnopqrst"}
    prose = lambda lang, n: " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randint(2, 8))) for _ in range(n))
    rows = [(i, prose(lang, 80), lang) for i in range(60) for lang in [rng.choice(["aa", "bb"])]]
    copied = rows[3][1].split()
    copied[40] = "changed"
    passage, item = prose("aa", 60), prose("bb", 30)
    rows += [
        (100, " ".join(copied), "aa"), (101, rows[4][1], "bb"), (102, "12 34", "aa"), (103, None, "aa"),
        (104, f"{prose('aa', 50)} {passage} {prose('aa', 20)}", "aa"), (105, f"{prose('aa', 30)} {passage}", "aa"),
        (106, f"{prose('bb', 30)} {item.upper()} {prose('bb', 30)}", "bb"),
    ]
    table = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    columns = docs.columns
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        assert n == 4 or docs.columns == columns
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append({r["doc_id"]: r for r in docs.collect()})
    everything = {r[0] for r in rows}
    assert set(kept[0]) == everything - {102, 103}
    assert set(kept[1]) == everything - {100, 101, 102, 103}
    assert set(kept[2]) == set(kept[1])
    assert passage in kept[2][104]["text"] and passage not in kept[2][105]["text"]
    assert kept[2][105]["n_chars"] == len(kept[2][105]["text"])
    assert set(kept[3]) == set(kept[2]) - {106}
    assert set(kept[4]) == set(kept[3])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_one_row_of_each_class_stays(spark, tmp_path):
    a, b, c = ("one two three four five six seven", "eight nine ten eleven twelve thirteen", "x y z")
    rows = [
        (1, a), (5, a), (5, b), (9, a), (9, a), (7, c), (7, c), (None, c), (None, b + " more"), (20, None), (21, ""), (None, a + " a b c d e f g"),
    ]
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, row_number int, component_id string")
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    want = [(1, a), (5, b), (7, c), (None, b + " more"), (20, None), (21, ""), (None, a + " a b c d e f g")]
    assert sorted(((r[0], r[1]) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert corpus_pipeline.keep_one_of_near_copies(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_all_queries_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
