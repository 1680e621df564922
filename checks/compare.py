"""Run every registered query next to its SQL and compare the rows.

    python -m checks.compare [sf_dir] [key ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def session(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def rows_of(frame) -> tuple[list[str], list[tuple]]:
    names = sorted(frame.columns)
    values = [frame[n].astype(object).where(frame[n].notna(), None).tolist() for n in names]
    rows = [tuple(int(v) if isinstance(v, float) and v.is_integer() else v for v in row) for row in zip(*values)]
    return names, sorted(rows, key=repr)


def compare(spark: SparkSession, con, sf_dir: str, key: str) -> tuple[bool, str]:
    got_names, got = rows_of(QUERIES[key](spark, sf_dir).toPandas())
    if key not in ORACLES:
        return bool(got), f"{len(got)} rows, no SQL"
    want_names, want = rows_of(con.execute(ORACLES[key]).fetchdf())
    if got_names != want_names:
        return False, f"columns {got_names} but expected {want_names}"
    if got != want:
        wrong = [(g, w) for g, w in zip(got, want) if g != w][:2]
        return False, f"{len(got)} rows, expected {len(want)}; first differences {str(wrong)[:600]}"
    return bool(got), f"{len(got)} rows"


def main(sf_dir: str = "/root/testdata/sf0.01", *keys: str) -> int:
    spark, con, failed = session(), database(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for key in keys or QUERIES:
        start = time.time()
        try:
            good, note = compare(spark, con, sf_dir, key)
        except Exception as error:  # a failing query must not hide the others
            good, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        failed += not good
        print(f"{'ok  ' if good else 'FAIL'} {key:24s} {time.time() - start:6.2f}s  {note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
