"""Audit of a table of framed payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from postlens.functions.payload import first_bad_position


def check_payloads(payloads: DataFrame) -> DataFrame:
    """Add ``first_bad``: the first wrong position of ``payload``, null for a good one."""
    return payloads.withColumn("first_bad", first_bad_position(F.col("payload")))


def audit_payloads(payloads: DataFrame) -> DataFrame:
    """``[source, good, bad]``: rows per source that pass and fail the parity check."""
    bad = F.col("first_bad").isNotNull()
    return check_payloads(payloads).groupBy("source").agg(
        F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad")
    )


def quarantine_payloads(payloads: DataFrame) -> DataFrame:
    """The rows that fail, with the first bad position."""
    return check_payloads(payloads).where("first_bad is not null")
