"""Score formulas."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What one contact of each kind adds to the weight of a pair.
CONTACT_WEIGHT = {"reply": 2, "reshare": 1}


def contact_weight(kind: Column) -> Column:
    return F.when(kind == "reply", F.lit(CONTACT_WEIGHT["reply"])).otherwise(
        F.lit(CONTACT_WEIGHT["reshare"])
    )


def intimacy(weight: Column) -> Column:
    return 1 + F.log(1 + weight)


def contact_score(intimacy_score: Column, phrase_hits: Column) -> Column:
    return intimacy_score * (phrase_hits + 1)


def topic_score(posts_in_range: Column, posts_with_word: Column, weight: Column) -> Column:
    return F.log(posts_in_range / posts_with_word) * weight


def rounded(value: Column, places: int) -> Column:
    """``value`` to so many places, in doubles throughout as SQL engines round: scaled, rounded, scaled back.

    Spark's own ``round`` goes through the decimal text; halves of the last place may then fall the other way.
    """
    scale = 10.0**places
    return F.round(value * scale) / scale
