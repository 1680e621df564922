"""Expressions over the fields of a raw post."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, functions as F

# The languages kept by the two jobs and the form of the post time.
CONTACT_LANGS = ("ar", "en", "fr", "in", "pt", "es", "tr", "ja")
TOPIC_LANGS = ("en",)
POST_TIME = "MMM dd HH:mm:ss Z yyyy"
WEEKDAYS = ("Mon ", "Tue ", "Wed ", "Thu ", "Fri ", "Sat ", "Sun ")


def resolve_id(number: Column, text: Column) -> Column:
    """The numeric id, or the one written as text where the number is missing."""
    return F.coalesce(number, text.try_cast("bigint"))


def parse_post_time(text: Column) -> Column:
    """Epoch seconds of ``Wed Oct 10 20:19:24 +0000 2018``; null where it does not parse."""
    # Spark parses no weekday names, so the name is checked and cut off.
    clock = F.try_to_timestamp(F.substring(text, 5, 100), F.lit(POST_TIME))
    return F.when(F.left(text, F.lit(4)).isin(*WEEKDAYS), F.unix_timestamp(clock))


def has_hashtag(entities: Column) -> Column:
    return F.coalesce(F.size(entities["hashtags"]) > 0, F.lit(False))


def effective_words(words: Column, stop: Collection[str]) -> Column:
    """How many of the lower-cased ``words`` are not stop words."""
    if not stop:
        return F.size(words).cast("bigint")
    return F.size(F.filter(words, lambda w: ~w.isin(*stop))).cast("bigint")


def impact_score(effective: Column, followers: Column, reshares: Column, favorites: Column) -> Column:
    return effective * (followers + reshares + favorites)
