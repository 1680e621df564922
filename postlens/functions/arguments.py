"""Query arguments: anything missing, unparsable or out of range means an empty result."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_NUMBER = re.compile(r"[+-]?[0-9]+")
LONG = (-(2**63), 2**63 - 1)
INT = (-(2**31), 2**31 - 1)


def whole_number(value: object, bounds: tuple[int, int] = LONG) -> int | None:
    """The value as a whole number inside ``bounds``, else None."""
    if value is None or isinstance(value, bool):
        return None
    text = str(value)
    if not _NUMBER.fullmatch(text):
        return None
    number = int(text)
    return number if bounds[0] <= number <= bounds[1] else None


def whole_number_column(value: Column, to: str) -> Column:
    """The same for a column of a request table: null where it is not a number."""
    text = value.cast("string")
    return F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast(to))


def contact_arguments(user_id: object, phrase: object, n: object) -> tuple[int, str, int] | None:
    """``(user_id, phrase, n)`` or None: the phrase must not be empty, n must be above 0."""
    user, count = whole_number(user_id), whole_number(n, INT)
    if user is None or not phrase or count is None or count <= 0:
        return None
    return user, str(phrase), count


def topic_arguments(
    uid_lo: object, uid_hi: object, t_lo: object, t_hi: object, n1: object, n2: object
) -> tuple[int, int, int, int, int, int] | None:
    """The six numbers or None: n1 above 0, n2 not below 0, ranges not reversed."""
    ranges = [whole_number(v) for v in (uid_lo, uid_hi, t_lo, t_hi)]
    counts = [whole_number(v, INT) for v in (n1, n2)]
    if None in ranges or None in counts:
        return None
    if counts[0] <= 0 or counts[1] < 0 or ranges[0] > ranges[1] or ranges[2] > ranges[3]:
        return None
    return (*ranges, *counts)
