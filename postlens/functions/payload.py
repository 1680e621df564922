"""Framed payloads: a length, then every character with its parity bit."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from postlens.functions.text import bind

# Fixed value: the length is stored in one signed byte.
MAX_LENGTH = 127


def parity(byte: Column) -> Column:
    return F.bit_count(byte.bitwiseAND(F.lit(255))) % 2


def frame_payload(text: Column) -> Column:
    """``[length, c0, parity0, c1, parity1, ...]``.

    Null where the text does not fit: characters beyond ASCII, or a length above one byte.
    """
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    framed = F.concat(
        F.array(F.length(text)),
        F.flatten(F.transform(chars, lambda c: F.array(F.ascii(c), parity(F.ascii(c))))),
    )
    fits = (F.length(text) <= MAX_LENGTH) & (F.length(text) == F.octet_length(text))
    return F.when(fits, framed)


def first_bad_position(payload: Column) -> Column:
    """Index of the first character whose parity bit is wrong or missing; null if none.

    Characters are counted from 0 and up to the stored length. A payload that is null, or has
    no length, is bad at position 0. The payload is computed once, not at every position.
    """
    return bind(payload, _first_bad)


def _first_bad(payload: Column) -> Column:
    length = F.get(payload, F.lit(0))

    def is_bad(i: Column) -> Column:
        stored = F.get(payload, 2 * i + 2)
        return stored.isNull() | (parity(F.get(payload, 2 * i + 1)) != stored)

    positions = F.sequence(F.lit(0), length - 1)
    return F.when(length.isNull(), F.lit(0)).when(length > 0, F.get(F.filter(positions, is_bad), F.lit(0)))


def payload_text(payload: Column) -> Column:
    """The text of a framed payload; null where a parity bit is wrong."""
    return bind(payload, _text)


def _text(payload: Column) -> Column:
    length = F.get(payload, F.lit(0))
    chars = F.transform(
        F.sequence(F.lit(0), length - 1), lambda i: F.char(F.get(payload, 2 * i + 1))
    )
    text = F.when(length > 0, F.array_join(chars, "")).otherwise(F.lit(""))
    return F.when(_first_bad(payload).isNull(), text)
