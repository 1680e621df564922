"""Text expressions: URLs, words, masks, phrases."""

from __future__ import annotations

import re
from collections.abc import Callable, Collection

from pyspark.sql import Column, functions as F

# They decide which characters make a URL, a word and a token.
URL = r"(https?|ftp)://[^\t\r\n /$.?#][^\t\r\n ]*"
# A word is a whole run of letters, digits, ' and - that holds a letter. Runs without one
# match outside the group, so that a long run of digits is passed over in one step.
WORD_OR_DIGITS = r"([0-9'-]*+[A-Za-z][A-Za-z0-9'-]*+)|[0-9'-]++"
TOKEN = r"[A-Za-z0-9]+"
TOKEN_OR_GAP = r"[A-Za-z0-9]+|[^A-Za-z0-9]+"
SPACE_BEFORE = (" ", "\t", "\n", "\x0b", "\f", "\r")
SPACE_AFTER = SPACE_BEFORE + ("\u0085", "\u2028", "\u2029")
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS_ROTATED = "nopqrstuvwxyzabcdefghijklmNOPQRSTUVWXYZABCDEFGHIJKLM"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def rot13(text: Column) -> Column:
    return F.translate(text, LETTERS, LETTERS_ROTATED)


def strip_urls(text: Column) -> Column:
    """Remove URLs, leaving nothing in their place."""
    return F.when(F.contains(text, F.lit("://")), F.regexp_replace(text, URL, "")).otherwise(text)


def extract_words(text: Column) -> Column:
    """Words of a text in order, URLs left out, case kept."""
    runs = F.regexp_extract_all(strip_urls(text), F.lit(WORD_OR_DIGITS), F.lit(1))
    return F.array_remove(runs, "")


def lower_words(text: Column) -> Column:
    """Words of a text in order, in lower case."""
    return F.transform(extract_words(text), F.lower)


def word_counts(words: Column) -> Column:
    """``array<struct<word, cnt>>``: each distinct word of one text with its occurrences.

    Sorts the words of the row and measures the runs of equal ones, so the counts need
    neither a shuffle nor a pass over the words for every distinct word.
    """

    def run_ends(ordered: Column) -> Column:
        def end(word: Column, i: Column) -> Column:
            is_last = (i + 1 == F.size(ordered)) | (F.get(ordered, i + 1) != word)
            return F.when(is_last, F.struct(word.alias("word"), (i + 1).alias("end")))

        return F.array_compact(F.transform(ordered, end))

    def run_lengths(ends: Column) -> Column:
        def length(run: Column, i: Column) -> Column:
            before = F.coalesce(F.get(ends, i - 1)["end"], F.lit(0))
            return F.struct(run["word"].alias("word"), (run["end"] - before).alias("cnt"))

        return F.transform(ends, length)

    return bind(bind(F.sort_array(words), run_ends), run_lengths)


def mask_word(word: Column) -> Column:
    """First and last character kept, the others starred; words below three stay."""
    return F.when(F.length(word) < 3, word).otherwise(
        F.concat(
            F.left(word, F.lit(1)),
            F.repeat(F.lit("*"), F.length(word) - 2),
            F.right(word, F.lit(1)),
        )
    )


def text_segments(text: Column) -> Column:
    """A text cut into alternating tokens and gaps; joined again they give the text."""
    return F.regexp_extract_all(text, F.lit(TOKEN_OR_GAP), F.lit(0))


def any_word(words: Collection[str]) -> str:
    """A pattern for one of some lower-case words, common beginnings written once."""
    tree: dict = {}
    for word in words:
        node = tree
        for c in word:
            node = node.setdefault(c, {})
        node[""] = {}

    def branch(node: dict) -> str:
        ways = [re.escape(c) + branch(after) for c, after in sorted(node.items()) if c]
        if not ways:
            return ""
        inner = ways[0] if len(ways) == 1 else "|".join(ways)
        return f"(?:{inner})?+" if "" in node else f"(?:{inner})" if len(ways) > 1 else inner

    return branch(tree)


def _token_start_and_rest(words: Collection[str]) -> tuple[str, str]:
    """Patterns for the first character and for the rest of a token which is one of the words, in any case.

    The first is a plain choice of characters: nearly all places of a text fail there, at little
    cost. Only then it looks back whether a token starts.
    """
    by_first: dict[str, list[str]] = {}
    for word in words:
        by_first.setdefault(word[0], []).append(word[1:])
    ways = "|".join(f"(?<=[{c}{c.upper()}])(?i:{any_word(rest)})" for c, rest in sorted(by_first.items()))
    first = "".join(sorted({x for c in by_first for x in (c, c.upper())}))
    return f"([{first}])(?<![A-Za-z0-9].)", f"(?:{ways})(?![A-Za-z0-9])"


def censor_text(text: Column, words: Collection[str]) -> Column:
    """Mask every token whose lower-case form is one of ``words``, inside URLs too."""
    # Shorter words stay as they are; what holds other characters is no token.
    masked_words = sorted({w for w in words if len(w) > 2 and re.fullmatch("[a-z0-9]+", w)})
    if not masked_words:
        return text
    shown = text
    for size in sorted({len(w) for w in masked_words}):
        start, rest = _token_start_and_rest([w for w in masked_words if len(w) == size])
        shown = F.regexp_replace(shown, f"{start}(?={rest}).{{{size - 2}}}(.)", f"$1{'*' * (size - 2)}$2")
    # Most texts hold no listed word; nothing is replaced in them.
    return F.when(F.rlike(text, F.lit("".join(_token_start_and_rest(masked_words)))), shown).otherwise(text)


def _count_bounded(text: Column, pattern: Column, opens: Column, closes: Column) -> Column:
    """Occurrences that stand between spaces or text ends.

    ``opens`` / ``closes`` tell whether the phrase itself starts / ends with a space: that
    is the neighbour when two occurrences touch.
    """

    def count(parts: Column) -> Column:
        last = F.size(parts) - 2

        def bounded(i: Column) -> Column:
            before, after = F.get(parts, i), F.get(parts, i + 1)
            left_ok = F.when(before == "", (i == 0) | closes).otherwise(
                F.right(before, F.lit(1)).isin(*SPACE_BEFORE)
            )
            right_ok = F.when(after == "", (i == last) | opens).otherwise(
                F.left(after, F.lit(1)).isin(*SPACE_AFTER)
            )
            return left_ok & right_ok

        return F.size(F.filter(F.sequence(F.lit(0), last), bounded))

    return bind(F.split(text, pattern, -1), count)


def phrase_count(text: Column, phrase: str | Column) -> Column:
    """How often ``phrase`` stands in ``text`` with a space or text end on both sides.

    The phrase is literal and case-sensitive. Occurrences are found left to right
    without overlap, and one that is not bounded still uses up its characters.
    """
    if isinstance(phrase, str):
        if phrase == "":
            return F.lit(0)
        needle = F.lit(phrase)
        pattern = F.lit(re.escape(phrase))
        opens = F.lit(phrase[0] in SPACE_AFTER)
        closes = F.lit(phrase[-1] in SPACE_BEFORE)
    else:
        needle = phrase
        quoted = F.replace(phrase, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
        pattern = F.concat(F.lit("\\Q"), quoted, F.lit("\\E"))
        opens = F.left(phrase, F.lit(1)).isin(*SPACE_AFTER)
        closes = F.right(phrase, F.lit(1)).isin(*SPACE_BEFORE)
    found = F.contains(text, needle) & (needle != "")
    return F.when(found, _count_bounded(text, pattern, opens, closes)).otherwise(F.lit(0))
