"""License scan: templates with optional and replaceable regions, compiled to automata over words.

A template is a sequence of words that must stand, regions that may be missing and regions that
stand for a bounded number of any words. Its longest stretch of mandatory words is its anchor. The
anchors of all templates are found in one pass over a text; from each place an automaton reads on
through what follows the anchor, and one for the reversed rest reads back through what precedes
it. Automata are made deterministic while they read. A text is accepted where both end well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from postlens.llm.common import read_table
from postlens.llm.license_templates import PHRASES, TEMPLATES

# Fixed value: bytes of words; A-Z become a-z, other ASCII characters separate.
_TO_WORD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256)
)
PIECE = 1 << 22
# Known transitions of an automaton are forgotten beyond this number.
MOST_STATES = 50_000

MATCHES = "array<struct<label: string, phrase: boolean, mandatory: bigint, start: bigint, stop: bigint>>"
SCHEMA = f"doc_id bigint, n_words bigint, matches {MATCHES}"
_MATCH = pa.list_(pa.struct([
    ("label", pa.string()), ("phrase", pa.bool_()), ("mandatory", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())
]))
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("matches", _MATCH)])


def normalise(data: bytes) -> bytes:
    """The words, each between single blanks; without words one blank."""
    plain, out, at = data.translate(_TO_WORD), [], 0
    while at < len(plain):
        stop = plain.find(b" ", at + PIECE)
        stop = len(plain) if stop < 0 else stop
        if part := b" ".join(plain[at:stop].split()):
            out.append(part)
        at = stop
    return b" " + b" ".join(out) + b" " if out else b" "


@dataclass(frozen=True)
class Word:
    text: bytes


@dataclass(frozen=True)
class AnyWords:
    least: int
    most: int


@dataclass(frozen=True)
class Optional:
    parts: tuple


def parse(template: str) -> tuple:
    """Markup as a tuple of ``Word``, ``AnyWords`` and ``Optional``."""
    open_parts: list[list] = [[]]
    for i, piece in enumerate(re.split("<<(.*?)>>", template)):
        if i % 2 == 0:
            open_parts[-1] += [Word(w) for w in normalise(piece.encode()).split()]
        elif piece == "beginOptional":
            open_parts.append([])
        elif piece == "endOptional" and len(open_parts) > 1:
            inner = open_parts.pop()
            open_parts[-1].append(Optional(tuple(inner)))
        elif found := re.fullmatch(r"var;words=(\d+)-(\d+)", piece):
            least, most = map(int, found.groups())
            if least > most:
                raise ValueError(f"no number of words fits {piece!r}")
            open_parts[-1].append(AnyWords(least, most))
        else:
            raise ValueError(f"unknown markup {piece!r}")
    if len(open_parts) > 1:
        raise ValueError("an optional region is not closed")
    return tuple(open_parts[0])


def backwards(parts: Sequence) -> tuple:
    return tuple(Optional(backwards(p.parts)) if isinstance(p, Optional) else p for p in reversed(parts))


class Automaton:
    """Accepts the words of ``parts``. A state is the set of places that the last word may stand for."""

    def __init__(self, parts: Sequence):
        self.symbols: list[bytes | None] = [None]  # place 0 stands before the first word
        self.follow: list[set[int]] = [set()]
        first, last, empty = self._add(parts)
        self.follow[0] |= first
        self.ends = last | ({0} if empty else set())
        self.start = frozenset([0])
        self.known: dict[tuple[frozenset, bytes], frozenset] = {}
        self.vocabulary = {s for s in self.symbols if s is not None}

    def _add(self, parts: Sequence) -> tuple[set[int], set[int], bool]:
        """Places that may come first, places that may come last, and whether none need come."""
        first, last, empty = set(), set(), True
        for part in parts:
            if isinstance(part, Word):
                a, z, skip = self._place(part.text)
            elif isinstance(part, Optional):
                a, z, skip = self._add(part.parts)
                skip = True
            else:
                a, z, skip = self._any(part)
            for place in last:
                self.follow[place] |= a
            first |= a if empty else set()
            last = last | z if skip else z
            empty = empty and skip
        return first, last, empty

    def _place(self, symbol: bytes | None) -> tuple[set[int], set[int], bool]:
        self.symbols.append(symbol)
        self.follow.append(set())
        place = len(self.symbols) - 1
        return {place}, {place}, False

    def _any(self, region: AnyWords) -> tuple[set[int], set[int], bool]:
        places = [min(self._place(None)[0]) for _ in range(region.most)]
        for a, b in zip(places, places[1:]):
            self.follow[a].add(b)
        return set(places[:1]), set(places[max(region.least, 1) - 1 :]), region.least == 0

    def _step(self, state: frozenset, word: bytes) -> frozenset:
        key = (state, word if word in self.vocabulary else b"")
        out = self.known.get(key)
        if out is None:
            if len(self.known) >= MOST_STATES:
                self.known.clear()
            out = frozenset(
                q for p in state for q in self.follow[p] if self.symbols[q] is None or self.symbols[q] == word
            )
            self.known[key] = out
        return out

    def longest(self, words: Iterator[bytes]) -> int:
        """How many of the first words are accepted at most; -1 if no number of them is."""
        state, best = self.start, 0 if 0 in self.ends else -1
        for n, word in enumerate(words, 1):
            state = self._step(state, word)
            if not state:
                break
            if not self.ends.isdisjoint(state):
                best = n
        return best


@dataclass(frozen=True)
class Template:
    """A compiled template; ``phrase`` marks those of the base labels."""

    label: str
    parts: tuple
    phrase: bool = False

    @cached_property
    def anchor(self) -> tuple[int, int]:
        """Start and stop of the longest stretch of mandatory words among the parts."""
        best, start = (0, 0), 0
        for i, part in enumerate((*self.parts, None)):
            if not isinstance(part, Word):
                best = max(best, (start, i), key=lambda x: x[1] - x[0])
                start = i + 1
        if best[0] == best[1]:
            raise ValueError(f"a template of {self.label!r} has no mandatory word")
        return best

    @cached_property
    def anchor_words(self) -> list[bytes]:
        return [p.text for p in self.parts[slice(*self.anchor)]]

    @cached_property
    def mandatory(self) -> int:
        return sum(isinstance(p, Word) for p in self.parts)

    @cached_property
    def before(self) -> Automaton:
        return Automaton(backwards(self.parts[: self.anchor[0]]))

    @cached_property
    def after(self) -> Automaton:
        return Automaton(self.parts[self.anchor[1] :])


def compile_templates(templates: Mapping[str, Sequence[str]], phrases: Mapping[str, Sequence[str]]) -> list[Template]:
    return [Template(label, parse(text), True) for label, texts in phrases.items() for text in texts] + [
        Template(label, parse(text)) for label, texts in templates.items() for text in texts
    ]


def _words_on(text: bytes, at: int) -> Iterator[bytes]:
    """The words after the blank at ``at``."""
    while 0 <= (stop := text.find(b" ", at + 1)):
        yield text[at + 1 : stop]
        at = stop


def _words_back(text: bytes, at: int) -> Iterator[bytes]:
    """The words before the blank at ``at``, the nearest first."""
    while 0 <= (start := text.rfind(b" ", 0, at)):
        yield text[start + 1 : at]
        at = start


class Scanner:
    """All templates behind one search for their anchors."""

    def __init__(self, templates: Sequence[Template]):
        import ahocorasick

        by_anchor: dict[bytes, list[Template]] = {}
        for t in templates:
            by_anchor.setdefault(b" " + b" ".join(t.anchor_words) + b" ", []).append(t)
        self.automaton = ahocorasick.Automaton()
        for anchor, of_anchor in by_anchor.items():
            # One character a byte, as the search works on characters.
            self.automaton.add_word(anchor.decode("latin-1"), (len(anchor), of_anchor))
        if by_anchor:
            self.automaton.make_automaton()

    def scan(self, text: bytes) -> list[tuple[str, bool, int, int, int]]:
        """(label, phrase, mandatory words, start, stop) of every match in a normalised text, in words."""
        out, counted, words = [], 0, 0
        if not len(self.automaton):
            return out
        for end, (size, of_anchor) in self.automaton.iter(text.decode("latin-1")):
            words += text.count(b" ", counted, end)  # words that end at or before the anchor's end
            counted = end
            for t in of_anchor:
                on = t.after.longest(_words_on(text, end))
                back = t.before.longest(_words_back(text, end + 1 - size)) if on >= 0 else -1
                if back >= 0:
                    start = words - len(t.anchor_words)
                    out.append((t.label, t.phrase, t.mandatory, start - back, words + on))
        return out


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, phrases: Mapping[str, Sequence[str]] = PHRASES
) -> DataFrame:
    """``[doc_id, n_words, matches]``, one row per row of ``docs``.

    ``matches`` holds ``(label, phrase, mandatory, start, stop)``, in words from 0: a row for every
    place where a template's anchor stands and the rest fits, as long as can be on both sides.
    ``phrase`` marks the plain phrases, ``mandatory`` counts the words that had to stand.

    Words are runs of ASCII letters and digits and other than ASCII characters, A-Z as a-z. Whole
    texts are read; null and empty texts have no words and no matches. Rows that repeat an id, and
    rows without one, are documents of their own. Other columns are not read. Nothing is shuffled,
    and the templates, a list of the caller's, go to the workers with the task.
    """
    compiled = compile_templates(templates, phrases)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id_"), F.col("text").cast("string").cast("binary").alias("text_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(compiled)
        for batch in batches:
            n_words, matches = [], []
            for data in batch.column(1):
                text = normalise(data.as_py() or b"")
                n_words.append(text.count(b" ") - 1)
                matches.append([dict(zip(("label", "phrase", "mandatory", "start", "stop"), m)) for m in scanner.scan(text)])
            columns = (batch.column(0), pa.array(n_words, pa.int64()), pa.array(matches, _MATCH))
            yield pa.RecordBatch.from_arrays(list(columns), schema=_ARROW)

    return rows.mapInArrow(run, SCHEMA)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the places of the base phrases, and the labels of phrases and templates.

    ``score`` is m / (m + 2) for the match with most mandatory words m, 0 without any: the longer the
    wording that had to stand, the less it is there by chance.
    """
    found = scan_licenses(read_table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["phrase"])
    most = F.coalesce(F.array_max(F.col("matches.mandatory")), F.lit(0))

    def labels(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda m: m["start"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.when(most > 0, most / (most + 2)).otherwise(0.0).alias("score"),
    )


QUERIES = {"op13_license_scan": op13_license_scan}
ORACLES: dict[str, str] = {}
