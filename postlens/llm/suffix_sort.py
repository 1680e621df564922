"""Suffix order with common-prefix values by induced sorting on disk-backed queues.

The order of the suffixes that start at local minima (LMS) is found by recursion on the string
of their names, until it fits the memory given. All other suffixes are induced from it: a
queue with one bucket per symbol hands out suffixes in order, and each puts the suffix that
starts one symbol earlier into the bucket of that symbol, together with the length of the
prefix it shares with the suffix put there before: one more than the least such value between
the two that induced them. Queues hold tuples in memory up to a bound and beyond it in files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np

CAP = 200  # common-prefix values above this are kept as this


class Spill:
    """A folder for the files of one sort, in a store that pyarrow can write."""

    def __init__(self, folder: str):
        from pyarrow import fs

        uri = folder if ":" in folder else f"file://{folder}"
        if uri.startswith("file:"):
            uri = "file:///" + uri[5:].lstrip("/")
        self.system, root = fs.FileSystem.from_uri(uri)
        self.root = f"{root}/sort-{uuid.uuid4().hex}"
        self.files = 0

    def write(self, data: bytes) -> str:
        if not self.files:
            self.system.create_dir(self.root, recursive=True)
        path = f"{self.root}/{self.files}"
        self.files += 1
        with self.system.open_output_stream(path, compression=None) as out:
            out.write(data)
        return path

    def read(self, path: str, at: int, size: int) -> bytes:
        with self.system.open_input_file(path) as file:
            return file.read_at(size, at)

    def close(self) -> None:
        if self.files:
            self.system.delete_dir(self.root)
            self.files = 0


class BucketQueue:
    """A priority queue of (symbol, suffix, common prefix): first in, first out within a symbol.

    Tuples beyond ``limit`` bytes go to a file, ordered by symbol; taking a symbol reads its
    part of each file, in the order in which they were written, and then what is in memory.
    """

    _ROW = 9  # bytes of a tuple: suffix and common prefix

    def __init__(self, spill: Spill | None, limit: int):
        self.spill, self.limit = spill, limit
        self.held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.bytes = 0
        self.runs: list[tuple[str, dict[int, tuple[int, int]]]] = []

    def push(self, symbol: int, suffixes: np.ndarray, prefixes: np.ndarray) -> None:
        self.held.setdefault(symbol, []).append((suffixes, prefixes))
        self.bytes += self._ROW * len(suffixes)
        if self.spill is not None and self.bytes > self.limit:
            self._write()

    def push_groups(self, symbols: np.ndarray, suffixes: np.ndarray, prefixes: np.ndarray) -> None:
        """Rows ordered by symbol."""
        cuts = np.flatnonzero(np.diff(symbols)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(symbols)]):
            self.push(int(symbols[a]), suffixes[a:b], prefixes[a:b])

    def _write(self) -> None:
        parts, index, at = [], {}, 0
        for symbol in sorted(self.held):
            suffixes = np.concatenate([p[0] for p in self.held[symbol]]).astype(np.int64)
            prefixes = np.concatenate([p[1] for p in self.held[symbol]]).astype(np.uint8)
            parts += [suffixes.tobytes(), prefixes.tobytes()]
            index[symbol] = (at, len(suffixes))
            at += self._ROW * len(suffixes)
        self.runs.append((self.spill.write(b"".join(parts)), index))
        self.held, self.bytes = {}, 0

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for path, index in self.runs:
            if symbol in index:
                at, n = index.pop(symbol)
                data = self.spill.read(path, at, self._ROW * n)
                parts.append((np.frombuffer(data, np.int64, n), np.frombuffer(data, np.uint8, n, 8 * n)))
        held = self.held.pop(symbol, [])
        self.bytes -= self._ROW * sum(len(p[0]) for p in held)
        parts += held
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _raised(least: np.ndarray) -> np.ndarray:
    return np.minimum(least.astype(np.int64) + 1, CAP).astype(np.uint8)


def _range_least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of ``values[low:high + 1]`` for many ranges, by tables of doubling width."""
    width = high - low + 1
    level = np.floor(np.log2(width)).astype(np.int64)
    out = np.empty(len(low), values.dtype)
    table, step = values, 1
    for k in range(int(level.max()) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[low[at]], table[high[at] - step + 1])
        table, step = np.minimum(table[: max(0, len(table) - step)], table[step:]), step * 2
    return out


def _run_length(text: np.ndarray, at: int) -> int:
    """How often the symbol at a place is repeated from there on."""
    size = 64
    while True:
        part = text[at : at + size]
        other = np.flatnonzero(part != part[0])
        if len(other):
            return int(other[0])
        if at + size >= len(text):
            return len(part)
        size *= 8


def _waves(text, symbol, suffixes, prefixes) -> tuple[np.ndarray, np.ndarray, int]:
    """Suffixes of a bucket that were put there from others, then those they put there themselves.

    Those of the n-th wave start with the symbol n times, then differ: that is what the ends
    of two waves share.
    """
    out, n = [], 0
    while len(suffixes):
        prefixes = prefixes.copy()
        prefixes[0] = min(n, CAP)
        n += 1
        out.append((suffixes, prefixes))
        same = np.flatnonzero((suffixes > 0) & (text[suffixes - 1] == symbol))
        least = np.minimum.reduceat(prefixes, np.minimum(same[:-1] + 1, len(prefixes) - 1)) if len(same) > 1 else np.zeros(0, np.uint8)
        if len(same) > 1:  # the last range ends at the last of the chosen, not at the end
            least[-1] = prefixes[same[-2] + 1 : same[-1] + 1].min()
        suffixes, prefixes = suffixes[same] - 1, np.r_[np.uint8(0), _raised(least)][: len(same)]
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8), 0
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out]), n


def _put_before(queue: BucketQueue, text, symbol, suffixes, prefixes, greater: bool) -> None:
    """Put the suffixes one symbol earlier into their buckets, if that symbol is greater (less)."""
    before = text[suffixes - 1].astype(np.int64)
    at = np.flatnonzero((suffixes > 0) & ((before > symbol) if greater else (before < symbol)))
    if not len(at):
        return
    by = np.argsort(before[at], kind="stable")
    at = at[by]
    symbols = before[at]
    shared = np.ones(len(at), np.uint8)  # with one from another bucket, only the symbol itself
    follows = np.flatnonzero(np.diff(symbols) == 0) + 1
    if len(follows):
        shared[follows] = _raised(_range_least(prefixes, at[follows - 1] + 1, at[follows]))
    queue.push_groups(symbols, suffixes[at] - 1, shared)


def induce(
    text: np.ndarray, seeds: np.ndarray, seed_prefixes: np.ndarray, spill: Spill | None, limit: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes from the greatest to the least, bucket by bucket, each with what it shares
    with the one before (0 for the first of a bucket).

    ``seeds`` are the LMS suffixes in order, the last position of the text among them, whose
    symbol is less than all others.
    """
    symbols = np.unique(text).tolist()
    start_of = np.searchsorted(text[seeds], symbols)
    stop_of = np.searchsorted(text[seeds], symbols, side="right")
    queue, upper = BucketQueue(spill, limit), BucketQueue(spill, limit)
    for n, symbol in enumerate(symbols):
        own, shared, waves = _waves(text, symbol, *queue.take(symbol))
        if len(own):
            upper.push(symbol, own, shared)
        seeded, seed_shared = seeds[start_of[n] : stop_of[n]], seed_prefixes[start_of[n] : stop_of[n]].copy()
        if len(seeded):
            seed_shared[0] = min(waves, _run_length(text, int(seeded[0])), CAP) if len(own) else 0
            own, shared = np.concatenate([own, seeded]), np.concatenate([shared, seed_shared])
        if len(own):
            _put_before(queue, text, symbol, own, shared, greater=True)
    queue = BucketQueue(spill, limit)
    for symbol in reversed(symbols):
        own, shared, waves = _waves(text, symbol, *queue.take(symbol))
        after, after_shared = upper.take(symbol)
        after, after_shared = after[::-1], np.r_[np.uint8(0), after_shared[1:][::-1]][: len(after)]
        if len(after):
            after_shared[0] = min(waves, _run_length(text, int(after[0])), CAP) if len(own) else 0
            own, shared = np.concatenate([own, after]), np.concatenate([shared, after_shared])
        if symbol == symbols[0]:
            own, shared = np.r_[own, len(text) - 1], np.r_[shared, np.uint8(0)]
        if len(own):
            _put_before(queue, text, symbol, own, shared, greater=False)
            yield own, shared


def lms_positions(text: np.ndarray) -> np.ndarray:
    """Places that start a suffix less than the next one, after one that is greater; and the end."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int64) - text[:-1].astype(np.int64))
    known = np.flatnonzero(step)
    # A place takes the step of the next place where the symbol changes.
    after = known[np.minimum(np.searchsorted(known, np.arange(n - 1)), len(known) - 1)] if len(known) else known
    rises = np.r_[step[after] > 0, True] if len(known) else np.ones(n, bool)
    return np.flatnonzero(rises & np.r_[False, ~rises[:-1]]) if n > 1 else np.zeros(1, np.int64)


def _name(text: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings (up to and with the next LMS place), in text order.

    ``order`` holds the LMS places by their substrings; equal substrings get equal names.
    """
    length = np.r_[np.diff(lms) + 1, 1]
    place = np.searchsorted(lms, order)
    a, b, la, lb = order[:-1], order[1:], length[place[:-1]], length[place[1:]]
    same = la == lb
    active, j = np.flatnonzero(same), 0
    while len(active):
        equal = text[a[active] + j] == text[b[active] + j]
        same[active[~equal]] = False
        active = active[equal]
        j += 1
        active = active[la[active] > j]
    names = np.empty(len(lms), np.int64)
    names[place] = np.r_[0, np.cumsum(~same)]
    return names


def _double(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string in memory, by ranks of doubling length."""
    rank, width = names.copy(), 1
    while True:
        later = np.r_[rank[width:] + 1, np.zeros(min(width, len(rank)), np.int64)][: len(rank)]
        key = rank * (len(rank) + 2) + later
        order = np.argsort(key, kind="stable")
        ranked = np.r_[0, np.cumsum(np.diff(key[order]) != 0)]
        rank = np.empty_like(ranked)
        rank[order] = ranked
        if ranked[-1] == len(rank) - 1:
            return order
        width *= 2


def _lms_order(text: np.ndarray, lms: np.ndarray, spill: Spill | None, limit: int, base: int) -> np.ndarray:
    """The LMS places in the order of their suffixes."""
    mark = np.zeros(len(text), bool)
    mark[lms] = True
    start = lms[np.argsort(text[lms], kind="stable")]
    parts = [s[mark[s]] for s, _ in induce(text, start, np.zeros(len(start), np.uint8), spill, limit)]
    order = np.concatenate(parts)[::-1]
    names = _name(text, lms, order)
    if names.max() == len(lms) - 1:
        return lms[np.argsort(names)]
    if len(names) <= base:
        return lms[_double(names)]
    inner = lms_positions(names)
    inner_order = _lms_order(names, inner, spill, limit, base)
    parts = [s for s, _ in induce(names, inner_order, np.zeros(len(inner_order), np.uint8), spill, limit)]
    return lms[np.concatenate(parts)[::-1]]


def _shared_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """What each suffix shares with the one before, up to ``depth`` symbols, compared in full."""
    out = np.zeros(len(order), np.int64)
    a, b = order[:-1], order[1:]
    active, j = np.arange(len(a)), 0
    last = len(text)
    while len(active) and j < depth:
        inside = np.maximum(a[active], b[active]) + j < last
        active = active[inside]
        active = active[text[a[active] + j] == text[b[active] + j]]
        j += 1
        out[active + 1] = j
    return out.astype(np.uint8)


def sorted_suffixes(
    text: np.ndarray, depth: int, spill: Spill | None = None, limit: int = 64 << 20, base: int = 1 << 22
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes from the greatest to the least, in runs, with what each shares with the one before.

    ``text`` ends with a symbol less than all others. Common-prefix values are right up to
    ``depth``, and at least ``depth`` where they are more. ``limit`` bounds the bytes that a
    queue holds in memory, ``base`` the symbols that are sorted in memory.
    """
    if len(text) < 2:
        yield np.arange(len(text)), np.zeros(len(text), np.uint8)
        return
    lms = lms_positions(text)
    order = _lms_order(text, lms, spill, limit, base)
    yield from induce(text, order, _shared_prefixes(text, order, depth), spill, limit)
