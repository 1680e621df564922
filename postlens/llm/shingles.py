"""Sets of word shingles as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import re

import numpy as np
import xxhash

_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


# Fixed value: the bytes that separate words.
_IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32]).astype(np.int8)
# A random value for every byte; A-Z have those of a-z.
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_VALUES[65:91] = _VALUES[97:123]
_SPACE = re.compile(rb"[\t-\r ]")
_PIECE = 1 << 20
_BASE = 0x2545F4914F6CDD1D
_FORTH = np.cumprod(np.r_[_U(1), np.full(_PIECE, _BASE, np.uint64)])
_BACK = np.cumprod(np.r_[_U(1), np.full(_PIECE, pow(_BASE, -1, 1 << 64), np.uint64)])


def _hash_piece(part: np.ndarray) -> np.ndarray:
    """Hashes of the words of some bytes, from sums over all bytes before a word's ends."""
    edges = np.flatnonzero(np.diff(_IS_SPACE[part], prepend=1, append=1))
    start, stop = edges[0::2], edges[1::2]
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum(_VALUES[part] * _FORTH[: len(part)], out=sums[1:])
    return mix((sums[stop] - sums[start]) * _BACK[start] + (stop - start).astype(np.uint64))


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words between ASCII white space, A-Z as a-z. Long texts go piece by piece."""
    data = (text or "").encode("utf-8", "replace")
    if len(data) < _PIECE:
        return _hash_piece(np.frombuffer(data, np.uint8))
    out = []
    at = 0
    while at < len(data):
        part = data[at : at + _PIECE]
        if len(part) == _PIECE:
            last = max(part.rfind(c) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if last >= 0:
                part = part[: last + 1]
            else:  # one word fills the piece: it is hashed alone, to its end
                end = _SPACE.search(data, at)
                end = end.start() if end else len(data)
                out.append(np.array([xxhash.xxh3_64_intdigest(data[at:end].lower())], np.uint64))
                at = end
                continue
        out.append(_hash_piece(np.frombuffer(part, np.uint8)))
        at += len(part)
    return np.concatenate(out)


class Shingler:
    """Shingle sets of texts: A-Z lower-cased, words between ASCII white space."""

    def __init__(self, words: int = 3):
        self.words = words

    def set_of(self, text: str | None) -> np.ndarray:
        """Distinct shingles, sorted. Fewer words than a shingle has are one shingle together."""
        h = word_hashes(text)
        if not len(h):
            return h
        size = min(self.words, len(h))
        out = np.full(len(h) - size + 1, size, np.uint64)
        for i in range(size):
            out = mix(out * _U(0x9E3779B97F4A7C15) + h[i : len(h) - size + 1 + i])
        return np.unique(out)


def set_key(shingles: np.ndarray) -> int:
    """A signed 64-bit key that equal sets share."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64)))
