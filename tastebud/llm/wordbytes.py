"""Vectorised tokenising of UTF-8 text inside Spark tasks.

A word class is a 256-entry table of bytes; every class used here keeps all
bytes of multi-byte characters together, so working on bytes gives the same
words as working on characters.  Text is handled in segments of a few MB that
end between words, so memory stays bounded for any document length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 21


def byte_class(*not_word: tuple[int, int]) -> np.ndarray:
    """True for bytes outside the given inclusive ranges."""
    t = np.ones(256, dtype=bool)
    for lo, hi in not_word:
        t[lo:hi + 1] = False
    return t


#: ``[^\x20\x09-\x0D]+``
SPACED = byte_class((0x20, 0x20), (0x09, 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text
ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def _splitmix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_codes() -> np.ndarray:
    code = _splitmix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    code[0x41:0x5B] = code[0x61:0x7B]          # A-Z count as a-z
    return code | np.uint64(1)


CODES = _byte_codes()
STEP = np.uint64(0xD1342543DE82EF95)
#: STEP is odd, so it has an inverse modulo 2**64.
_BACK = np.uint64(pow(int(STEP), -1, 1 << 64))
#: Bytes after which the powers begin anew (unless a word goes on).
STRETCH = 1 << 16
_POWERS = np.multiply.accumulate(np.r_[np.uint64(1), np.full(STRETCH - 1, STEP, dtype=np.uint64)])
_INVERSES = np.multiply.accumulate(np.r_[np.uint64(1), np.full(STRETCH - 1, _BACK, dtype=np.uint64)])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of STEP and of its inverse, ``n`` at least."""
    global _POWERS, _INVERSES
    if n > len(_POWERS):
        size = 1 << int(n - 1).bit_length()
        _POWERS, _INVERSES = (np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, x, dtype=np.uint64)]) for x in (STEP, _BACK))
    return _POWERS, _INVERSES


def _hashes(seg: np.ndarray, codes: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of each word of a segment: sum of its bytes' codes by place, with powers counted from the stretch's first byte."""
    out = np.empty(len(begin), np.uint64)
    a = 0
    while a < len(begin):
        b = max(a + 1, int(np.searchsorted(begin, begin[a] + STRETCH)))
        lo, hi = int(begin[a]), int(begin[b - 1] + sizes[b - 1])
        power, inverse = _powers(hi - lo)
        at = begin[a:b] - lo
        # other bytes have code 0
        out[a:b] = np.add.reduceat(codes[seg[lo:hi]] * power[:hi - lo], at) * inverse[at]
        a = b
    return _splitmix(out + sizes.astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    return _splitmix(x)


@dataclass
class Words:
    """Words of a run of documents: ``hashes`` per word, ``counts`` per document."""

    hashes: np.ndarray
    counts: np.ndarray

    @property
    def bounds(self) -> np.ndarray:
        return np.r_[0, np.cumsum(self.counts)]


def text_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets into them (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def _segments(raw: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, int]]:
    at, n = 0, len(raw)
    while at < n:
        end = min(n, at + SEGMENT)
        while end < n:
            probe = word[raw[end - 1:min(n, end + 4096)]]
            gap = np.flatnonzero(~probe)
            if len(gap):
                end = end + int(gap[0])
                break
            end = min(n, end + 4096)
        yield at, min(end, n)
        at = min(end, n)


def words(raw: np.ndarray, off: np.ndarray, word: np.ndarray) -> Words:
    """Hash every word of every document; A-Z hash as a-z."""
    n_docs = len(off) - 1
    starts_at, hashes = [], []
    codes = np.where(word, CODES, np.uint64(0))
    for lo, hi in _segments(raw, word):
        seg = raw[lo:hi]
        is_word = word[seg]
        before = np.empty_like(is_word)
        before[0] = False
        before[1:] = is_word[:-1]
        if lo and is_word[0] and word[raw[lo - 1]] and not np.any(off == lo):
            raise AssertionError("a segment begins inside a word")
        inside = off[np.searchsorted(off, lo):np.searchsorted(off, hi)]
        before[inside - lo] = False
        starts = is_word & ~before
        begin = np.flatnonzero(starts)
        if not len(begin):
            continue
        ends = is_word.copy()
        ends[:-1] &= ~is_word[1:] | starts[1:]
        hashes.append(_hashes(seg, codes, begin, np.flatnonzero(ends) + 1 - begin))
        starts_at.append(begin + lo)
    if not hashes:
        return Words(np.zeros(0, np.uint64), np.zeros(n_docs, np.int64))
    start = np.concatenate(starts_at)
    return Words(np.concatenate(hashes), np.diff(np.searchsorted(start, off)).astype(np.int64))


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for j in range(width):
        acc = acc * STEP + h[j:j + n]
    return _splitmix(acc + np.uint64(width))
