"""Vectorised word tables over Arrow string columns.

Every word operator of this subpackage needs the same thing from a batch of
documents: which bytes form a word, which document the word belongs to, and a
64-bit fingerprint of the word.  This module derives all three for a whole
batch with a handful of numpy passes instead of a Python loop per word.

Documents are never cut: byte-level scratch arrays are made per block of about
``BLOCK`` bytes and only word-level arrays survive, so a long text costs memory
in proportion to its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from . import base

BLOCK = 1 << 20
#: Bytes of text handled together; a longer document makes a group of its own.
GROUP_BYTES = 1 << 20

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240611))
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = 0x9E3779B97F4A7C15 | 1
_STEP_INV = pow(_STEP, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_STEP, BLOCK + 1)
_INV = _powers(_STEP_INV, BLOCK + 1)

#: Bytes that separate words: space and \t \n \v \f \r.
SPACE_BYTES = bytes([9, 10, 11, 12, 13, 32])
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True
#: ASCII bytes outside 0-9 and a-z, after A-Z have been lower-cased.
_IS_PUNCT = np.zeros(256, bool)
_IS_PUNCT[:128] = True
_IS_PUNCT[48:58] = False
_IS_PUNCT[97:123] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply), applied elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(33)
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


@dataclass
class Words:
    """The words of some documents, in order."""

    n_docs: int
    data: np.ndarray  # uint8, the texts one after the other (lower-cased if asked for)
    doc_start: np.ndarray  # int64, n_docs + 1 byte offsets
    start: np.ndarray  # int64 byte offset of each word in data
    end: np.ndarray
    code: np.ndarray  # uint64 fingerprint of each word
    first: np.ndarray  # int64, n_docs + 1: words first[d]:first[d + 1] are document d's

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), np.diff(self.first))

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def _word_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    code = np.zeros(len(start), np.uint64)
    i = 0
    while i < len(start):
        base = int(start[i])
        j = int(np.searchsorted(end, base + BLOCK, "right"))
        if j <= i:  # a single word longer than a block
            w, h, p = data[base : int(end[i])], 0, 1
            for k in range(0, len(w), BLOCK):
                part = _BYTE_CODE[w[k : k + BLOCK]]
                h += p * int((part * _POW[: len(part)]).sum())
                p = p * pow(_STEP, len(part), 1 << 64) % (1 << 64)
            code[i] = h % (1 << 64)
            i += 1
            continue
        part = _BYTE_CODE[data[base : int(end[j - 1])]]
        part *= _POW[: len(part)]
        total = np.empty(len(part) + 1, np.uint64)
        total[0] = 0
        np.cumsum(part, out=total[1:])
        s, e = start[i:j] - base, end[i:j] - base
        code[i:j] = (total[e] - total[s]) * _INV[s]
        i = j
    code ^= (end - start).astype(np.uint64) * _U(0x9E3779B97F4A7C15)
    return mix(code)


def words_of(data: np.ndarray, doc_start: np.ndarray, *, lower: bool = False, punct: bool = False) -> Words:
    """Words of the documents data[doc_start[d]:doc_start[d + 1]].

    lower: A-Z count as a-z.  punct: words are runs of 0-9, a-z and non-ASCII
    characters; else runs of anything but ASCII white space.
    """
    if lower:
        data = _LOWER[data]
    stop = _IS_PUNCT if punct else _IS_SPACE
    inside = np.zeros(len(data) + 1, bool)
    np.logical_not(stop[data], out=inside[:-1])
    starts = inside[:-1].copy()
    starts[1:] &= ~inside[:-2]
    ends = inside[:-1] & ~inside[1:]
    cuts = doc_start[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
    starts[cuts] |= inside[cuts]
    ends[cuts - 1] |= inside[cuts - 1]
    start = np.flatnonzero(starts)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, doc_start, "left")
    return Words(len(doc_start) - 1, data, doc_start, start, end, _word_codes(data, start, end), first)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_utf8())
    _, off, data = texts.buffers()
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64, n + 1 + texts.offset)[texts.offset :]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups(texts: pa.Array, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive documents of about ``limit`` bytes: (from, to, bytes, offsets)."""
    data, off = buffers(texts)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j
    if len(data) > limit // 2:
        base.trim()


def per_doc_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[d]:first[d + 1]]."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the n-word windows that lie in one document, and the
    index of each window's first word."""
    m = len(w.code) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(m, np.uint64)
    for k in range(n):
        total += w.code[k : k + m] * _U(pow(_STEP_INV, k + 1, 1 << 64))
    left = np.repeat(w.first[1:], np.diff(w.first)) - np.arange(len(w.code))
    at = np.flatnonzero(left[:m] >= n)
    return mix(total[at]), at


def rolling(code: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of every n-word window of a word sequence, by prefix sums
    (the work does not grow with n)."""
    m = len(code) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    size = len(code) + 1
    pow_, inv = _powers(_STEP, size), _powers(_STEP_INV, size)
    total = np.zeros(size, np.uint64)
    np.cumsum(code * pow_[:-1], out=total[1:])
    return mix((total[n:] - total[:-n]) * inv[:m])
