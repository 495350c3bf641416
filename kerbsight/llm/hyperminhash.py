"""HyperMinHash sketches of word-shingle sets.

A shingle's 64-bit hash picks a bucket by its top bits; a bucket keeps the smallest
remainder as its leading-zero count (6 bits) and the 10 bits behind the leading one: one
16-bit register.  Empty buckets of small sets borrow the register of a full one
along a fixed walk of their own (densification), so that equal sets have equal and similar sets
similar registers at any size.
"""

from __future__ import annotations

import numpy as np

from .textbatch import _STEP, Words, grams, mix

BUCKETS = 256
ROWS = 5
MANTISSA = 10
_U = np.uint64
_TOP = _U(64 - int(BUCKETS).bit_length() + 1)
_rng = np.random.Generator(np.random.PCG64(99))
_WALK_START = _rng.integers(0, BUCKETS, BUCKETS)
_WALK_STEP = _rng.integers(0, BUCKETS // 2, BUCKETS) * 2 + 1


def shingle_sets(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, one after the other, and
    their first indices.  A document of fewer words has its whole sequence as its one
    shingle; one without words has none."""
    code, at = grams(w, n)
    cuts = np.searchsorted(at, w.first)
    count = w.count
    parts, size = [], np.zeros(w.n_docs, np.int64)
    for d in range(w.n_docs):
        if 0 < count[d] < n:
            h = int(count[d])
            for c in w.code[w.first[d] : w.first[d + 1]].tolist():
                h = (h * _STEP + c) % (1 << 64)
            s = mix(np.array([h], np.uint64))
        else:
            s = np.unique(code[cuts[d] : cuts[d + 1]])
        parts.append(s)
        size[d] = len(s)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.concatenate(([0], np.cumsum(size)))


def registers(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """documents x BUCKETS registers (0: nothing to borrow from, the set is empty)."""
    n = len(first) - 1
    out = np.zeros((n, BUCKETS), np.uint16)
    if len(codes):
        doc = np.repeat(np.arange(n), np.diff(first))
        cell = doc * BUCKETS + (codes >> _TOP).astype(np.int64)
        least = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))  # sets are sorted
        width = 64 - int(BUCKETS).bit_length() + 1
        rest = codes[least] & ((_U(1) << _U(width)) - _U(1))
        length = np.frexp(rest.astype(np.float64))[1]
        zeros = np.clip(width - length, 0, 62)
        behind = (rest << (64 - width + zeros + 1).clip(0, 63).astype(np.uint64)) >> _U(64 - MANTISSA)
        out.ravel()[cell[least]] = ((zeros.astype(np.uint64) << _U(MANTISSA)) | behind).astype(np.uint16) + np.uint16(1)
    todo = np.flatnonzero((out == 0).any(1) & (out != 0).any(1))
    if len(todo):
        own = out[todo]
        full = own.copy()
        for t in range(BUCKETS):
            some = own[:, (_WALK_START + t * _WALK_STEP) % BUCKETS]
            np.copyto(full, some, where=full == 0)
            if (full != 0).all():
                break
        out[todo] = full
    return out


def bands(reg: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """documents x bands keys: each band compresses ``rows`` registers to 64 bits."""
    b = reg.shape[1] // rows
    x = reg[:, : b * rows].reshape(len(reg), b, rows).astype(np.uint64)
    key = np.zeros((len(reg), b), np.uint64)
    for k in range(rows):
        key = (key ^ x[:, :, k]) * _U(_STEP)
        key ^= key >> _U(29)
    return mix(key ^ mix(np.arange(b, dtype=np.uint64) + _U(5)))


def matches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal registers of each pair of rows."""
    return (a == b).sum(1)


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Expected registers that two unrelated sets of n and m shingles share: both
    minima have the same leading zeros and mantissa.  Sum over register values of
    the product of their probabilities, each bucket holding n / BUCKETS shingles."""
    n, m = np.maximum(n, 1) / BUCKETS, np.maximum(m, 1) / BUCKETS
    total = np.zeros(np.broadcast(n, m).shape)
    for z in range(40):
        lo, hi = 2.0 ** -(z + 1), 2.0**-z
        step = (hi - lo) / 2**MANTISSA
        # The mass of one register value is about its width times the density at lo..hi;
        # averaged over the mantissa by the mean of the squared density.
        for x in (lo, (lo + hi) / 2, hi):
            p = n * step * np.exp(-n * x)
            q = m * step * np.exp(-m * x)
            total += p * q * 2**MANTISSA * (4 if x == (lo + hi) / 2 else 1) / 6
    return total * BUCKETS


def jaccard(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected estimate from the number of equal registers."""
    by_chance = np.minimum(chance(n, m), BUCKETS - 1)
    return np.clip((equal - by_chance) / (BUCKETS - by_chance), 0.0, 1.0)
