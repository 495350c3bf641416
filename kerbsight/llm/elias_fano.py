"""Elias-Fano sequences and a two-level n-gram trie on them.

A monotone sequence keeps the low bits of each value packed, and its high bits in
unary in a bit vector; a directory of zeros per 64-bit word gives select, so a
successor search touches one short run of equal high bits.  All parts are views
of one byte buffer: bytes received from another task, or a memory-mapped file.

The trie's first level holds context fingerprints, the second the successors of
all contexts.  A successor is stored relative to its context (the context's rank in
front of 40 bits of the word's fingerprint), which makes the whole level one monotone sequence;
monotone pointers mark where a context's successors start, and a search stays between them.
Counts of bigrams and shares of words, whose product is the smoothed probability, are
quantised to 8 bits with a codebook for each trie.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)
#: SELECT[b, k]: place of the k-th one of byte b.
_SELECT = np.zeros((256, 8), np.uint8)
for _b in range(256):
    _ones = [i for i in range(8) if _b >> i & 1]
    _SELECT[_b, : len(_ones)] = _ones
CHILD_BITS = 40


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """values of so many bits each, packed into 64-bit words (one spare at the end)."""
    out = np.zeros(len(values) * bits // 64 + 2, np.uint64)
    if bits:
        at = np.arange(len(values), dtype=np.int64) * bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        np.bitwise_or.at(out, word, values << shift)
        over = np.flatnonzero((at & 63) + bits > 64)
        np.bitwise_or.at(out, word[over] + 1, values[over] >> (_U(64) - shift[over]))
    return out


class EliasFano:
    """A non-decreasing sequence of 64-bit values, from ``parts()`` or a buffer."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray):
        self.n, self.bits, self.low, self.high, self.zeros = n, bits, low, high, zeros
        self.bytes = high.view(np.uint8)

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        upper = (values >> _U(bits)).astype(np.int64)
        length = n + (top >> bits) + 1
        high = np.zeros(length // 64 + 1, np.uint64)
        at = upper + np.arange(n)
        np.bitwise_or.at(high, at >> 6, _U(1) << (at & 63).astype(np.uint64))
        ones = _POP[high.view(np.uint8)].reshape(-1, 8).sum(1)
        zeros = np.zeros(len(high) + 1, np.int64)
        np.cumsum(64 - ones.astype(np.int64), out=zeros[1:])
        mask = _U((1 << bits) - 1)
        return cls(n, bits, _pack(values & mask, bits), high, zeros)

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.bits, len(self.low), len(self.high)], np.int64), self.low, self.high, self.zeros]

    @classmethod
    def read(cls, buffer: np.ndarray, at: int) -> tuple[EliasFano, int]:
        n, bits, a, b = buffer[at : at + 32].view(np.int64).tolist()
        at += 32
        low = buffer[at : at + 8 * a].view(np.uint64)
        high = buffer[at + 8 * a : at + 8 * (a + b)].view(np.uint64)
        zeros = buffer[at + 8 * (a + b) : at + 8 * (a + 2 * b + 1)].view(np.int64)
        return cls(n, bits, low, high, zeros), at + 8 * (a + 2 * b + 1)

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        x = self.low[word] >> shift
        # Shifting by 64 is undefined: two steps of at most 63
        x |= (self.low[word + 1] << (_U(63) - shift)) << _U(1)
        return x & _U((1 << self.bits) - 1)

    def _select_zero(self, k: np.ndarray) -> np.ndarray:
        """Bit position of the k-th zero (from 0)."""
        word = np.searchsorted(self.zeros, k, "right") - 1
        left = k - self.zeros[word]
        at = word * 64
        byte = word * 8
        out = np.zeros(len(k), np.int64)
        todo = np.ones(len(k), bool)
        for _ in range(8):
            b = ~self.bytes[np.minimum(byte, len(self.bytes) - 1)]
            c = _POP[b].astype(np.int64)
            here = todo & (left < c)
            out[here] = at[here] + _SELECT[b[here], left[here]]
            todo &= ~here
            left = np.where(todo, left - c, left)
            at, byte = at + 8, byte + 1
        return out

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at places i (select of the ones, by bisection over the words)."""
        ones = np.arange(len(self.zeros), dtype=np.int64) * 64 - self.zeros
        word = np.searchsorted(ones, i, "right") - 1
        left = i - ones[word]
        high = np.zeros(len(i), np.int64)
        todo, byte, at = np.ones(len(i), bool), word * 8, word * 64
        for _ in range(8):
            b = self.bytes[np.minimum(byte, len(self.bytes) - 1)]
            c = _POP[b].astype(np.int64)
            here = todo & (left < c)
            high[here] = at[here] + _SELECT[b[here], left[here]]
            todo &= ~here
            left = np.where(todo, left - c, left)
            at, byte = at + 8, byte + 1
        return ((high - i).astype(np.uint64) << _U(self.bits)) | self._lows(i)

    def successor(self, x: np.ndarray, left: np.ndarray | None = None, right: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The place of the first value >= x (n if none), and whether it equals x; of
        the places from left to right (not included) if given, else all."""
        if not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        limit = int(self.zeros[-1]) - 1  # zeros behind the last one may be padding
        h = np.minimum((x >> _U(self.bits)), _U(limit)).astype(np.int64)
        beyond = (x >> _U(self.bits)).astype(np.uint64) > _U(limit)
        low = x & _U((1 << self.bits) - 1)
        a = np.where(h > 0, self._select_zero(np.maximum(h - 1, 0)) - (h - 1), 0)
        b = np.minimum(self._select_zero(h) - h, self.n)
        a = np.minimum(a, self.n)
        if left is not None:
            a, b = np.maximum(a, left), np.minimum(b, right)
        end = b.copy()
        live = np.flatnonzero(a < b)
        while len(live):
            mid = (a[live] + b[live]) >> 1
            less = self._lows(mid) < low[live]
            a[live[less]] = mid[less] + 1
            b[live[~less]] = mid[~less]
            live = live[a[live] < b[live]]
        hit = a < end
        at = np.flatnonzero(hit)
        hit[at] = self._lows(a[at]) == low[at]
        a[beyond], hit[beyond] = self.n, False
        return a, hit


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """8-bit codes from 1 and the codebook (code 0 stands for none): the mean of each
    of 255 equally filled bins."""
    book = np.zeros(256, np.float32)
    if not len(values):
        return np.zeros(0, np.uint8), book
    distinct, inverse, count = np.unique(values, return_inverse=True, return_counts=True)
    if len(distinct) <= 255:
        book[1 : len(distinct) + 1] = distinct
        return (inverse + 1).astype(np.uint8), book
    place = (np.cumsum(count) - count) * 255 // len(values)
    total = np.bincount(place, distinct * count, 255)
    number = np.bincount(place, count, 255)
    book[1:] = np.where(number > 0, total / np.maximum(number, 1), 0)
    return (place[inverse] + 1).astype(np.uint8), book


class Trie:
    """Contexts, their successors, and quantised log10 factors of the probabilities."""

    def __init__(self, contexts: EliasFano, pointers: EliasFano, children: EliasFano, count: np.ndarray, share: np.ndarray, times: np.ndarray, books: np.ndarray):
        self.contexts, self.pointers, self.children = contexts, pointers, children
        self.count, self.share, self.times, self.books = count, share, times, books

    @classmethod
    def build(cls, words: np.ndarray, count: np.ndarray, child: np.ndarray, n: np.ndarray, prior: float) -> Trie:
        """words: sorted fingerprints; count: how often each occurs (0: another trie knows);
        child: sorted (rank of the context << 40 | successor); n: how often each bigram occurs."""
        kinds = np.bincount((child >> _U(CHILD_BITS)).astype(np.int64), minlength=len(words))
        used = count > 0
        share = np.zeros(len(words), np.uint8)
        share[used], book0 = quantise(-np.log10(count[used] + prior))
        times, book1 = quantise(np.log10(n))
        pointers = np.concatenate(([0], np.cumsum(kinds))).astype(np.uint64)
        return cls(EliasFano.build(words), EliasFano.build(pointers), EliasFano.build(child), count.astype(np.int64), share, times, np.stack([book0, book1]))

    def to_bytes(self) -> bytes:
        parts = [*self.contexts.parts(), *self.pointers.parts(), *self.children.parts(), self.count, self.books.ravel(), self.share, self.times]
        return b"".join(p.tobytes() for p in parts)

    @classmethod
    def over(cls, buffer) -> Trie:
        """A trie over a buffer, without copying it."""
        data = np.frombuffer(buffer, np.uint8)
        contexts, at = EliasFano.read(data, 0)
        pointers, at = EliasFano.read(data, at)
        children, at = EliasFano.read(data, at)
        n, m = contexts.n, children.n
        count = data[at : at + 8 * n].view(np.int64)
        at += 8 * n
        books = data[at : at + 2048].view(np.float32).reshape(2, 256)
        at += 2048
        return cls(contexts, pointers, children, count, data[at : at + n], data[at + n : at + n + m], books)

    def save(self, path: str) -> None:
        with open(path, "wb") as f:
            f.write(self.to_bytes())

    @classmethod
    def open(cls, path: str) -> Trie:
        """A trie over a memory-mapped file: pages are read as queries touch them."""
        return cls.over(np.memmap(path, np.uint8, "r"))

    def context(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each word and whether the trie has it."""
        return self.contexts.successor(words)

    def successors(self, rank: np.ndarray, n: np.ndarray, child: np.ndarray) -> np.ndarray:
        """Count codes of bigrams, 0 if unseen: the first n[0] of child (40 bits of the
        word) are sought between the pointers of context rank[0], and so on."""
        left, right = (self.pointers.get(r).astype(np.int64) for r in (rank, rank + 1))
        key = np.repeat(rank.astype(np.uint64) << _U(CHILD_BITS), n) | child
        at, hit = self.children.successor(key, np.repeat(left, n), np.repeat(right, n))
        out = np.zeros(len(at), np.uint8)
        out[hit] = self.times[at[hit]]
        return out
