"""Quality classifier: random-indexing word vectors and a two-layer network.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.  Random
indexing gives each word form a fixed sparse vector of +1 and -1 (its index
vector, drawn from a hash).  The vector of a form is the sum of the index vectors of its
neighbours over all documents, so words used alike get like vectors; a form is its full
64-bit fingerprint, and one without neighbours has a zero vector.  Beside its
vector a word has a shape: how it is written, what stands between it and the next word, and
whether it repeats the one before; shapes are a fixed table of index vectors.  A document is pooled from
its words: the mean over the document and, over its segments of ``SEGMENT`` words, the
largest and smallest mean.  A two-layer numpy network
gives a logit; a temperature fitted on a third of the sample that it did not see
calibrates it, together with an offset.

The contexts are counted in Spark, in whole numbers:

1. Fitting broadcasts the forms of its sample (bounded by the sample), adds up their
   contexts over all documents by partition and by range of forms, and collects one
   vector a form.  They travel with the model.
2. Scoring works on blocks of about ``BLOCK`` bytes.  A block sends the contexts of each
   form that the sample lacks to the form's shard, which adds up all blocks' and answers
   each with the vectors; the block's word numbers travel along, sorted within segments, and are pooled then.

A vector is kept in four bits a dimension: exact up to sums of 7, above scaled to 7
(only its direction is used).  There is a shard for every
``SHARD`` bytes of text, and as many as shuffle partitions at least, so shards keep their size as the input grows.

Inputs of a score are the words of the text alone, never labels, language,
source or id.  The network is fitted on at most ``SAMPLE`` labelled rows; contexts and
scores cover every text, whole.  Texts scored that are not those of the fit bring the contexts of forms that
the sample lacks themselves.

Edge cases: null and empty texts, and texts without a letter or digit, pool to zeros and get the
score the network gives
for that; repeated rows get equal scores; with no labels or one kind only, the
score is that kind's share (0.5 without any); an empty table gives an empty
result; an input column named like the result is replaced.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import base
from .language_model import _join, _shard, _split
from .textbatch import Words, groups, mix, words_of

SAMPLE = 4000
DIM = 32
SHAPE_DIM = 32
NONZERO = 2
SEGMENT = 40
REACH = 2
STEP_WORDS = 1 << 17
BLOCK = 12 << 20
#: Bytes of text for each shard, at most.
SHARD = 16 << 20
HIDDEN = 32
_U = np.uint64


def index_vectors(codes: np.ndarray, dim: int, seed: int) -> np.ndarray:
    """The sparse ternary index vector of each code."""
    out = np.zeros((len(codes), dim), np.float32)
    rows = np.arange(len(codes))
    for k in range(NONZERO):
        h = mix(codes ^ mix(np.full(1, seed * 31 + k, np.uint64)))
        out[rows, (h >> _U(8)) % _U(dim)] += np.where(h & _U(1), 1, -1)
    return out


_KINDS = np.zeros((5, 256), bool)
_KINDS[0, 65:91] = True  # upper case
_KINDS[1, 97:123] = True  # lower case
_KINDS[2, 48:58] = True  # digits
_KINDS[3, list(b"#*$%&|<>{}[]_=+~^\\/@")] = True  # symbols
_KINDS[4, list(b"!?")] = True


N_SHAPES = 4**6 * 2


def words(data: np.ndarray, off: np.ndarray) -> tuple[Words, np.ndarray]:
    """The words of some texts and a code for the shape of each: amounts (none, one, two, more)
    of five kinds of characters from its start to the next word's, its length, and
    whether it repeats the word before."""
    w = words_of(data, off, lower=True, punct=True)
    code = np.zeros(len(w.code), np.uint16)
    if not len(code):
        return w, code
    until = np.append(w.start[1:], len(data))
    last = w.first[1:][w.count > 0] - 1
    until[last] = off[1:][w.count > 0]
    total = np.zeros(len(data) + 1, np.int32)
    for k in range(5):
        np.cumsum(_KINDS[k][data], out=total[1:])
        code = code * 4 + np.minimum(total[until] - total[w.start], 3).astype(np.uint16)
    same = np.zeros(len(w.code), np.uint16)
    same[1:] = w.code[1:] == w.code[:-1]
    same[w.first[:-1][w.count > 0]] = 0
    return w, (code * 4 + np.minimum((w.end - w.start) // 4, 3).astype(np.uint16)) * 2 + same


#: Four dimensions travel in one 64-bit number, 16 bits each: sums of them stay apart while none
#: passes 32767, so for so many words with 2 * REACH neighbours each.
LANES, RUN = DIM // 4, 32767 // (2 * REACH * NONZERO)


def index_lanes(codes: np.ndarray) -> np.ndarray:
    """The index vectors of forms, four dimensions to a number: LANES x forms."""
    v = index_vectors(codes, DIM, 1).astype(np.int64).reshape(len(codes), LANES, 4)
    return np.ascontiguousarray((v << (16 * np.arange(4))).sum(2).T)


def _unlaned(x: np.ndarray) -> np.ndarray:
    """Sums of lanes (LANES x rows) as rows x DIM."""
    out = np.empty((x.shape[1], LANES, 4), np.int32)
    for k in range(4):
        out[:, :, k] = x.T.astype(np.int16)
        x = (x - x.astype(np.int16)) >> 16
    return out.reshape(-1, DIM)


def contexts(which: np.ndarray, first: np.ndarray, index: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """For each of ``rows`` rows the summed index vectors of the neighbours of its words.

    which: number of each word's form; first: the words of each text; index: the index lanes of
    the forms; row: that of each form, below zero for forms not asked for."""
    total = np.zeros((rows, DIM), np.int32)
    # Texts one after the other with gaps, which are a form without index vector
    n, docs, forms = len(which), len(first) - 1, index.shape[1]
    line = np.full(n + REACH * (docs + 1), forms, np.int32)
    line[np.arange(n) + np.repeat(REACH * np.arange(1, docs + 1), np.diff(first))] = which
    index, row = np.concatenate([index, np.zeros((LANES, 1), np.int64)], 1), np.append(row, -1)
    for a in range(REACH, len(line) - REACH, STEP_WORDS):  # a bounded number of words at a time
        b = min(len(line) - REACH, a + STEP_WORDS)
        near, of = line[a - REACH : b + REACH], row[line[a:b]]
        order = np.argsort(of, kind="stable")
        order = order[np.searchsorted(of[order], 0) :]
        if not len(order):
            continue
        of = of[order]
        new = np.concatenate(([True], of[1:] != of[:-1]))
        start = np.flatnonzero(new)
        nth = np.arange(len(of)) - np.repeat(start, np.diff(np.append(start, len(of))))
        begin = np.flatnonzero(nth % RUN == 0)
        sums = np.empty((LANES, len(begin)), np.int64)
        for k in range(LANES):
            x = index[k][near]
            around = sum(x[j : j + b - a] for j in range(2 * REACH + 1) if j != REACH)
            sums[k] = np.add.reduceat(around[order], begin)
        np.add.at(total, of[begin[~new[begin]]], _unlaned(sums[:, ~new[begin]]))
        total[of[start]] += _unlaned(sums[:, new[begin]])
    return total


def quantised(total: np.ndarray) -> np.ndarray:
    """Sums in -7 to 7, scaled where they pass it."""
    most = np.maximum(np.abs(total).max(1, initial=0), 7)
    return np.rint(total * (7.0 / most)[:, None]).astype(np.int8)


def unit(vectors: np.ndarray) -> np.ndarray:
    out = vectors.astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-6)


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers of a table in as few bytes as the largest needs, column by column and by byte
    planes, compressed.  Rows within -7 and 7 take half a byte a number and stand apart."""
    small = np.abs(x).max(1, initial=0) <= 7
    if x.shape[1] % 2 == 0 and small.any() and not small.all():
        parts = [pa.compress(np.packbits(small).tobytes(), "zstd", asbytes=True), _packed(x[small])]
        return b"m" + struct.pack("<qq", *map(len, parts)) + b"".join(parts) + _packed(x[~small])
    top = int(np.abs(x).max(initial=0))
    if small.all() and x.shape[1] % 2 == 0:
        u = (x + 8).astype(np.uint8)
        kind, raw = b"h", np.ascontiguousarray((u[:, ::2] * 16 + u[:, 1::2]).T).tobytes()
    else:
        kind = b"1" if top < 1 << 7 else b"2" if top < 1 << 15 else b"4" if top < 1 << 31 else b"8"
        raw = np.ascontiguousarray(np.ascontiguousarray(x.astype(f"<i{kind.decode()}")).view(np.uint8).T).tobytes()
    return kind + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(data: bytes, n: int, width: int = DIM) -> np.ndarray:
    kind = data[:1].decode()
    if kind == "m":
        a, b = struct.unpack_from("<qq", data, 1)
        small = np.unpackbits(np.frombuffer(pa.decompress(data[17 : 17 + a], decompressed_size=(n + 7) // 8, codec="zstd"), np.uint8))[:n] > 0
        rest = _unpacked(data[17 + a + b :], int((~small).sum()), width)
        out = np.empty((n, width), rest.dtype)
        out[small], out[~small] = _unpacked(data[17 + a : 17 + a + b], int(small.sum()), width), rest
        return out
    size = n * width // 2 if kind == "h" else n * width * int(kind)
    raw = np.frombuffer(pa.decompress(data[1:], decompressed_size=size, codec="zstd"), np.uint8) if size else np.zeros(0, np.uint8)
    if kind == "h":
        u = raw.reshape(width // 2, n).T
        out = np.empty((n, width), np.int8)
        out[:, ::2], out[:, 1::2] = (u >> 4).astype(np.int8) - 8, (u & 15).astype(np.int8) - 8
        return out
    return np.ascontiguousarray(raw.reshape(width * int(kind), n).T).view(f"<i{kind}").reshape(n, width)


def segments(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments of the texts' words: first segment of each text; first word and words of each segment."""
    segs = -(-np.diff(first) // SEGMENT)
    seg = np.concatenate(([0], np.cumsum(segs)))
    begin = np.repeat(first[:-1], segs) + SEGMENT * (np.arange(seg[-1]) - np.repeat(seg[:-1], segs))
    return seg, begin, np.minimum(begin + SEGMENT, np.repeat(first[1:], segs)) - begin


def _bags(x: np.ndarray, begin: np.ndarray, size: np.ndarray) -> bytes:
    """Numbers of words, whose order within a segment does not matter: sorted there, as differences."""
    at = np.repeat(np.arange(len(begin)) << 32, size)
    v = (np.sort(at + x) & 0xFFFFFFFF).astype(np.int64)
    d = np.diff(v, prepend=0)
    d[begin] = v[begin]
    return _packed(d[:, None])


def _unbagged(data: bytes, n: int, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    d = _unpacked(data, n, 1)[:, 0].astype(np.int64)
    total = np.cumsum(d)
    return total - np.repeat(total[begin] - d[begin], size)


def _packed_codes(code: np.ndarray) -> bytes:
    """Sorted fingerprints as differences."""
    d = np.diff(code, prepend=np.zeros(1, np.uint64))
    return pa.compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def _unpacked_codes(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd") if n else b"", np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, n).T).view(np.uint64).reshape(-1), dtype=np.uint64)


def pooled(table: np.ndarray, which: np.ndarray, look: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The pooled vector of each text; which: row of each word in the table of
    vectors; look: its shape."""
    n = np.diff(first)
    out = np.zeros((len(n), 3 * (DIM + SHAPE_DIM) + 1), np.float32)
    seg, begin, size = segments(first)
    total = np.empty((len(begin), DIM + SHAPE_DIM), np.float32)
    table = np.concatenate([table, np.zeros((1, DIM), np.float32)])
    shape_vectors = np.concatenate([index_vectors(np.arange(N_SHAPES).astype(np.uint64), SHAPE_DIM, 3), np.zeros((1, SHAPE_DIM), np.float32)])
    inner, step = np.arange(SEGMENT), max(1, STEP_WORDS // SEGMENT)
    for a in range(0, len(begin), step):  # a bounded number of words at a time
        some = slice(a, a + step)
        on = inner < size[some, None]
        at = np.where(on, begin[some, None] + inner, 0).ravel()
        for x, words_of_it, lo, width in ((table, which, 0, DIM), (shape_vectors, look, DIM, SHAPE_DIM)):
            row = np.where(on.ravel(), words_of_it[at], len(x) - 1)
            total[some, lo : lo + width] = np.einsum("skd->sd", np.take(x, row, axis=0).reshape(-1, SEGMENT, width))
    rows = np.flatnonzero(n)
    if len(rows):
        at = seg[:-1][rows]
        out[rows, : DIM + SHAPE_DIM] = np.add.reduceat(total, at, 0) / n[rows, None]
        mean = total / size[:, None]
        out[rows, DIM + SHAPE_DIM : 2 * (DIM + SHAPE_DIM)] = np.maximum.reduceat(mean, at, 0)
        out[rows, 2 * (DIM + SHAPE_DIM) : -1] = np.minimum.reduceat(mean, at, 0)
        out[rows, -1] = np.log1p(n[rows]) / 10
    return out


class WordVectors:
    """Context vectors of some forms, by their sorted fingerprints."""

    def __init__(self, code: np.ndarray, vectors: np.ndarray):
        self.code, self.vectors = code, vectors

    def row(self, code: np.ndarray) -> np.ndarray:
        """The row of each fingerprint, -1 for those that are not here."""
        at = np.minimum(np.searchsorted(self.code, code), max(0, len(self.code) - 1))
        return np.where(self.code[at] == code, at, -1) if len(self.code) else np.full(len(code), -1)

    @classmethod
    def count(cls, docs: DataFrame, code: np.ndarray) -> WordVectors:
        """The vectors of these forms, from all texts of docs."""
        spark = docs.sparkSession
        held = spark.sparkContext.broadcast(cls(code, np.zeros((0, DIM), np.int8)))
        parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        cuts = np.linspace(0, len(code), parts + 1).astype(np.int64)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, total = held.value, None
            for batch in batches:
                for _, _, data, off in groups(base.column(batch, "text").cast(pa.string()), 2 << 20):
                    w = words_of(data, off, lower=True, punct=True)
                    if total is None:
                        total = np.zeros((len(known.code), DIM), np.int64)
                    forms, which = np.unique(w.code, return_inverse=True)
                    row = known.row(forms)
                    mine = np.flatnonzero(row >= 0)
                    place = np.full(len(forms), -1)
                    place[mine] = np.arange(len(mine))
                    total[row[mine]] += contexts(which, w.first, index_lanes(forms), place, len(mine))
            if total is not None:
                some = np.flatnonzero(total.any(1))
                ends = np.searchsorted(some, cuts)
                for k in np.flatnonzero(np.diff(ends)):
                    at = some[ends[k] : ends[k + 1]]
                    yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([_packed(np.diff(at, prepend=cuts[k])[:, None])], pa.binary()), pa.array([len(at)]), pa.array([_packed(total[at])], pa.binary())], names=["part", "rows", "n", "sums"])

        def gather(group: pa.Table) -> pa.Table:
            k = group["part"][0].as_py()
            total = np.zeros((cuts[k + 1] - cuts[k], DIM), np.int64)
            for rows, n, sums in zip(group["rows"], group["n"].to_pylist(), group["sums"]):
                total[np.cumsum(_unpacked(rows.as_py(), n, 1)[:, 0].astype(np.int64))] += _unpacked(sums.as_py(), n)
            return pa.table({"part": pa.array([k]), "vectors": pa.array([quantised(total).tobytes()], pa.binary())})

        vectors = np.zeros((len(code), DIM), np.int8)
        found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(add, "part bigint, rows binary, n bigint, sums binary")
        for r in found.groupBy("part").applyInArrow(gather, "part bigint, vectors binary").collect():
            vectors[cuts[r.part] : cuts[r.part + 1]] = np.frombuffer(r.vectors, np.int8).reshape(-1, DIM)
        held.unpersist()
        return cls(code, vectors)

    def pool(self, texts: pa.Array) -> np.ndarray:
        """The pooled vector of each text; forms that are not here have a zero vector."""
        out = [np.zeros((0, 3 * (DIM + SHAPE_DIM) + 1), np.float32)]
        table = np.concatenate([unit(self.vectors), np.zeros((1, DIM), np.float32)])
        for _, _, data, off in groups(texts):
            w, look = words(data, off)
            out.append(pooled(table, self.row(w.code), look, w.first))
        return np.concatenate(out)


def forms_in(texts: list[str]) -> np.ndarray:
    """The sorted fingerprints of all words."""
    out = [np.zeros(0, np.uint64)]
    for _, _, data, off in groups(pa.array(texts, pa.string())):
        out.append(np.unique(words_of(data, off, lower=True, punct=True).code))
    return np.unique(np.concatenate(out))


class Network:
    """Two layers: tanh, then one logit."""

    def __init__(self, parts: list[np.ndarray], mean: np.ndarray, scale: np.ndarray, calibration: tuple[float, float] = (1.0, 0.0)):
        self.parts, self.mean, self.scale, self.calibration = parts, mean, scale, calibration

    def logit(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.parts
        return (np.tanh(((x - self.mean) / self.scale) @ w1 + b1) @ w2 + b2)[:, 0].astype(np.float64)

    def score(self, x: np.ndarray) -> np.ndarray:
        temperature, offset = self.calibration
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / temperature + offset, -35, 35)))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, *, epochs: int = 60, rate: float = 3e-3, decay: float = 1e-3, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        net = cls(
            [
                rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)).astype(np.float32),
                np.zeros(HIDDEN, np.float32),
                rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 1)).astype(np.float32),
                np.zeros(1, np.float32),
            ],
            x.mean(0),
            x.std(0) + 1e-2,
        )
        z = (x - net.mean) / net.scale
        m, v, t = [np.zeros_like(p) for p in net.parts], [np.zeros_like(p) for p in net.parts], 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for k in range(0, len(y), 64):
                at = order[k : k + 64]
                w1, b1, w2, b2 = net.parts
                h = np.tanh(z[at] @ w1 + b1)
                p = 1 / (1 + np.exp(-np.clip((h @ w2 + b2)[:, 0], -30, 30)))
                g = ((p - y[at]) / len(at))[:, None].astype(np.float32)
                gh = (g @ w2.T) * (1 - h * h)
                t += 1
                for i, d in enumerate((z[at].T @ gh + decay * w1, gh.sum(0), h.T @ g + decay * w2, g.sum(0))):
                    m[i] = 0.9 * m[i] + 0.1 * d
                    v[i] = 0.999 * v[i] + 0.001 * d * d
                    net.parts[i] = (net.parts[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
        return net


def calibrate(logit: np.ndarray, y: np.ndarray, steps: int = 300) -> tuple[float, float]:
    """Temperature and offset that minimise the log loss of rows not trained on
    (Newton's method on slope and offset, with a weak prior to slope 1)."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * logit + b, -30, 30)))
        g = np.array([((p - y) * logit).sum() + 0.5 * (a - 1), (p - y).sum() + 0.01 * b])
        q = p * (1 - p)
        hess = np.array([[(q * logit * logit).sum() + 0.5, (q * logit).sum()], [(q * logit).sum(), q.sum() + 0.01]])
        step = np.linalg.solve(hess + 1e-6 * np.eye(2), g)
        step *= min(1.0, 1.0 / max(1e-9, np.abs(step).max()))
        a, b = max(0.05, a - step[0]), b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return 1 / a, b


Model = tuple[WordVectors, Network] | float


def fit(docs: DataFrame, labels: DataFrame, *, where=None, sample: int = SAMPLE) -> Model:
    """where: a condition on the id's column name that training rows must meet."""
    rows = base.labelled_sample(docs, labels, "quality", sample, where=where)
    texts, y = [t for _, t, _ in rows], np.array([float(y > 0) for _, _, y in rows])
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    vectors = WordVectors.count(docs, forms_in(texts))
    x = vectors.pool(pa.array(texts, pa.string()))
    kept = np.arange(len(y)) % 3 != 0
    if len(set(y[kept].tolist())) < 2:
        kept[:] = True
    net = Network.fit(x[kept], y[kept])
    test = ~kept if (~kept).any() else kept
    net.calibration = calibrate(net.logit(x[test]), y[test])
    return vectors, net


_REQUEST = "shard bigint, block bigint, forms binary, sums binary, state binary"
_ANSWER = "shard bigint, block bigint, vectors binary, state binary"


def _ask(held, keys: list[str], shards: int, block: int):
    """Each block's contexts of the forms that the model lacks, by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        known = held.value[0]
        for batch in batches:
            for i, j, data, off in groups(base.column(batch, "text"), block):
                w, look = words(data, off)
                first = w.first.astype(np.int64)
                code, which, times = np.unique(w.code, return_inverse=True, return_counts=True)
                del w
                # Forms that the model has come first, frequent ones in front (small numbers
                # compress), then the others by shard and fingerprint
                row = known.row(code)
                shard = np.where(row >= 0, -1, _shard(code, shards))
                order = np.lexsort((code, np.where(row >= 0, -times, 0), shard))
                rank = np.empty_like(order)
                rank[order] = np.arange(len(order))
                code, row, which, shard = code[order], row[order], rank[which].astype(np.int32), shard[order]
                del order, rank, times
                cuts = np.searchsorted(shard, np.arange(shards + 1))
                mine = int(cuts[0])  # forms of the model
                place = np.concatenate([np.full(mine, -1), np.arange(len(code) - mine)])
                sums = contexts(which, first, index_lanes(code), place, len(code) - mine)
                rows = pa.RecordBatch.from_arrays([base.column(batch, k).slice(i, j - i) for k in keys], names=keys)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_batch(rows)
                parts = segments(first)[1:]
                sent = [_packed(np.diff(first)[:, None]), _packed(row[:mine][:, None]), _bags(which, *parts), _bags(look, *parts)]
                state = _join(np.array([len(rows), mine]), np.frombuffer(sink.getvalue(), np.uint8), *[np.frombuffer(x, np.uint8) for x in sent])
                home = number % shards
                # A shard without forms here is not asked, but for the home of the state
                asked = [s for s in range(shards) if cuts[s] < cuts[s + 1] or s == home]
                parts = [slice(cuts[s], cuts[s + 1]) for s in asked]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(asked),
                        pa.array([number] * len(asked)),
                        pa.array([_join(np.array([c.stop - c.start])) + _packed_codes(code[c]) for c in parts], pa.binary()),
                        pa.array([_packed(sums[c.start - mine : c.stop - mine]) for c in parts], pa.binary()),
                        pa.array([state if s == home else None for s in asked], pa.binary()),
                    ],
                    names=["shard", "block", "forms", "sums", "state"],
                )
                del which, look, sums, code, row, shard, place, state, sent
                number += 1

    return run


def _serve(group: pa.Table) -> pa.Table:
    """The vectors of a shard's forms, over all blocks, for each block."""
    codes = [_unpacked_codes(f.as_py()[16:], int(_split(f.as_py(), "i8")[0][0])) for f in group["forms"]]
    forms, at = np.unique(np.concatenate(codes), return_inverse=True)
    cuts = np.cumsum([0] + [len(c) for c in codes])
    total = np.zeros((len(forms), DIM), np.int64)
    for k, sums in enumerate(group["sums"]):
        total[at[cuts[k] : cuts[k + 1]]] += _unpacked(sums.as_py(), len(codes[k]))
    vectors = quantised(total)
    answers = [_join(np.array([len(c)])) + _packed(vectors[at[cuts[k] : cuts[k + 1]]]) for k, c in enumerate(codes)]
    return pa.table({"shard": group["shard"], "block": group["block"], "vectors": pa.array(answers, pa.binary()), "state": group["state"]})


def _finish(held, keys: list[str], out: str):
    def run(group: pa.Table) -> pa.Table:
        known, net = held.value
        group = group.sort_by("shard")
        state = next(x.as_py() for x in group["state"] if x.is_valid)
        (docs, mine), blob, *sent = _split(state, "i8 u1 u1 u1 u1 u1")
        n, row = (_unpacked(x.tobytes(), int(k), 1)[:, 0] for x, k in zip(sent, (docs, mine)))
        first = np.concatenate(([0], np.cumsum(n.astype(np.int64))))
        which, look = (_unbagged(x.tobytes(), int(first[-1]), *segments(first)[1:]) for x in sent[2:])
        answers = [x.as_py() for x in group["vectors"]]
        table = unit(np.concatenate([known.vectors[row], *[_unpacked(x[16:], int(_split(x, "i8")[0][0])) for x in answers]]))
        x = pooled(table, which, look, first)
        rows = pa.ipc.open_stream(pa.py_buffer(blob.tobytes())).read_all()
        return pa.table({**{k: rows[k] for k in keys}, out: pa.array(net.score(x), pa.float64())})

    return run


def score(docs: DataFrame, model: Model, *, text: str = "text", out: str = "score", keys: tuple[str, ...] | None = None, shards: int | None = None, block: int = BLOCK) -> DataFrame:
    """docs (its columns ``keys``, if given) with the calibrated probability of good quality in ``out``.  Unless
    ``shards`` is given, the texts' bytes are added up first: there is a shard for every ``SHARD`` of them at least."""
    spark = docs.sparkSession
    keep = [c for c in keys or docs.columns if c.lower() != out.lower()]
    if isinstance(model, float):
        return docs.select(*keep, F.lit(model).alias(out))
    held = spark.sparkContext.broadcast(model)
    names = [f"key{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text).cast("string").alias("text"))
    if not shards:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD))
    served = rows.mapInArrow(_ask(held, names, shards, block), _REQUEST).groupBy("shard").applyInArrow(_serve, _ANSWER)
    schema = StructType([StructField(n, docs.schema[c].dataType) for c, n in zip(keep, names)] + [StructField("score", DoubleType())])
    done = served.groupBy("block").applyInArrow(_finish(held, names, "score"), schema)
    return done.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], F.col("score").alias(out))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, base.table(spark, sf_dir, "labels"), where=lambda i: base.crc_mod(i, 5) != 0)
    out = score(docs, model, keys=("doc_id",))
    return out.select("doc_id", (base.crc_mod("doc_id", 5) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
