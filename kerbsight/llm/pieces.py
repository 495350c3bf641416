"""SentencePiece encoding by sampling over the piece lattice, and lossless decoding.

Text is escaped as SentencePiece does: a space goes in front and every space
becomes U+2581.  All pieces of the vocabulary that match at a place are arcs of a
lattice over the characters; a character without a piece is one arc of byte
pieces.  Forward filtering sums the weight of all paths to each place; backward
sampling then draws arcs from the end, each in proportion to the weight of the
paths through it.  The draws hash (seed, row key, place in the text), so a row
always gets the same segmentation, wherever and however often it is computed.

No piece crosses from a word into a following space, nor a line break, so the
lattice falls into independent units (spaces and the word behind them).  Filtering is
done once per distinct unit of a batch, all units side by side, and sampling for
all occurrences side by side.

Weights: a BPE vocabulary scores pieces by merge rank, not by probability, so a
piece weighs (rank + 2) ** -theta; with another kind of model its score is taken
as a log probability and multiplied by theta.

Edge cases: null gives null, an empty text gives no pieces; a literal U+2581 is
always spelled in bytes, so that decoding restores it; runs of spaces, leading
and trailing ones, line breaks and control characters come back as they were;
long texts are encoded whole, in slices cut between units, which changes
nothing; a null row key is a key of its own; rows with equal key and text get
equal pieces; input columns named like the result are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from . import base
from .textbatch import _STEP, _STEP_INV, _powers, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
THETA = 1.0
SEED = 1
SLICE = 1 << 18
SPACE = 0x2581
#: Stands for a literal U+2581, outside Unicode's range.
LITERAL = 0x110000 + SPACE
_U = np.uint64


class Vocabulary:
    """Pieces of a model file, as hashes of their code points."""

    def __init__(self, model: bytes, theta: float = THETA):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.bytes: list[bytes] = [b""] * n
        self.byte_id = np.full(256, -1, np.int64)
        text, score = {}, {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(piece[1:-1], 16)
                self.byte_id[b] = i
                self.bytes[i] = bytes([b])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                text[i], score[i] = piece, sp.get_score(i)
                self.bytes[i] = piece.replace(chr(SPACE), " ").encode()
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte fallback, so decoding could lose text")
        for p in text.values():
            if chr(SPACE) in p.lstrip(chr(SPACE)):
                raise ValueError(f"piece {p!r} crosses units")
        joined = {ord(c) for p in text.values() if len(p) > 1 for c in p}
        #: Control characters that no longer piece holds: units end there.
        self.parts = np.array([c not in joined for c in range(32)] + [False])
        ranked = min(score.values()) < -1000.0
        weight = {i: -theta * np.log(2.0 + min(-s, n)) if ranked else theta * s for i, s in score.items()}
        self.longest = max(len(p) for p in text.values())
        ids = np.array(list(text), np.int64)
        hashes = np.array([_hash([ord(c) for c in p]) for p in text.values()], np.uint64)
        order = np.argsort(hashes)
        self.hash, self.id = hashes[order], ids[order]
        self.weight = np.array([weight[i] for i in self.id.tolist()])
        assert len(np.unique(self.hash)) == len(ids)
        self._place()
        self.fallback = (-theta * np.log(2.0 + n)) if ranked else min(weight.values()) - 10.0 * theta

    def _place(self) -> None:
        """Two direct-mapped tables from hash bits to pieces; what meets in the
        first goes to the second."""
        self.bits = max(16, int(len(self.hash)).bit_length() + 4)
        while True:
            mask = _U((1 << self.bits) - 1)
            first = np.full(1 << self.bits, -1, np.int32)
            order = np.arange(len(self.hash), dtype=np.int32)
            first[self.hash & mask] = order
            lost = order[first[self.hash & mask] != order]
            second = np.full(1 << self.bits, -1, np.int32)
            at = (self.hash[lost] >> _U(32)) & mask
            second[at] = lost
            if len(np.unique(at)) == len(lost):
                self.mask, self.first, self.second = mask, first, second
                return
            self.bits += 1

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are pieces, and their rows."""
        k = self.first[h & self.mask]
        ok = (k >= 0) & (self.hash[k] == h)
        at = np.flatnonzero(~ok)
        k2 = self.second[(h[at] >> _U(32)) & self.mask]
        more = (k2 >= 0) & (self.hash[k2] == h[at])
        ok[at[more]], k[at[more]] = True, k2[more]
        at = np.flatnonzero(ok)
        return at, k[at]

    def decode(self, ids) -> str:
        data = b"".join(map(self.bytes.__getitem__, ids))
        return data[1:].decode("utf-8", "replace")


def _code(points: np.ndarray) -> np.ndarray:
    return mix(points.astype(np.uint64) + _U(77))


def _hash(points: list[int]) -> int:
    c = _code(np.array(points))
    return int(mix(np.array([(c * _powers(_STEP, len(c))).sum()], np.uint64) ^ _U(len(c)))[0])


def _prefix(code: np.ndarray, pow_: np.ndarray) -> np.ndarray:
    total = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(code * pow_[: len(code)], out=total[1:])
    return total


class Encoder:
    """Forward filtering and backward sampling for slices of text."""

    def __init__(self, vocabulary: Vocabulary, seed: int = SEED):
        self.v, self.seed = vocabulary, seed
        self.pow = _powers(_STEP, 4 * SLICE)
        self.inv = _powers(_STEP_INV, 4 * SLICE)

    def _room(self, n: int) -> None:
        if n > len(self.pow):
            self.pow, self.inv = _powers(_STEP, 2 * n), _powers(_STEP_INV, 2 * n)

    def encode(self, points: np.ndarray, place: np.ndarray, key: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """points: escaped code points; place and key: position in the text and
        row key of each; cuts: offsets at which slices start.  Returns the pieces and for
        each the offset of the point at which its arc ends."""
        n, v = len(points), self.v
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._room(n + 1)
        space, control = points == SPACE, v.parts[np.minimum(points, 32)]
        begin = np.zeros(n, bool)
        begin[1:] = (space[1:] & ~space[:-1]) | control[1:] | control[:-1]
        begin[cuts] = True
        start = np.flatnonzero(begin)
        size = np.diff(np.append(start, n))
        code = _code(points)
        total = _prefix(code, self.pow)
        key_of = mix((total[start + size] - total[start]) * self.inv[start] ^ size.astype(np.uint64))
        _, first, which = np.unique(key_of, return_index=True, return_inverse=True)
        # The distinct units, one after the other, longest first
        order = np.argsort(-size[first], kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        which, first = rank[which], first[order]
        usize = size[first]
        # Places side by side: all first points, then all second points, ...
        alive = np.searchsorted(-usize, -np.arange(int(usize[0])), "left")
        block = np.concatenate(([0], np.cumsum(alive)))
        step = np.repeat(np.arange(len(alive)), alive)
        at = start[first][np.arange(block[-1]) - block[step]] + step
        arc, cdf = self._filter(points, total, at, step, block)
        # Backward sampling: all occurrences step from the end of their unit to its start.
        chosen = np.full(n, -1, np.int64)
        occ, pos = np.arange(len(start)), size.copy()
        while len(occ):
            here = start[occ] + pos - 1
            row = block[pos - 1] + which[occ]
            r = mix(key[here] + mix(place[here].astype(np.uint64) * _U(2) + _U(1)))
            u = (r >> _U(40)).astype(np.float32) * np.float32(2.0**-24)
            length = np.minimum((cdf[row] <= u[:, None]).sum(1), cdf.shape[1] - 1)
            chosen[here] = arc[row, length]
            pos = pos - (length + 1)
            on = pos > 0
            occ, pos = occ[on], pos[on]
        end = np.flatnonzero(chosen >= 0)
        ids = chosen[end]
        spelled = ids == len(v.bytes)
        if spelled.any():
            ids, end = self._spell(ids, end, points, spelled)
        return ids, end

    def _filter(self, points, total, at, step, block) -> tuple[np.ndarray, np.ndarray]:
        """For each row (a place in a distinct unit) the arc of every length that
        ends there (piece id) and the cumulated probability of drawing it.

        total: prefix sums over the points; at: the point of each row; step: its
        place in its unit; block: the first row of each place."""
        v, n = self.v, len(at)
        width = int(min(v.longest, len(block) - 1))
        arc = np.full((n, width), -1, np.int32)
        weight = np.full((n, width), -np.inf, np.float32)
        upto = total[at + 1]
        for length in range(1, width + 1):
            low = block[length - 1]  # rows from here on have so many points before them
            begin = at[low:] - (length - 1)
            h = mix((upto[low:] - total[begin]) * self.inv[begin] ^ _U(length))
            found, k = v.find(h)
            arc[low + found, length - 1] = v.id[k]
            weight[low + found, length - 1] = v.weight[k]
        bare = np.flatnonzero(arc[:, 0] < 0)
        arc[bare, 0] = len(v.bytes)
        weight[bare, 0] = v.fallback * _utf8_size(points[at[bare]])
        # alpha: log weight of all paths from the unit's start to behind the row's point
        alpha = np.zeros(n)
        cdf = np.ones((n, width), np.float32)
        for t in range(len(block) - 1):
            a, b = block[t], block[t + 1]
            w = min(width, t + 1)
            x = weight[a:b, :w].astype(np.float64)
            for k in range(min(w, t)):
                c = block[t - 1 - k]
                x[:, k] += alpha[c : c + b - a]
            top = x.max(1, keepdims=True)
            x -= top
            np.exp(x, out=x)
            np.cumsum(x, 1, out=x)
            alpha[a:b] = top[:, 0] + np.log(x[:, -1])
            x /= x[:, -1:]
            cdf[a:b, :w] = x
            # Rounding never draws an arc without mass: the last one with mass ends at 1.
        return arc, cdf

    def _spell(self, ids, end, points, spelled):
        cp = points[end[spelled]].astype(np.int64)
        cp = np.where(cp == LITERAL, SPACE, cp)
        k = _utf8_size(cp)
        per = np.ones(len(ids), np.int64)
        per[spelled] = k
        out, oend = np.repeat(ids, per), np.repeat(end, per)
        lead = np.cumsum(per) - per
        lead = lead[spelled]
        for size, first in ((1, 0), (2, 0xC0), (3, 0xE0), (4, 0xF0)):
            m = k == size
            for b in range(size):
                shift = 6 * (size - 1 - b)
                value = (cp[m] >> shift) | first if b == 0 else ((cp[m] >> shift) & 0x3F) | 0x80
                out[lead[m] + b] = self.v.byte_id[value]
        return out, oend


def _utf8_size(cp: np.ndarray) -> np.ndarray:
    cp = np.where(cp == LITERAL, SPACE, cp)
    return 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)


def slices(texts: list[str | None], limit: int = SLICE):
    """(document, place of its first point, escaped text without the leading space)
    in order; a long text is cut before the spaces that follow a word."""
    for d, t in enumerate(texts):
        if not t:
            continue
        at = 0
        while at < len(t):
            to = len(t)
            if to - at > limit:
                k = at + limit
                while True:
                    k = t.find(" ", k)
                    if k < 0:
                        break
                    if t[k - 1] != " ":
                        to = k
                        break
                    k += 1
            yield d, at, t[at:to]
            at = to


def encode_all(encoder: Encoder, texts: list[str | None], keys: np.ndarray) -> list[np.ndarray | None]:
    """The pieces of each text; keys: uint64 row keys."""
    out: list[list[np.ndarray] | None] = [None if t is None else [] for t in texts]
    held: list[tuple[int, int, str]] = []
    length = 0

    def run() -> None:
        raw = "".join(s if at else " " + s for _, at, s in held)
        points = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        points = np.where(points == SPACE, LITERAL, np.where(points == 32, SPACE, points))
        size = np.array([len(s) + (not at) for _, at, s in held])
        cuts = np.cumsum(size) - size
        offset = np.array([at if not at else at + 1 for _, at, _ in held])
        place = np.arange(len(points)) + np.repeat(offset - cuts, size)
        row = mix(np.array([keys[d] for d, _, _ in held], np.uint64) ^ mix(np.full(1, encoder.seed, np.uint64)))
        ids, end = encoder.encode(points, place, np.repeat(row, size), cuts)
        for (d, _, _), a, b in zip(held, np.searchsorted(end, cuts).tolist(), np.searchsorted(end, cuts + size).tolist()):
            out[d].append(ids[a:b])

    for d, at, s in slices(texts):
        held.append((d, at, s))
        length += len(s)
        if length >= SLICE:
            run()
            held, length = [], 0
    if held:
        run()
    return [None if x is None else np.concatenate(x).astype(np.int32) if x else np.zeros(0, np.int32) for x in out]


_CACHE: dict = {}


def _vocabulary(model, theta: float) -> Vocabulary:
    data = model.value
    k = (hashlib.sha256(data).hexdigest(), theta)
    if k not in _CACHE:
        _CACHE[k] = Vocabulary(data, theta)
    return _CACHE[k]


def _model(spark: SparkSession, path: str):
    """The model file's bytes (0.5 MB for 32,000 pieces), broadcast from the driver."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, *, text: str = "text", key: str = "doc_id", model: str = MODEL, theta: float = THETA, seed: int = SEED, out: str = "pieces") -> DataFrame:
    """docs with the sampled pieces (array of int) of each text in ``out``."""
    held = _model(docs.sparkSession, model)
    k = base.free_name(docs, "row_key")

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        encoder = Encoder(_vocabulary(held, theta), seed)
        keys = np.asarray(base.column(batch, k)).astype(np.int64).view(np.uint64)
        got = encode_all(encoder, base.column(batch, text).to_pylist(), keys)
        return {out: pa.array(got, pa.list_(pa.int32()))}

    return base.map_arrow(docs.withColumn(k, F.xxhash64(F.col(key))), run, StructType([StructField(out, ArrayType(IntegerType()))]), keep=docs.columns)


def decode(rows: DataFrame, *, pieces: str = "pieces", model: str = MODEL, out: str = "decoded") -> DataFrame:
    """rows with the text that the pieces spell in ``out``."""
    held = _model(rows.sparkSession, model)

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        v = _vocabulary(held, THETA)
        return {out: pa.array([None if x is None else v.decode(x) for x in base.column(batch, pieces).to_pylist()], pa.string())}

    return base.map_arrow(rows, run, StructType([StructField(out, StringType())]))


def round_trip(docs: DataFrame, *, text: str = "text", key: str = "doc_id", model: str = MODEL, theta: float = THETA, seed: int = SEED, out: str = "pieces") -> DataFrame:
    """As encode, with a column ``lossless``: decoding the pieces gives the text
    again.  One pass, where encode and decode take two."""
    held = _model(docs.sparkSession, model)
    k = base.free_name(docs, "row_key")

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        v = _vocabulary(held, theta)
        texts = base.column(batch, text).to_pylist()
        got = encode_all(Encoder(v, seed), texts, np.asarray(base.column(batch, k)).astype(np.int64).view(np.uint64))
        same = [x is None if t is None else v.decode(x.tolist()) == t for t, x in zip(texts, got)]
        return {out: pa.array(got, pa.list_(pa.int32())), "lossless": pa.array(same)}

    added = StructType([StructField(out, ArrayType(IntegerType())), StructField("lossless", BooleanType())])
    return base.map_arrow(docs.withColumn(k, F.xxhash64(F.col(key))), run, added, keep=docs.columns)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.size("pieces").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("pieces", ",").cast("binary"), 256).alias("pieces_sha256"),
        "lossless",
    )
