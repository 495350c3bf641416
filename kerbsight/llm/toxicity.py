"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A text is read in overlapping windows of ``WINDOW`` words to its end; one starts every
``STRIDE`` words, so every word and every run of ``WINDOW - STRIDE`` words lies whole in some window
(that is the meaning of all windows here).  A word enters as the sum of a word vector and of its
character vectors (hashed n-grams of 3 to 5 bytes with word borders, scaled by
the root of their number).  Forms in ``MIN_DOCS`` training texts or more have a row of their own in the
word table, found by their full fingerprint; all others have the zero vector.  The n-grams share ``CHARS`` =
65,536 hashed rows, zero below ``MIN_DOCS`` training texts.  A GRU reads the window from either side,
attention pools its states, and a linear layer
gives a logit.  A text scores by its most toxic window, calibrated (slope and offset)
on a third of the sample that the network did not see.

The network is written and trained in numpy: backpropagation through time on
windows, from at most ``SAMPLE`` labelled rows.  Labels are of texts, and few windows of a toxic text are
toxic, so training has a start and a choice of windows:

* One dimension of each table starts with how much more often a form (an n-gram) occurs in toxic training
  texts, in standard errors of the log odds; the rest is drawn at random.
* Of each text that isn't toxic ``NEGATIVE`` windows are trained on, of a toxic one the ``SURE`` share that
  look most toxic: by that start in the first round, by the network after it.  Toxic windows weigh
  as much as the others together, at most ``MOST_WEIGHT`` times.

Scoring covers all windows of every text.  Inputs are the words alone, never labels,
language, source or id.

Edge cases: null and empty texts have one empty window, whose logit is the output
layer's bias; a text shorter than a window makes one padded window, padding being masked;
repeated rows get equal scores; with labels of one kind only, the score is that
kind's share (0 without any); an empty table gives an empty result; an input
column named like the result is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import base
from .quality_classifier import calibrate
from .textbatch import _POW, Words, groups, mix, words_of

SAMPLE = 4500
NEGATIVE = 3
SURE = 0.15
MOST_WEIGHT = 6.0
#: The start's standard errors enter the tables divided by these.
WORD_START, CHAR_START = 1.0, 4.0
MIN_DOCS = 3
WINDOW = 24
STRIDE = 16
DIM = 16
HIDDEN = 8
CHARS = 1 << 16
#: Windows scored side by side.
BATCH = 4096
_U = np.uint64
_BYTE = mix(np.arange(256, dtype=np.uint64) + _U(1000))


def char_rows(forms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of each form: (rows of the character table, first index of each form)."""
    raw = b"".join(b"<" + f + b">" for f in forms)
    size = np.array([len(f) + 2 for f in forms], np.int64)
    code = _BYTE[np.frombuffer(raw, np.uint8)] if raw else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(forms)), size)
    rows, at = [], []
    for n in (3, 4, 5):
        if len(code) < n:
            continue
        m = len(code) - n + 1
        h = np.zeros(m, np.uint64)
        for k in range(n):
            h += code[k : k + m] * _POW[k + 1]
        inside = np.flatnonzero(owner[:m] == owner[n - 1 :])
        rows.append((mix(h[inside] + _U(n)) % _U(CHARS)).astype(np.int32))
        at.append(owner[inside])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(len(forms), np.int64)
    rows, at = np.concatenate(rows), np.concatenate(at)
    order = np.argsort(at, kind="stable")
    return rows[order], np.searchsorted(at[order], np.arange(len(forms) + 1))


def _gather(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the values of each row: (distinct rows, sums)."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    return rows[first], np.add.reduceat(values[order], first, 0)


def forms_of(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words: fingerprints, character rows, their first
    indices; and which distinct word each word is."""
    codes, first, which = np.unique(w.code, return_index=True, return_inverse=True)
    raw = w.data.tobytes()
    # n-grams of a very long word: all of them, as of any other
    forms = [raw[a:b] for a, b in zip(w.start[first].tolist(), w.end[first].tolist())]
    rows, cuts = char_rows(forms)
    return codes, rows, cuts, which


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over the words of each text: (text, first word, words)."""
    n = np.diff(first)
    per = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    doc = np.repeat(np.arange(len(n)), per)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    begin = first[doc] + k * STRIDE
    return doc, begin, np.clip(first[doc + 1] - begin, 0, WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters: word and char tables; for each direction input and state
    weights of the three gates; attention; output."""

    NAMES = ("word", "char", "wf", "uf", "bf", "wb", "ub", "bb", "wa", "va", "wo", "bo")

    def __init__(self, p: dict[str, np.ndarray], codes: np.ndarray, calibration: tuple[float, float] = (1.0, 0.0)):
        self.p, self.codes, self.calibration = p, codes, calibration

    def rows(self, code: np.ndarray) -> np.ndarray:
        """The row of each form in the word table; the last, of zeros, for unknown ones."""
        at = np.searchsorted(self.codes, code)
        hit = at < len(self.codes)
        hit[hit] = self.codes[at[hit]] == code[hit]
        return np.where(hit, at, len(self.codes))

    @classmethod
    def new(cls, rng: np.random.Generator, codes: np.ndarray) -> Network:
        """codes: the sorted fingerprints of the forms that have a word vector."""

        def draw(*shape: int, by: float) -> np.ndarray:
            return (rng.normal(0, 1, shape) * by).astype(np.float32)

        h = HIDDEN
        p = {"word": draw(len(codes) + 1, DIM, by=0.05), "char": draw(CHARS, DIM, by=0.05)}
        p["word"][-1] = 0
        for d in "fb":
            p["w" + d], p["u" + d], p["b" + d] = draw(DIM, 3 * h, by=DIM**-0.5), draw(h, 3 * h, by=h**-0.5), np.zeros(3 * h, np.float32)
        p |= {"wa": draw(2 * h, h, by=(2 * h) ** -0.5), "va": draw(h, by=1.0), "wo": draw(2 * h, by=0.3), "bo": np.zeros(1, np.float32)}
        return cls(p, codes)

    def inputs(self, word: np.ndarray, rows: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The input vector of each distinct word; one more row of zeros for padding."""
        out = np.zeros((len(word) + 1, DIM), self.p["word"].dtype)
        out[:-1] = self.p["word"][word]
        n = np.diff(cuts)
        has = np.flatnonzero(n)
        step = 1 << 14
        for k in range(0, len(has), step):  # a bounded number of words at a time
            some = has[k : k + step]
            a, b = cuts[some[0]], cuts[some[-1] + 1]
            out[some] += np.add.reduceat(self.p["char"][rows[a:b]], cuts[some] - a, 0) / np.sqrt(n[some, None])
        return out

    def _run(self, gates: np.ndarray, u: np.ndarray, mask: np.ndarray, back: bool, keep: list | None) -> np.ndarray:
        """States of one direction: steps x windows x hidden."""
        steps, m, _ = gates.shape
        h, n = HIDDEN, np.zeros((m, HIDDEN), np.float32)
        out = np.empty((steps, m, h), np.float32)
        for t in range(steps - 1, -1, -1) if back else range(steps):
            g = n @ u
            zr = _sigmoid(gates[t, :, : 2 * h] + g[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            c = np.tanh(gates[t, :, 2 * h :] + r * g[:, 2 * h :])
            on = mask[t][:, None]
            new = n + on * (1 - z) * (c - n)
            if keep is not None:
                keep.append((t, n, z, r, c, g[:, 2 * h :]))
            n = new
            out[t] = n
        return out

    def _head(self, states: np.ndarray, mask: np.ndarray):
        a = np.tanh(states @ self.p["wa"])
        e = a @ self.p["va"]
        e = np.where(mask, e, -1e9)
        e = np.exp(e - e.max(0))
        e = e * mask
        w = e / np.maximum(e.sum(0), 1e-9)
        c = (w[:, :, None] * states).sum(0)
        return a, w, c, c @ self.p["wo"] + self.p["bo"][0]

    def logits(self, x: np.ndarray, index: np.ndarray) -> np.ndarray:
        """x: input vectors; index: steps x windows into x (the last row: padding)."""
        p = self.p
        gf, gb = x @ p["wf"] + p["bf"], x @ p["wb"] + p["bb"]
        out = np.empty(index.shape[1])
        for k in range(0, index.shape[1], BATCH):
            at = index[:, k : k + BATCH]
            mask = at != len(x) - 1
            s = np.concatenate([self._run(gf[at], p["uf"], mask, False, None), self._run(gb[at], p["ub"], mask, True, None)], 2)
            out[k : k + BATCH] = self._head(s, mask)[3]
        return out

    def gradient(self, word, rows, cuts, index, y, weight=None):
        """Gradient of the mean log loss of windows (weighed); table gradients as (rows, values)."""
        p, h = self.p, HIDDEN
        x = self.inputs(word, rows, cuts)
        mask = index != len(x) - 1
        keep = {"f": [], "b": []}
        xs = x[index]
        s = np.concatenate([self._run(xs @ p["w" + d] + p["b" + d], p["u" + d], mask, d == "b", keep[d]) for d in "fb"], 2)
        a, w, c, logit = self._head(s, mask)
        prob = _sigmoid(logit)
        g: dict = {}
        dl = ((prob - y) / len(y) * (1.0 if weight is None else weight)).astype(np.float32)
        g["wo"], g["bo"] = c.T @ dl, np.array([dl.sum()])
        dc = dl[:, None] * p["wo"]
        ds = w[:, :, None] * dc
        dw = (s * dc).sum(2)
        de = w * (dw - (w * dw).sum(0))
        g["va"] = np.einsum("tm,tmh->h", de, a)
        da = de[:, :, None] * p["va"] * (1 - a * a)
        g["wa"] = s.reshape(-1, 2 * h).T @ da.reshape(-1, h)
        ds += da @ p["wa"].T
        dxs = np.zeros_like(xs)
        for d, lo in (("f", 0), ("b", h)):
            u, w_in = p["u" + d], p["w" + d]
            dn = np.zeros((len(y), h), np.float32)
            gu, dgates = np.zeros_like(u), np.zeros((*index.shape, 3 * h), np.float32)
            for t, n, z, r, cand, gc in reversed(keep[d]):
                dn = dn + ds[t, :, lo : lo + h]
                on = mask[t][:, None].astype(np.float32)
                dz = -on * dn * (cand - n) * z * (1 - z)
                dcand = on * dn * (1 - z) * (1 - cand * cand)
                dr = dcand * gc * r * (1 - r)
                dg = np.concatenate([dz, dr, dcand * r], 1)
                gu += n.T @ dg
                dgates[t] = np.concatenate([dz, dr, dcand], 1)
                dn = dn * (1 - on * (1 - z)) + dg @ u.T
            g["u" + d], g["b" + d] = gu, dgates.sum((0, 1))
            g["w" + d] = xs.reshape(-1, DIM).T @ dgates.reshape(-1, 3 * h)
            dxs += dgates @ w_in.T
        dx = np.zeros_like(x)
        at, total = _gather(index.ravel(), dxs.reshape(-1, DIM))
        dx[at] = total
        dx = dx[:-1]
        n = np.diff(cuts)
        g["word"] = (word, dx)
        g["char"] = (rows, np.repeat(dx / np.sqrt(np.maximum(n, 1))[:, None], n, 0))
        return g


class _Adam:
    def __init__(self, p: dict[str, np.ndarray], known: dict[str, np.ndarray], rate: float, decay: float):
        self.p, self.known, self.rate, self.decay, self.t = p, known, rate, decay, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict) -> None:
        self.t += 1
        a, b = 1 - 0.9**self.t, 1 - 0.99**self.t
        for k, d in g.items():
            at = slice(None)
            if isinstance(d, tuple):  # only the table rows that occurred
                if not len(d[0]):
                    continue
                at, d = _gather(*d)
                live = self.known[k][at]
                at, d = at[live], d[live] + self.decay * self.p[k][at[live]]
            self.m[k][at] = 0.9 * self.m[k][at] + 0.1 * d
            self.v[k][at] = 0.99 * self.v[k][at] + 0.01 * d * d
            self.p[k][at] -= (self.rate * (self.m[k][at] / a) / (np.sqrt(self.v[k][at] / b) + 1e-6)).astype(np.float32)


def _index(which: np.ndarray, begin: np.ndarray, size: np.ndarray, pad: int) -> np.ndarray:
    """steps x windows: distinct word of each place, pad behind the end."""
    at = begin + np.arange(WINDOW)[:, None]
    out = which[np.minimum(at, max(0, len(which) - 1))] if len(which) else np.zeros(at.shape, np.int64)
    return np.where(np.arange(WINDOW)[:, None] < size, out, pad)


def _places(value: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The place of each value among those of its text, smallest first (doc is sorted)."""
    order = np.lexsort((value, doc))
    place = np.empty(len(doc), np.int64)
    place[order] = np.arange(len(doc)) - np.searchsorted(doc, doc[order])
    return place


Model = Network | float


def excess(toxic: np.ndarray, total: np.ndarray, n_toxic: int, n: int) -> np.ndarray:
    """Standard errors by which the log odds of occurring in toxic texts exceed those of
    the others, from numbers of texts (half a text added everywhere); at most 4 either way."""
    a, b = toxic + 0.5, total - toxic + 0.5
    odds = np.log(a / (n_toxic - toxic + 0.5)) - np.log(b / (n - n_toxic - total + toxic + 0.5))
    return np.clip(odds / np.sqrt(1 / a + 1 / b), -4, 4)


def fit_texts(texts: list[str], y: np.ndarray, *, epochs: int = 5, rate: float = 0.015, decay: float = 1e-5, seed: int = 3) -> Model:
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.0
    rng = np.random.default_rng(seed)
    trained = np.arange(len(y)) % 3 != 0
    if len(set(y[trained].tolist())) < 2:
        trained[:] = True
    # Texts with each form and, through its forms, with each n-gram: all of them, toxic ones
    codes, marks, chars, held = [], [], np.zeros((2, CHARS), np.int64), []
    for i, j, data, off in groups(pa.array(texts, pa.string()), 1 << 19):
        w = words_of(data, off, lower=True)
        code, rows, cuts, which = forms_of(w)
        pairs = np.unique((w.doc * (len(code) + 1) + which)[trained[i:j][w.doc]])
        doc, form = pairs // (len(code) + 1), pairs % (len(code) + 1)
        codes.append(code[form])
        marks.append(y[i:j][doc] > 0)
        n = np.diff(cuts)
        at = np.repeat(cuts[form] - (np.cumsum(n[form]) - n[form]), n[form]) + np.arange(n[form].sum())
        hits = np.unique(np.repeat(doc, n[form]) * CHARS + rows[at])
        chars[0] += np.bincount(hits % CHARS, minlength=CHARS)
        chars[1] += np.bincount(hits % CHARS, y[i:j][hits // CHARS] > 0, CHARS).astype(np.int64)
        held.append((i, j, w.first, code, rows, cuts, which))
    code, at, total = np.unique(np.concatenate(codes), return_inverse=True, return_counts=True)
    toxic = np.bincount(at, np.concatenate(marks), len(code))
    some = total >= MIN_DOCS
    net = Network.new(rng, code[some])
    n, n_toxic = int(trained.sum()), int((y[trained] > 0).sum())
    known = {"word": np.append(np.ones(int(some.sum()), bool), False), "char": chars[0] >= MIN_DOCS}
    start = excess(toxic[some], total[some], n_toxic, n)
    net.p["word"][:-1, 0] += start / WORD_START
    net.p["char"][:, 1] += excess(chars[1], chars[0], n_toxic, n) / CHAR_START
    net.p["char"] *= known["char"][:, None]
    start = np.append(start, 0.0)
    sets, many = [], np.zeros(2)
    for i, j, first, code, rows, cuts, which in held:
        doc, begin, size = windows_of(first)
        label, use = y[i:j][doc], trained[i:j][doc]
        word = net.rows(code)
        # The most telling form of each window
        index = _index(which, begin, size, len(word))
        look = np.append(start[word], -4.0)[index].max(0) + 1e-3 * rng.random(len(doc))
        place = _places(rng.random(len(doc)), doc)
        take = np.flatnonzero(use & ((label > 0) | (place < NEGATIVE)))
        sets.append(((word, rows, cuts, which), begin[take], size[take], label[take].astype(np.float32), doc[take], look[take]))
        per = np.bincount(doc[use & (label > 0)])
        many += [(label[take] == 0).sum(), np.maximum(1, np.round(SURE * per[per > 0])).sum()]
    weight = float(np.clip(many[0] / max(1.0, many[1]), 1.0, MOST_WEIGHT))
    adam = _Adam(net.p, known, rate, decay)
    for epoch in range(epochs):
        adam.rate = rate * (1 - epoch / epochs)
        for g in rng.permutation(len(sets)):
            (word, rows, cuts, which), begin, size, label, doc, look = sets[g]
            order = rng.permutation(len(label))
            if epoch:
                look = net.logits(net.inputs(word, rows, cuts), _index(which, begin, size, len(word)))
            sure = _places(-look, doc) < np.maximum(1, np.round(SURE * np.bincount(doc)))[doc]
            order = order[((label == 0) | sure)[order]]
            for k in range(0, len(order), 128):
                at = order[k : k + 128]
                index = _index(which, begin[at], size[at], -1)
                # Only the distinct words of these windows
                used, inverse = np.unique(index, return_inverse=True)
                inverse = inverse.reshape(index.shape)
                if used[0] == -1:
                    used, inverse = used[1:], np.where(index == -1, len(used) - 1, inverse - 1)
                n = cuts[used + 1] - cuts[used]
                sub = np.repeat(cuts[used] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                adam.step(net.gradient(word[used], rows[sub], np.concatenate(([0], np.cumsum(n))), inverse, label[at], np.where(label[at] > 0, weight, 1.0)))
    test = np.flatnonzero(~trained) if not trained.all() else np.arange(len(y))
    logit = score_texts(net, pa.array([texts[k] for k in test], pa.string()), raw=True)
    net.calibration = calibrate(logit, y[test])
    return net


def score_texts(net: Network, texts: pa.Array, *, raw: bool = False) -> np.ndarray:
    out = np.full(len(texts), -np.inf)
    for i, _, data, off in groups(texts, 2 << 20):
        w = words_of(data, off, lower=True)
        word, rows, cuts, which = forms_of(w)
        x = net.inputs(net.rows(word), rows, cuts)
        doc, begin, size = windows_of(w.first)
        for k in range(0, len(doc), BATCH):
            some = slice(k, k + BATCH)
            logit = net.logits(x, _index(which, begin[some], size[some], len(word)))
            np.maximum.at(out, doc[some] + i, logit)
    if raw:
        return out
    temperature, offset = net.calibration
    return 1 / (1 + np.exp(-np.clip(out / temperature + offset, -35, 35)))


def fit(docs: DataFrame, labels: DataFrame, *, where=None, sample: int = SAMPLE) -> Model:
    rows = base.labelled_sample(docs, labels, "toxic", sample, where=where)
    return fit_texts([t for _, t, _ in rows], np.array([float(y > 0) for _, _, y in rows]))


def score(docs: DataFrame, model: Model, *, text: str = "text", out: str = "score") -> DataFrame:
    """docs with the calibrated probability of toxicity in ``out``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        m = held.value
        if isinstance(m, float):
            return {out: pa.array(np.full(batch.num_rows, m))}
        return {out: pa.array(score_texts(m, base.column(batch, text).cast(pa.string())), pa.float64())}

    return base.map_arrow(docs, run, StructType([StructField(out, DoubleType())]))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, base.table(spark, sf_dir, "labels"), where=lambda i: base.crc_mod(i, 3) != 1)
    out = score(docs, model)
    return out.select("doc_id", (base.crc_mod("doc_id", 3) == 1).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))
