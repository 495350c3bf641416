"""Quality rules: line sequence labelling with a linear-chain CRF.

Each line of a text gets binned surface features (length, case, symbols,
digits, repeated words, repeated line, ending).  A two-state linear-chain
conditional random field over the lines, decoded by Viterbi, marks every line as
content or boilerplate; the share of a text's words in content lines decides
whether the text is kept.  Plain count rules come first.

The field is fitted on at most ``SAMPLE`` labelled documents.  Labels are of
documents, so those of their lines are found by multiple-instance rounds: a good
document is mostly content and a bad one mostly boilerplate (``MOST`` of its words), but
neither wholly.  A round labels each line by its marginal probability under the
field so far, turns as many of the likeliest lines as that share needs, and fits the field to it.  The
first field has no transitions.  Weights are drawn to ``PRIOR``, so that kinds of lines that the
sample lacks are still judged: repeated, near-empty, unfinished or symbol-ridden lines look like
boilerplate, long sentences like content.  Scoring covers every line of every text.
Without labels of both kinds only the prior judges.

Edge cases: a null or empty text has no words and fails the base rules; texts
are never cut, however long; repeated rows get the same result each; a share
exactly at the threshold keeps; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StructField, StructType

from . import base
from .textbatch import Words, _word_codes, grams, groups, mix, per_doc_sum, words_of

SAMPLE = 3000
MIN_SHARE = 0.5
MIN_WORDS = 50
#: Least share of a labelled document's words that its label holds for.
MOST = 0.7
ROUNDS = 2
#: Lines of so few words may be menu items.
ITEM = 5
#: Training sequences are cut into pieces of so many lines; those that are scored never are.
PIECE = 512

_CLASSES = {
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digit": bytes(range(48, 58)),
    "symbol": b"#*$%&|<>",
    "bang": b"!?",
    "bar": b"|",
}
_MASK = {}
for _k, _v in _CLASSES.items():
    _MASK[_k] = np.zeros(256, bool)
    _MASK[_k][list(_v)] = True

#: Upper edges of the bins of each numeric feature.
EDGES = {
    "words": [0.5, 3.5, 9.5, 29.5, 99.5],
    "upper": [0.02, 0.08, 0.25, 0.6],
    "symbol": [0.001, 0.1, 0.4, 0.8],
    "bang": [0.001, 0.1, 0.5],
    "bar": [0.001, 0.2],
    "digit": [0.001, 0.05, 0.3],
    "stutter": [0.001, 0.1, 0.4],
    "length": [3.0, 5.0, 8.0, 12.0],
    "repeat": [0.5],
    "stop": [0.5],
    "item": [0.5, 1.5],
}
#: What a bin says before anything is seen: log odds of content, by feature and bin.
PRIOR = {
    "words": [0.0, -1.0, -0.3, 0.5, 0.8, 0.8],
    "symbol": [0.0, -0.3, -1.0, -2.0, -2.0],
    "bar": [0.0, -0.5, -1.5],
    "stutter": [0.0, 0.0, -0.5, -1.5],
    "repeat": [0.0, -1.0],
    "stop": [-0.7, 0.5],
    "item": [0.0, 0.5, -3.0],
}
OFFSET = np.cumsum([0] + [len(e) + 1 for e in EDGES.values()])
N_FEATURES = int(OFFSET[-1])


def _count(mask: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(mask)
    return np.searchsorted(at, end) - np.searchsorted(at, start)


class Lines:
    """The lines of a group of documents, with base counts and features."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        w: Words = words_of(data, off)
        n = w.n_docs
        self.words, self.n_docs = w, n
        breaks = np.flatnonzero(data == 10)
        per = np.searchsorted(breaks, off[1:]) - np.searchsorted(breaks, off[:-1]) + 1
        self.first = np.concatenate(([0], np.cumsum(per)))
        start = np.empty(self.first[-1], np.int64)
        inner = np.ones(len(start), bool)
        inner[self.first[:-1]] = False
        start[self.first[:-1]] = off[:-1]
        start[inner] = breaks + 1
        end = np.empty_like(start)
        last = self.first[1:] - 1
        end[last] = off[1:]
        keep = np.ones(len(end), bool)
        keep[last] = False
        end[keep] = breaks
        self.start, self.end = start, end
        doc = np.repeat(np.arange(n), per)
        self.word_lo, self.word_hi = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
        self.n_words = self.word_hi - self.word_lo
        # A line equal to an earlier one of its document
        key = _word_codes(data, start, end) ^ mix(doc.astype(np.uint64) + np.uint64(1))
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(key), bool)
        again[order[1:]] = key[order[1:]] == key[order[:-1]]
        self.again = again & (self.n_words > 0)

    def base(self) -> dict[str, np.ndarray]:
        w, off, data = self.words, self.words.doc_start, self.words.data
        points = np.zeros(len(data) + 1, np.int32)
        np.cumsum(((data & 0xC0) != 0x80) & ~_SPACE[data], out=points[1:])
        g, at = grams(w, 3)
        doc = w.doc
        key = g ^ mix(doc[at].astype(np.uint64) + np.uint64(1))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(key), bool)
        twice[order[1:]] = same
        twice[order[:-1]] |= same
        cover = np.zeros(len(w.code), bool)
        for k in range(3):
            cover[at[twice] + k] = True
        return {
            "n_words": w.count,
            "word_chars": (points[off[1:]] - points[off[:-1]]).astype(np.int64),
            "n_symbols": _count(_MASK["symbol"][data], off[:-1], off[1:]),
            "n_dup_lines": per_doc_sum(self.again, self.first),
            "n_repeat_words": per_doc_sum(cover, w.first),
        }

    def features(self) -> np.ndarray:
        """One active feature index per line and feature: lines x len(EDGES)."""
        w, data = self.words, self.words.data
        n = {k: _count(m[data], self.start, self.end).astype(np.float64) for k, m in _MASK.items()}
        words = np.maximum(self.n_words, 1)
        size = np.zeros(len(w.code) + 1)
        np.cumsum(w.end - w.start, out=size[1:])
        same = np.zeros(len(w.code) + 1)
        if len(w.code):
            np.cumsum(np.concatenate(([False], w.code[1:] == w.code[:-1])), out=same[1:])
        tail = np.where(self.n_words > 0, self.word_hi - 1, 0)
        last = data[np.maximum(w.end[tail] - 1, 0)] if len(w.code) else np.zeros(len(words), np.uint8)
        stop = ((last == 46) | (last == 33) | (last == 63)) & (self.n_words > 0)
        value = {
            "words": self.n_words,
            "upper": n["upper"] / np.maximum(n["upper"] + n["lower"], 1),
            "symbol": n["symbol"] / words,
            "bang": n["bang"] / words,
            "bar": n["bar"] / words,
            "digit": n["digit"] / np.maximum(self.end - self.start, 1),
            "stutter": (same[self.word_hi] - same[np.minimum(self.word_lo + 1, self.word_hi)]) / words,
            "length": (size[self.word_hi] - size[self.word_lo]) / words,
            "repeat": self.again,
            "stop": stop,
            # A few words: a finished sentence, or rather a menu item or heading
            "item": ((self.n_words > 0) & (self.n_words <= ITEM)) * np.where(stop, 1, 2),
        }
        return np.stack([OFFSET[i] + np.searchsorted(np.asarray(e), np.asarray(value[k], np.float64), "right") for i, (k, e) in enumerate(EDGES.items())], 1)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Field:
    """A linear-chain CRF over two states (0 boilerplate, 1 content)."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move  # features x 2, 2 x 2

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.emit[features].sum(1)

    @staticmethod
    def _steps(first: np.ndarray):
        """Sequences by falling length, and how many have a line at each step."""
        n = np.diff(first)
        order = np.argsort(-n, kind="stable")
        alive = np.searchsorted(-n[order], -np.arange(int(n.max(initial=0))), "left")
        return first[:-1][order], alive

    def viterbi(self, scores: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The likeliest state of each line; sequences are first[d]:first[d + 1].
        Equal paths take the content state."""
        begin, alive = self._steps(first)
        state = np.zeros(len(scores), np.int8)
        back = np.zeros((len(scores), 2), np.int8)
        best = np.zeros((len(begin), 2))
        for t, m in enumerate(alive):
            row = begin[:m] + t
            if t:
                via = best[:m, :, None] + self.move  # from, to
                back[row] = via[:, 1] >= via[:, 0]
                best[:m] = via.max(1) + scores[row]
            else:
                best[:m] = scores[row]
        n = np.diff(first)
        now = (best[:, 1] >= best[:, 0]).astype(np.int8)
        for t in range(len(alive) - 1, -1, -1):
            m = alive[t]
            row = begin[:m] + t
            state[row] = now[:m]
            if t:
                now[:m] = back[row, now[:m]]
        return state

    def gradient(self, features, first, gold):
        """Log-likelihood gradient of the gold states, by forward-backward, and the
        marginal probabilities of the states."""
        scores = self.scores(features)
        begin, alive = self._steps(first)
        a = np.zeros_like(scores)
        b = np.zeros_like(scores)
        for t, m in enumerate(alive):
            row = begin[:m] + t
            a[row] = scores[row] + (_add_log(a[row - 1][:, :, None] + self.move, 1) if t else 0)
        for t in range(len(alive) - 2, -1, -1):
            row = begin[: alive[t + 1]] + t
            b[row] = _add_log((b[row + 1] + scores[row + 1])[:, None, :] + self.move, 2)
        z = _add_log(a + b, 1)
        p = np.exp(a + b - z[:, None])
        diff = -p
        diff[np.arange(len(gold)), gold] += 1
        flat = features.ravel()
        emit = np.stack([np.bincount(flat, np.repeat(diff[:, k], features.shape[1]), len(self.emit)) for k in (0, 1)], 1)
        inner = np.ones(len(gold), bool)
        inner[first[:-1]] = False
        row = np.flatnonzero(inner)
        pair = np.exp(a[row - 1][:, :, None] + self.move + (scores + b)[row][:, None, :] - z[row][:, None, None])
        move = np.bincount(2 * gold[row - 1] + gold[row], minlength=4).reshape(2, 2) - pair.sum(0)
        return emit, move, p

    @staticmethod
    def prior() -> np.ndarray:
        emit = np.zeros((N_FEATURES, 2))
        for at, k in zip(OFFSET, EDGES):
            odds = np.array(PRIOR.get(k, np.zeros(len(EDGES[k]) + 1)))
            emit[at : at + len(odds)] = np.stack([-odds / 2, odds / 2], 1)
        return emit

    def fit(self, features: np.ndarray, first: np.ndarray, gold: np.ndarray, *, chain: bool = True, steps: int = 30, rate: float = 0.3, decay: float = 1e-3) -> Field:
        """Adam on the mean log-likelihood with an L2 penalty towards the prior, from
        the weights so far; no randomness.  chain: whether transitions are fitted."""
        f, prior = Field(self.emit.copy(), self.move.copy()), [self.prior(), np.zeros((2, 2))]
        m = [np.zeros_like(f.emit), np.zeros_like(f.move)]
        v = [np.zeros_like(f.emit), np.zeros_like(f.move)]
        for t in range(1, steps + 1):
            for i, (w, g) in enumerate(zip((f.emit, f.move)[: 1 + chain], f.gradient(features, first, gold))):
                g = g / len(gold) - decay * (w - prior[i])
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.99 * v[i] + 0.01 * g * g
                w += rate * (1 - t / (steps + 1)) * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-8)
        return f


def _add_log(x: np.ndarray, axis: int) -> np.ndarray:
    """log(exp(a) + exp(b)) of the two entries along an axis."""
    a, b = np.take(x, 0, axis), np.take(x, 1, axis)
    top = np.maximum(a, b)
    return top + np.log1p(np.exp(np.minimum(a, b) - top))


def line_labels(p: np.ndarray, words: np.ndarray, first: np.ndarray, good: np.ndarray, most: float = MOST) -> np.ndarray:
    """The state of each line of labelled documents: the likelier one, but ``most`` of
    a document's words, where necessary in its likeliest lines, have the label's.

    p: probability of content of each line; first: documents' lines; good: their labels."""
    doc = np.repeat(np.arange(len(good)), np.diff(first))
    fit = np.where(good[doc], p, 1 - p)  # of the document's own label
    order = np.lexsort((-fit, doc))
    size = words[order].astype(np.int64)
    total = np.concatenate(([0], np.cumsum(size)))
    before = total[:-1] - total[first[:-1]][doc]
    own = np.empty(len(p), bool)
    own[order] = (fit[order] >= 0.5) | (before < most * (total[first[1:]] - total[first[:-1]])[doc])
    return np.where(own, good[doc], ~good[doc]).astype(int)


def fit_texts(texts: list[str], good: np.ndarray, *, rounds: int = ROUNDS) -> Field:
    """good: whether each text is labelled as good."""
    field = Field(Field.prior(), np.zeros((2, 2)))
    if good.all() or not good.any():
        return field
    feats, words, first = [], [], [np.zeros(1, np.int64)]
    for _, _, data, off in groups(pa.array(texts, pa.string()), 1 << 19):
        lines = Lines(data, off)
        feats.append(lines.features())
        words.append(lines.n_words)
        first.append(lines.first[1:] + first[-1][-1])
    feats, words, first = np.concatenate(feats), np.concatenate(words), np.concatenate(first)
    pieces = np.unique(np.concatenate([first, *[first[:-1][np.diff(first) > k] + k for k in range(PIECE, int(np.diff(first).max()), PIECE)]]))
    gold = np.repeat(good, np.diff(first)).astype(int)
    for k in range(rounds):
        field = field.fit(feats, pieces, gold, chain=k > 0)
        gold = line_labels(field.gradient(feats, pieces, gold)[2][:, 1], words, first, good)
    return field.fit(feats, pieces, gold, steps=50)


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Field:
    rows = base.labelled_sample(docs, labels, "quality", sample)
    return fit_texts([t for _, t, _ in rows], np.array([y > 0 for _, _, y in rows], bool))


VERDICT = StructType(
    [StructField(n, LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [StructField("base_failed", BooleanType()), StructField("content_share", DoubleType()), StructField("content", ArrayType(BooleanType())), StructField("kept", BooleanType())]
)


def verdicts(texts: pa.Array, field: Field, min_share: float = MIN_SHARE) -> pa.StructArray:
    """The VERDICT of each text."""
    parts: list[pa.Array] = [pa.array([], pa.struct([(f.name, to_arrow_type(f.dataType)) for f in VERDICT]))]
    for _, _, data, off in groups(texts):
        lines = Lines(data, off)
        c = lines.base()
        state = field.viterbi(field.scores(lines.features()), lines.first).astype(bool)
        share = per_doc_sum(lines.n_words * state, lines.first) / np.maximum(c["n_words"], 1)
        failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
        arrays = [pa.array(c[k], pa.int64()) for k in VERDICT.names[:5]]
        marks = pa.ListArray.from_arrays(pa.array(lines.first, pa.int32()), pa.array(state))
        arrays += [pa.array(failed), pa.array(share, pa.float64()), marks, pa.array(~failed & (share >= min_share))]
        parts.append(pa.StructArray.from_arrays(arrays, names=VERDICT.names))
    return parts[-1] if len(parts) == 2 else pa.concat_arrays([p.cast(parts[0].type) for p in parts])


def judge(docs: DataFrame, field: Field, *, text: str = "text", out: str = "rules", min_share: float = MIN_SHARE) -> DataFrame:
    """docs with a struct column ``out``: the base counts, the state of each line
    (``content``), the share of words in content lines, and ``kept``.  An input
    column named like ``out`` is replaced."""

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {out: verdicts(base.column(batch, text).cast(pa.string()), field, min_share)}

    return base.map_arrow(docs, run, StructType([StructField(out, VERDICT)]))


def keep(docs: DataFrame, labels: DataFrame, *, text: str = "text", min_share: float = MIN_SHARE) -> DataFrame:
    """The documents that pass, same columns; nothing else leaves Python."""
    field = fit(docs, labels)

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"kept": verdicts(base.column(batch, text).cast(pa.string()), field, min_share).field("kept")}

    return base.map_arrow(docs, run, StructType([StructField("kept", BooleanType())]), only="kept")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    field = fit(docs, base.table(spark, sf_dir, "labels"))
    out = judge(docs, field).select("doc_id", "rules.*")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share")
