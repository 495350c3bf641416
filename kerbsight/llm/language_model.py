"""LM scoring: a bigram model in sharded Elias-Fano tries.

Every text is counted and every text is scored, in one pass over the documents
and two exchanges:

1. A block of documents (about ``BLOCK`` bytes) numbers its distinct words and
   bigrams.  For each shard it sends one row: its words there, how
   often each occurs in training texts, its contexts there, and their successors (40 bits
   each) with their counts.  The block's token numbers travel with one of the rows.
2. A shard adds up the training counts of all blocks, builds its trie (Elias-Fano
   levels, 8-bit codes) and answers each block from it: the exact count of every
   word, its quantised share, and the quantised count of every bigram, by
   successor search between the context's pointers.
3. A block reads the answers of all shards and sums its texts' tokens.

The model smooths with a Dirichlet prior, drawn to the add-one unigram:
p(w | v) = (c(v, w) + m * p1(w)) / (c(v) + m), which is p1(w) behind a context that
training never saw; p1(w) = (c(w) + 1) / (N + V + 1).
Contexts are the word before, or the text's start; every text ends in an end token, so a
context is followed by something exactly c(v) times.  The two factors are stored
apart, c(v, w) with the bigram and 1 / (c(v) + m) with the word, each in 8 bits.  So nothing
but the blocks needs all successors of a context, and they are dealt over a sixteenth of the
shards: a context that makes up a tenth of all bigrams adds to a shard less than twice its usual load.

Nothing is broadcast or collected.  What is exchanged grows with the distinct
words and bigrams of the blocks; a hot word, or bigram, is one entry a block.  There is a shard for
every ``SHARD`` bytes of text, so shards keep their size as the input grows; blocks times
shards rows are sent, as a shuffle has blocks for each pair of its tasks.

Edge cases: a null or empty text is its end token alone; without training texts N and
V are 0 and every token has probability 1 under the base, and p1 under the
model; repeated rows count as often as they occur and score alike; a null training
flag is no training row; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import base
from .elias_fano import CHILD_BITS, Trie
from .textbatch import groups, mix, words_of

BLOCK = 12 << 20
#: Bytes of text for each shard.
SHARD = 16 << 20
#: Weight of the unigram, in tokens: of 2, 5, 20, 100 and 500 the one that gives held-out texts of sf0.1 the most probability.
PRIOR = 100.0
#: The end of a text, and the context of its first word.
END = np.uint64(1)
_U = np.uint64
_CHILD = _U((1 << CHILD_BITS) - 1)


def _shard(codes: np.ndarray, shards: int) -> np.ndarray:
    """The shard that counts a word."""
    return (mix(codes) % _U(shards)).astype(np.int64)


def _dealt(home: np.ndarray, head: np.ndarray, tail: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard of each bigram, from its words' homes, and the order by shard:
    the successors of a context lie in the shards from its home on."""
    shard = (home[head] + home[tail] % -(-shards // 16)) % shards
    order = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")
    return shard[order], order


def _join(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, each behind its length; wide integers by byte planes, so
    that planes of zeros compress away in the exchange."""
    out = []
    for a in arrays:
        raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b""
        out.append(struct.pack("<q", len(a)) + raw)
    return b"".join(out)


def _split(data: bytes, kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds.split():
        n = struct.unpack_from("<q", data, at)[0]
        size = np.dtype(kind).itemsize
        raw = np.frombuffer(data, np.uint8, n * size, at + 8)
        out.append(np.ascontiguousarray(raw.reshape(size, n).T).view(kind).reshape(n))
        at += 8 + n * size
    return out


def _low40(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])


def _from40(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x) // 5, 8), np.uint8)
    out[:, :5] = x.reshape(-1, 5)
    return out.view("<u8").reshape(-1)


def _tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word fingerprints with an end token behind each text, and first indices."""
    w = words_of(data, off, lower=True)
    first = w.first + np.arange(w.n_docs + 1)
    out = np.full(first[-1], END, np.uint64)
    keep = np.ones(len(out), bool)
    keep[first[1:] - 1] = False
    out[keep] = np.where(w.code == END, _U(2), w.code)
    return out, first


def _contexts(token: np.ndarray, first: np.ndarray, end) -> np.ndarray:
    out = np.empty_like(token)
    out[1:] = token[:-1]
    out[first[:-1]] = end
    return out


_REQUEST = "shard int, block bigint, request binary, state binary"
_NAMES = ["shard", "block", "request", "state"]


def _ask(keys: list[str], shards: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            train = base.column(batch, "train").fill_null(False)
            for i, j, data, off in groups(base.column(batch, "text").cast(pa.string()), block):
                token, first = _tokens(data, off)
                per = np.repeat(np.asarray(train.slice(i, j - i), bool), np.diff(first))
                code, where = np.unique(token, return_inverse=True)
                # Number the words by (home, fingerprint)
                home = _shard(code, shards)
                order = np.argsort(home, kind="stable")
                rank = np.empty_like(order)
                rank[order] = np.arange(len(order))
                code, home, where = code[order], home[order], rank[where]
                count = np.bincount(where[per], minlength=len(code)).astype(np.uint32)
                pair = _contexts(where, first, where[first[1] - 1]) * len(code) + where
                pairs, at = np.unique(pair, return_inverse=True)
                times = np.bincount(at[per], minlength=len(pairs)).astype(np.uint32)
                head, tail = pairs // len(code), pairs % len(code)
                shard, order = _dealt(home, head, tail, shards)
                head, times, child = head[order], times[order], _low40(code[tail[order]])
                # Runs of one context in one shard
                run = np.flatnonzero(np.diff(shard, prepend=-1) | np.diff(head, prepend=-1))
                kinds = np.diff(run, append=len(head)).astype(np.uint32)
                context = code[head[run]]
                every = np.arange(shards + 1)
                word_cut, pair_cut, run_cut = (np.searchsorted(x, every) for x in (home, shard, shard[run]))
                rows = pa.RecordBatch.from_arrays([base.column(batch, k).slice(i, j - i) for k in keys], names=keys)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_batch(rows)
                state = _join(np.frombuffer(sink.getvalue(), np.uint8), first) + pa.compress(where.astype(np.int32).view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)
                asks = []
                for s in range(shards):
                    w, r, q = (slice(cut[s], cut[s + 1]) for cut in (word_cut, run_cut, pair_cut))
                    asks.append(_join(code[w], count[w], context[r], kinds[r], child[q].reshape(-1), times[q]))
                owner = number % shards
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(shards, dtype=np.int32)), pa.array(np.full(shards, number)), pa.array(asks, pa.binary()), pa.array([state if s == owner else None for s in range(shards)], pa.binary())],
                    names=_NAMES,
                )
                number += 1

    return run


_ANSWER = "block bigint, shard int, words bigint, tokens bigint, answer binary, state binary"


_PARTS = "u8 u4 u8 u4 u1 u4"


def build_shard(requests: list[bytes], prior: float) -> tuple[Trie, int, int]:
    """The trie over the training counts of all requests; distinct words and tokens."""
    codes, counts, contexts, kinds, children, times = (np.concatenate(x) for x in zip(*(_split(r, _PARTS) for r in requests)))
    word, where = np.unique(codes, return_inverse=True)
    count = np.bincount(where, counts, len(word)).astype(np.int64)
    word, count = word[count > 0], count[count > 0]
    context, where = np.unique(contexts, return_inverse=True)
    seen = times > 0
    head = np.repeat(where, kinds)[seen]
    key = np.union1d(word, context[np.unique(head)])
    if len(key) >> 64 - CHILD_BITS:
        raise ValueError("too many words in a shard of the language model: use more shards")
    child = np.searchsorted(key, context)[head].astype(np.uint64) << _U(CHILD_BITS) | _from40(children)[seen]
    child, at = np.unique(child, return_inverse=True)
    n = np.bincount(at, times[seen], len(child))
    total = np.zeros(len(key), np.int64)
    total[np.searchsorted(key, word)] = count
    return Trie.build(key, total, child, n, prior), len(word), int(count.sum())


def answer(trie: Trie, request: bytes) -> bytes:
    """Counts and share codes of the words, and codes of the bigrams, in the request's order."""
    code, _, context, kinds, child, _ = _split(request, _PARTS)
    rank, hit = trie.context(code)
    count, share = np.zeros(len(code), np.int64), np.zeros(len(code), np.uint8)
    count[hit], share[hit] = trie.count[rank[hit]], trie.share[rank[hit]]
    rank, hit = trie.context(context)
    some = np.repeat(hit, kinds)
    times = np.zeros(len(some), np.uint8)
    times[some] = trie.successors(rank[hit], kinds[hit], _from40(child)[some])
    return _join(count, share, times) + trie.books.astype("<f4").tobytes()


def _serve(prior: float):
    def run(group: pa.Table) -> pa.Table:
        requests = group["request"].to_pylist()
        trie, words, tokens = build_shard(requests, prior)
        trie = Trie.over(trie.to_bytes())
        n = len(requests)
        base.trim()
        return pa.table(
            {
                "block": group["block"],
                "shard": group["shard"],
                "words": pa.array(np.full(n, words)),
                "tokens": pa.array(np.full(n, tokens)),
                "answer": pa.array([answer(trie, r) for r in requests], pa.binary()),
                "state": group["state"],
            }
        )

    return run


def _sum(keys: list[str], shards: int, prior: float):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("shard")
        n, v = sum(group["tokens"].to_pylist()), sum(group["words"].to_pylist())
        count, share, times = [], [], []
        for data in group["answer"].to_pylist():
            c, b, t = _split(data, "i8 u1 u1")
            books = 10.0 ** np.frombuffer(data, "<f4", 512, len(data) - 2048).reshape(2, 256).astype(np.float64)
            books[:, 0] = 0.0  # code 0 is none
            count.append(c)
            share.append(books[0][b])
            times.append(books[1][t])
        home = np.repeat(group["shard"].to_numpy(), [len(c) for c in count])
        count, share, dealt = np.concatenate(count), np.concatenate(share), np.concatenate(times)
        state = next(x for x in group["state"].to_pylist() if x is not None)
        blob, first = _split(state, "u1 i8")
        rows = pa.ipc.open_stream(pa.py_buffer(blob.tobytes())).read_all()
        total = int(first[-1])
        packed = state[16 + len(blob) + 8 * len(first) :]
        where = np.frombuffer(pa.decompress(packed, decompressed_size=4 * total, codec="zstd"), np.uint8)
        where = np.ascontiguousarray(where.reshape(4, total).T).view(np.int32).reshape(-1).astype(np.int64)
        head = _contexts(where, first, where[first[1] - 1])
        pairs, at = np.unique(head * len(count) + where, return_inverse=True)
        _, order = _dealt(home, pairs // len(count), pairs % len(count), shards)
        times = np.empty(len(pairs))
        times[order] = dealt
        one = (count[where] + 1.0) / (n + v + 1.0)
        # Quantising may pass 1
        p = np.where(share[head] > 0, np.minimum(1.0, (times[at] + prior * one) * share[head]), one)
        base.trim()
        sums = lambda x: np.add.reduceat(x, first[:-1])
        out = {
            "n_tokens": np.diff(first),
            "n_known": sums((count[where] > 0).astype(np.int64)),
            "train_tokens": np.full(len(first) - 1, n, np.int64),
            "base_score": sums(np.log10(one)),
            "score": sums(np.log10(p)),
        }
        return pa.table({**{k: rows[k] for k in keys}, **{k: pa.array(x) for k, x in out.items()}})

    return run


RESULTS = ("n_tokens bigint", "n_known bigint", "train_tokens bigint", "base_score double", "score double")


def score(docs: DataFrame, *, text: str = "text", train: str = "train", keys: tuple[str, ...] = ("doc_id",), prior: float = PRIOR, shards: int | None = None, block: int = BLOCK) -> DataFrame:
    """keys, n_tokens, n_known, train_tokens, base_score and score of every row;
    the boolean column ``train`` says which rows the model learns from.  A key named
    like a result gives way to it.  Unless ``shards`` is given, the texts' bytes are added up first."""
    names = [f"key{i}" for i in range(len(keys))]
    rows = docs.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(text).cast("string").alias("text"), F.col(train).alias("train"))
    if not shards:
        shards = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SHARD))
    asked = rows.mapInArrow(_ask(names, shards, block), _REQUEST)
    served = asked.repartitionById(shards, "shard").groupBy("shard").applyInArrow(_serve(prior), _ANSWER)
    kinds = ", ".join(f"{n} {docs.schema[k].dataType.simpleString()}" for k, n in zip(keys, names))
    done = served.groupBy("block").applyInArrow(_sum(names, shards, prior), f"{kinds}, {', '.join(RESULTS)}")
    results = [r.split()[0] for r in RESULTS]
    return done.select(*[F.col(n).alias(k) for k, n in zip(keys, names) if k not in results], *results)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = base.crc_mod("doc_id", 7) == 2
    out = score(docs.withColumn("held_out", held_out).withColumn("train", ~held_out), keys=("doc_id", "held_out"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
