"""Substring dedup: repeated word windows, by anchor groups and window fingerprints.

This replaces prefix-partitioned suffix trees: no tree is built and no suffixes are sorted.

A window of 35 words is repeated if its word sequence starts anywhere else, in the
same text or another.  Every word that a repeated window covers is removed; all
windows are judged on the input.

* Sparse suffixes.  Of the 8-word prefixes in a window the one with the smallest
  hash is the window's anchor.  Equal windows have equal anchors at equal places, so
  only the suffixes at anchors (about one in eleven) need to be grouped, and each
  brings along the windows it anchors.
* Prefix groups.  Anchors are counted by prefix; a prefix that occurs once is a leaf
  below the root and drops out.  What is left travels to its prefix's group.
* Variable-length prefixes.  A prefix with more than ``GROUP`` suffixes is dealt
  to several subgroups that fit in memory.  Windows that find no equal in their subgroup, and
  one of each that did, go on to a group of the longer prefix, the window itself.
* Subtrees.  Within a group the nodes at depth 35 that have two leaves or more are
  repeats; neighbouring ones of a text merge to maximal repeats.

Path labels are compared by fingerprints (64 bits for the prefix and 64 for
the window, so 128 together), not by the words, which would cost several times the
shuffle.

What is shuffled: about one row per eleven words to count and find anchors, the windows of
repeated anchors (8 bytes each), the texts once (both joins on the text's key
share that exchange) and the repeated ranges.

Edge cases: null and empty texts, and texts of fewer than 35 words, have no window
and lose nothing; repeated rows are texts of their own, so all of theirs of 35
words or more is removed; a null doc_id is an id like any other; an empty table gives an
empty result; input columns named like the result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from . import base
from .textbatch import Words, grams, groups, mix, rolling, words_of

WINDOW = 35
PREFIX = 8
GROUP = 1024
_U = np.uint64
_LAST = np.uint64(2**64 - 1)
_LOW = (1 << 32) - 1


def anchors(w: Words, window: int = WINDOW, prefix: int = PREFIX) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window start, place of its anchor) for all windows, as word indices, and
    the prefix fingerprint at each word."""
    n = len(w.code)
    h = np.full(n, _LAST, np.uint64)
    g, at = grams(w, prefix)
    h[at] = g
    left = np.repeat(w.first[1:], np.diff(w.first)) - np.arange(n)
    low, where, size, span = h, np.arange(n), 1, window - prefix + 1

    def join(k: int, m: int):
        """Of the minima at i and i + k the smaller, the left one if equal."""
        first = low[:m] <= low[k : k + m]
        return np.where(first, low[:m], low[k : k + m]), np.where(first, where[:m], where[k : k + m])

    while size < span:
        k = min(size, span - size)
        m = len(low) - k
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), h
        low, where = join(k, m)
        size += k
    start = np.flatnonzero(left >= window)
    return start, where[start], h


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


KEYED = StructType([StructField("g", LongType()), StructField("k1", LongType()), StructField("at", LongType())])


def _anchor_rows(window: int, prefix: int):
    """Each text's anchors: prefix, text key, and place packed with the key's rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1 = np.asarray(base.column(batch, "k1"))
            k2 = np.asarray(base.column(batch, "k2")).astype(np.int64)
            for i, _, data, off in groups(base.column(batch, "text").cast(pa.string())):
                w = words_of(data, off)
                _, where, h = anchors(w, window, prefix)
                at = np.unique(where)
                d = w.doc[at]
                yield pa.RecordBatch.from_arrays([_long(h[at]), pa.array(k1[i + d]), pa.array((k2[i + d] << 32) | (at - w.first[d]))], names=KEYED.names)

    return run


_LEAF_SCHEMA = pa.schema([("g", pa.int64()), ("deal", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int64()), ("windows", pa.binary())])


def _leaf_rows(window: int, prefix: int):
    """For each repeated anchor of a text: where its windows start and their fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = np.asarray(base.column(batch, "k1")), np.asarray(base.column(batch, "k2")).astype(np.int64)
            places, deals = base.column(batch, "places"), base.column(batch, "deals")
            for i, j, data, off in groups(base.column(batch, "text").cast(pa.string())):
                w = words_of(data, off)
                start, where, h = anchors(w, window, prefix)
                if not len(start):
                    continue
                label = np.zeros(len(w.code), np.uint64)
                full = rolling(w.code, window)
                label[: len(full)] = full
                first = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
                last = np.append(first[1:], len(where))
                anchor = where[first]
                part, dealt = places.slice(i, j - i), deals.slice(i, j - i)
                n = np.asarray(part.value_lengths()).astype(np.int64)
                wanted = np.asarray(part.flatten()).astype(np.int64) + np.repeat(w.first[:-1], n)
                order = np.argsort(wanted, kind="stable")
                wanted, many = wanted[order], np.asarray(dealt.flatten()).astype(np.int64)[order]
                found = np.searchsorted(anchor, wanted)
                ok = found < len(anchor)
                ok[ok] = anchor[found[ok]] == wanted[ok]
                found, many = found[ok], many[ok]
                a, b = first[found], last[found]
                d = w.doc[anchor[found]]
                size = b - a
                flat = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(size.sum())
                raw = label[start[flat]]
                cuts = np.concatenate(([0], np.cumsum(size) * 8)).astype(np.int32)
                blob = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(cuts), pa.py_buffer(raw)])
                # A prefix with many suffixes is dealt to subgroups by the text and the place in it,
                # whatever rows it came with: a task that runs again deals alike.
                spread = mix(k1[i + d].view(np.uint64) ^ mix((anchor[found] - w.first[d]).astype(np.uint64)))
                deal = np.where(many > 1, (spread % np.maximum(many, 1).astype(np.uint64)).astype(np.int64) + 1, 0)
                yield pa.RecordBatch.from_arrays([_long(h[anchor[found]]), pa.array(deal), pa.array(k1[i + d]), pa.array(k2[i + d]), pa.array(start[a] - w.first[d]), blob], schema=_LEAF_SCHEMA)

    return run


FOUND = StructType([StructField(n, LongType()) for n in ("k1", "k2", "low", "high", "g", "label", "single")])


def _subtree(rows: pa.Table) -> pa.RecordBatch | None:
    """Repeated window runs of whole groups; for dealt groups also what goes on."""
    g = np.asarray(rows["g"]).view(np.uint64)
    deal = np.asarray(rows["deal"])
    blob = rows["windows"].combine_chunks()
    cuts = np.frombuffer(blob.buffers()[1], np.int32, len(blob) + 1 + blob.offset)[blob.offset :]
    label = np.frombuffer(blob.buffers()[2], np.uint8)[cuts[0] : cuts[-1]].view(np.uint64)
    size = np.diff(cuts) // 8
    row = np.repeat(np.arange(len(g)), size)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    node = mix(label ^ mix(g ^ deal.astype(np.uint64))[row])
    order = np.argsort(node, kind="stable")
    s = node[order]
    new = np.concatenate(([True], s[1:] != s[:-1]))
    count = np.diff(np.append(np.flatnonzero(new), len(s)))
    leaves = np.empty(len(s), np.int64)
    leaves[order] = np.repeat(count, count)
    start = np.asarray(rows["start"])[row] + nth
    k1, k2 = np.asarray(rows["k1"]), np.asarray(rows["k2"])
    # Neighbouring repeated windows of one suffix make one run.
    on = np.flatnonzero(leaves > 1)
    parts = []
    if len(on):
        begin = np.concatenate(([True], (on[1:] != on[:-1] + 1) | (row[on[1:]] != row[on[:-1]])))
        a = on[begin]
        b = on[np.append(np.flatnonzero(begin)[1:] - 1, len(on) - 1)]
        r, zero = row[a], np.zeros(len(a), np.int64)
        parts.append([k1[r], k2[r], start[a], start[b], zero, zero, zero])
    more = order[new & (deal[row[order]] > 0)]
    if len(more):
        r = row[more]
        parts.append([k1[r], k2[r], start[more], start[more], g[r].view(np.int64), label[more].view(np.int64), np.where(leaves[more] > 1, 2, 1)])
    if not parts:
        return None
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], names=FOUND.names)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; the last group of a batch waits for the next."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        g, deal = np.asarray(base.column(batch, "g")), np.asarray(base.column(batch, "deal"))
        last = np.flatnonzero((g != g[-1]) | (deal != deal[-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if held and not cut:
            h = held[-1]
            same = base.column(h, "g")[-1].as_py() == g[-1] and base.column(h, "deal")[-1].as_py() == deal[-1]
            if same:
                held.append(batch)
                continue
        out = _subtree(pa.Table.from_batches([*held, batch.slice(0, cut)]))
        held = [batch.slice(cut)]
        if out is not None:
            yield out
    if held and (out := _subtree(pa.Table.from_batches(held))) is not None:
        yield out


def find(docs: DataFrame, *, window: int = WINDOW, prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """(k1, k2, ranges): of each text that has any, the ranges [low, high] of
    starts of repeated windows.  docs has text and a 96-bit key k1, k2 of id and text."""
    body = docs.select("k1", "k2", "text")
    rows = body.mapInArrow(_anchor_rows(window, prefix), KEYED)
    # Stored before the join: adaptive execution splits a hot prefix only if both
    # sides of the join are plain exchanges
    repeated = base.cut(rows.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g", F.when(F.col("n") > group, F.ceil(F.col("n") / group)).otherwise(0).alias("deal")))
    # Rows of equal key have equal places: one entry each, however many rows there are
    places = (
        rows.join(repeated, "g")
        .groupBy("k1", "at")
        .agg(F.max("deal").alias("deal"))
        .groupBy("k1", F.shiftright("at", 32).cast("int").alias("k2"))
        .agg(F.collect_list(F.struct(F.col("at").bitwiseAND(F.lit(_LOW)).cast("int").alias("p"), F.col("deal").cast("int").alias("d"))).alias("x"))
        .select("k1", "k2", F.col("x.p").alias("places"), F.col("x.d").alias("deals"))
    )
    leaves = docs.join(places, ["k1", "k2"]).mapInArrow(_leaf_rows(window, prefix), "g bigint, deal bigint, k1 bigint, k2 bigint, start bigint, windows binary")
    found = leaves.repartition("g", "deal").sortWithinPartitions("g", "deal").mapInArrow(_subtrees, FOUND)
    here = found.where("single = 0").select("k1", "k2", "low", "high")
    # The longer prefix: windows of dealt groups that occur in two subgroups
    lone = F.when(F.col("single") == 1, F.struct("k1", "k2", "low", "high"))
    beyond = found.where("single > 0").groupBy("g", "label").agg(F.count("*").alias("n"), F.collect_list(lone).alias("x")).where("n > 1").select(F.inline("x"))
    return here.unionByName(beyond).distinct().groupBy("k1", F.col("k2").cast("int").alias("k2")).agg(F.collect_list(F.struct("low", "high")).alias("ranges"))


RESULT = StructType([StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("text", StringType())])


def _cut(window: int, out: str):
    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        ranges = base.column(batch, "ranges")
        counts, removed, left = [], [], []
        for i, j, data, off in groups(base.column(batch, "text").cast(pa.string())):
            w = words_of(data, off)
            part = ranges.slice(i, j - i)
            n = np.asarray(part.value_lengths().fill_null(0)).astype(np.int64)
            pairs = part.flatten()
            base_word = np.repeat(w.first[:-1], n)
            edge = np.zeros(len(w.code) + 1, np.int64)
            np.add.at(edge, np.asarray(pairs.field("low")) + base_word, 1)
            np.add.at(edge, np.asarray(pairs.field("high")) + base_word + window, -1)
            gone = np.cumsum(edge)[:-1] > 0
            counts.append(w.count)
            total = np.concatenate(([0], np.cumsum(gone)))
            removed.append(total[w.first[1:]] - total[w.first[:-1]])
            raw = data.tobytes()
            for d in range(j - i):
                a, b = w.first[d], w.first[d + 1]
                text = raw[off[d] : off[d + 1]]
                if removed[-1][d]:
                    # From the first byte of a removed run to the next kept word
                    flip = np.flatnonzero(np.diff(np.concatenate(([False], gone[a:b], [False])).astype(np.int8)))
                    pieces, at = [], 0
                    for x, y in zip(flip[::2], flip[1::2]):
                        pieces.append(text[at : w.start[a + x] - off[d]])
                        at = (w.start[a + y] if a + y < b else off[d + 1]) - off[d]
                    text = b"".join([*pieces, text[at:]])
                left.append(text)
        texts = pa.array(left, pa.binary()).cast(pa.string(), safe=False)
        return {out: pa.StructArray.from_arrays([pa.array(np.concatenate(counts)), pa.array(np.concatenate(removed)), texts], names=RESULT.names)}

    return run


def remove(docs: DataFrame, *, key: str = "doc_id", text: str = "text", out: str = "deduped", window: int = WINDOW, prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """docs with a struct column ``out``: n_words, n_removed and the text that is
    left (null stays null only as input; what is left of it is empty)."""
    keep = [c for c in docs.columns if c.lower() != out.lower()]
    wide = docs.select(F.struct(*keep).alias("row"), F.col(text).cast("string").alias("text"), F.xxhash64(key, text).alias("k1"), F.hash(text).alias("k2"))
    found = find(wide, window=window, prefix=prefix, group=group)
    joined = wide.join(found, ["k1", "k2"], "left")
    done = base.map_arrow(joined, _cut(window, out), StructType([StructField(out, RESULT)]), keep=["row"])
    return done.select("row.*", out)


def clean(docs: DataFrame, **options) -> DataFrame:
    """docs with what is left of their texts (n_chars follows); a text that loses
    all its words goes, others stay; same columns."""
    out = base.free_name(docs, "deduped")
    done = remove(docs, out=out, **options)
    left = F.col(f"{out}.text")
    some = F.col(f"{out}.n_removed") > 0
    columns = [
        F.when(some, left).otherwise(F.col(c)).alias(c) if c == "text" else F.when(some, F.length(left)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
        for c in docs.columns
    ]
    return done.where(~some | (F.col(f"{out}.n_removed") < F.col(f"{out}.n_words"))).select(*columns)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    done = remove(docs).select("doc_id", "deduped.*")
    words = F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(words.cast("binary"), 256).alias("kept_sha256"))


OP7_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x != '') as w from documents),
s as (select r, doc_id, w, len(w) as n from d),
win as (select r, unnest(range(1, n - 33)) as a, w from s where n >= 35),
h as (select r, a, md5(array_to_string(w[a : a + 34], ' ')) as h from win),
rep as (select r, a from h where h in (select h from h group by h having count(*) > 1)),
gone as (select distinct r, p from (select r, unnest(range(a, a + 35)) as p from rep)),
kept as (
  select s.r, string_agg(t.x, ' ' order by t.p) as k from s, (select r as tr, unnest(w) as x, unnest(range(1, n + 1)) as p from s) t
  where t.tr = s.r and not exists (select 1 from gone g where g.r = t.tr and g.p = t.p) group by s.r)
select doc_id, cast(n as bigint) as n_words, cast((select count(*) from gone g where g.r = s.r) as bigint) as n_removed,
  sha256(coalesce(k, '')) as kept_sha256
from s left join kept using (r)
"""
