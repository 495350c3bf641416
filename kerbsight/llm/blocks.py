"""Pairs of a bucket or a cluster, compared in bounded blocks.

Similarity joins meet their candidates in groups (the nodes of a bucket, the components of a cluster).
Rows of a group are dealt to blocks so that every pair of different components meets in one;
a block hands on spanning links only, never its pairs.  Blocks get their rows in one order,
so a block that runs again after a lost executor hands on the same links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base
from .components import components

#: Rows and shingles of a block.
BLOCK = 512
BLOCK_SHINGLES = 1 << 20
LINK = "a bigint, b bigint"


def verify(percent: int):
    """Exact similarity of pairs that carry both sets as sorted 64-bit values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(base.column(batch, "sa"), base.column(batch, "sb"))):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([base.column(batch, c).filter(pa.array(ok)) for c in ("a", "b")], names=["a", "b"])

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a, b = sets.select(F.col("s").alias("a"), F.col("codes").alias("sa")), sets.select(F.col("s").alias("b"), F.col("codes").alias("sb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInArrow(verify(percent), LINK)


class Forest:
    """Union-find over the roots that occur in a block."""

    def __init__(self, roots: np.ndarray):
        self.up = {r: r for r in roots.tolist()}

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def links_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = np.array(found, np.int64).reshape(-1, 2).T
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])


def blocks(work, first: str, second: str):
    """Hands the rows of each (first, second) to work; rows come sorted by them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        mark = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = np.asarray(base.column(batch, first)), np.asarray(base.column(batch, second))
            cuts = [0, *(np.flatnonzero((x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1).tolist(), len(x)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if held and mark != (x[a], y[a]):
                    yield links_of(work(pa.Table.from_batches(held)))
                    held = []
                mark = (x[a], y[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield links_of(work(pa.Table.from_batches(held)))

    return run


def pairs(root: np.ndarray, side: np.ndarray, s: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different components that a block has to check for some of its
    rows: across its two sides, or all of them if it has one side."""
    across = side.any() and not side.all()
    order = (side[rows][:, None] < side[None, :]) if across else (s[rows][:, None] < s[None, :])
    i, j = np.nonzero((root[rows][:, None] != root[None, :]) & order)
    return rows[i], j


def compare(test: Callable[[pa.Table], Callable[[np.ndarray, np.ndarray], np.ndarray]]):
    """Spanning edges between rows of different components that can reach the
    threshold by their sketches: test makes, of a block, a function that says so for pairs of its rows."""

    def work(t: pa.Table) -> list[tuple[int, int]]:
        s, root, side = (np.asarray(t[c].combine_chunks()) for c in ("s", "root", "side"))
        possible = test(t)
        forest, found = Forest(root), []
        for k in range(0, len(s), 16):  # a bounded number of pairs at a time
            i, j = pairs(root, side, s, np.arange(k, min(k + 16, len(s))))
            if len(i):
                ok = possible(i, j)
                found += [(s[x], s[y]) for x, y in zip(i[ok].tolist(), j[ok].tolist()) if forest.join(int(root[x]), int(root[y]))]
        return found

    return work


def exact(percent: int):
    """Spanning links between rows of different components, verified on their sets."""

    def work(t: pa.Table) -> list[tuple[int, int]]:
        s, root, side = (np.asarray(t[c].combine_chunks()) for c in ("s", "root", "side"))
        sets = [np.frombuffer(x, np.uint64) for x in t["codes"].to_pylist()]
        n = np.array([len(x) for x in sets])
        forest, found = Forest(root), []
        i, j = pairs(root, side, s, np.arange(len(s)))
        fits = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
        i, j = i[fits], j[fits]
        if len(i) > 2000:
            both = intersections(sets)[i, j]
        else:
            both = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i.tolist(), j.tolist())], np.int64)
        ok = np.flatnonzero(100 * both >= percent * (n[i] + n[j] - both))
        for k in ok.tolist():
            if forest.join(int(root[i[k]]), int(root[j[k]])):
                found.append((s[i[k]], s[j[k]]))
        return found

    return work


def deal(rows: DataFrame, block: int) -> DataFrame:
    """rows (g, s, root, n) of the groups with two components or more, dealt to parts of
    at most about two blocks (by rows and by shingles) so that each pair of different components meets in one:
    blocks of the largest component against blocks of the others, and those among
    themselves.  A few strays beside a large component cost it no copies."""
    blocks = lambda c, n: F.ceil(F.greatest(F.col(c) / block, F.col(n) / BLOCK_SHINGLES))
    sides = rows.groupBy("g", "root").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
    major = sides.groupBy("g").agg(F.max(F.struct("c", "root", "n")).alias("m"), F.sum("c").alias("all"), F.sum("n").alias("size"), F.count("*").alias("roots")).where("roots > 1")
    major = major.select("g", F.col("m.root").alias("major"), F.col("m.c").alias("mc"), F.col("m.n").alias("mn"), (F.col("all") - F.col("m.c")).alias("oc"), (F.col("size") - F.col("m.n")).alias("on"))
    major = base.cut(major.select("g", "major", blocks("mc", "mn").alias("x"), blocks("oc", "on").alias("y")))
    both = rows.join(major, "g")
    h, x, y, zero = F.xxhash64("s", F.lit(3)), F.col("x"), F.col("y"), F.lit(0).cast("long")
    at = lambda part, side: F.struct(part.cast("long").alias("part"), side.alias("side"))
    mine, other = F.pmod(h, x), F.pmod(h, y)
    of_major = F.transform(F.sequence(zero, y - 1), lambda b: at(mine * y + b, F.lit(0)))
    of_minor = F.concat(
        F.transform(F.sequence(zero, x - 1), lambda a: at(a * y + other, F.lit(1))),
        F.transform(F.sequence(zero, y - 1), lambda b: at(x * y + F.least(other, b) * y + F.greatest(other, b), F.when(other <= b, 0).otherwise(1))),
    )
    return both.select("g", "s", "root", F.inline(F.when(F.col("root") == F.col("major"), of_major).otherwise(of_minor)))


def intersections(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections: the incidence matrix of the elements
    that two sets or more have, times itself, a slice of elements at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, which, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[which] > 1
    owner, which = owner[shared], (np.cumsum(count > 1) - 1)[which[shared]]
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for low in range(0, int(which[-1]) + 1 if len(which) else 0, columns):
        a, b = np.searchsorted(which, [low, low + columns])
        x = np.zeros((len(sets), columns), np.float32)
        x[owner[a:b], which[a:b] - low] = 1.0
        out += x @ x.T
    return out.astype(np.int64)


def met_in_blocks(rows: DataFrame, work) -> DataFrame:
    """What work links in each (g, part) of rows (g, part, s, ...), whose order it can rely on."""
    return rows.repartition("g", "part").sortWithinPartitions("g", "part", "s").mapInArrow(blocks(work, "g", "part"), LINK)


def settle(met: DataFrame, one: DataFrame, carried: list[str], codes_of: Callable[[DataFrame], DataFrame], links: DataFrame, comp: DataFrame, test, percent: int, block: int, weight) -> DataFrame:
    """Components once every pair of a bucket is connected or was checked.

    met: (key, s) of buckets; one: (s, n, ...) of nodes, with the carried columns that test needs; codes_of:
    (s, codes), the sets of the nodes of a table (s); links: those verified so far, comp: their components; weight: how much a row of the bucket
    ``g`` adds to a block, beside its one row."""
    rooted = met.select(F.col("key").alias("g"), "s").join(comp.withColumnRenamed("node", "s"), "s", "left").select("g", "s", F.coalesce("root", "s").alias("root")).withColumn("n", weight)
    full = deal(rooted, block).join(one.select("s", *carried), "s").select("g", "part", "s", "root", "side", *carried)
    near = base.cut(met_in_blocks(full, compare(test)).distinct())
    if near.isEmpty():
        return comp

    # Clusters of components that may be linked: each node's set travels once a block
    cluster = components(near.unionByName(comp.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    member = one.select("s", "n").join(comp.withColumnRenamed("node", "s"), "s", "left").join(cluster.select(F.col("node").alias("s"), F.col("root").alias("c")), "s", "left")
    member = member.select(F.coalesce("c", "s").alias("g"), "s", F.coalesce("root", "s").alias("root"), "n")
    dealt = base.cut(deal(member, block))
    whole = dealt.join(codes_of(dealt.select("s").distinct()), "s").select("g", "part", "s", "root", "side", "codes")
    more = base.cut(met_in_blocks(whole, exact(percent)))
    if more.isEmpty():
        return comp
    return components(links.unionByName(more))
