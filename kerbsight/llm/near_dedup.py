"""Near-duplicate groups by HyperMinHash, banding and exact verification.

1. Each text becomes its set of word shingles, and that a sketch of 256 16-bit
   registers.  Equal sets are one node from here on, so copies are never paired.
2. Bands of ``ROWS`` registers are compressed to keys.  Nodes that share a key are
   candidates: first each with the smallest node of the bucket (a star, not all pairs).
3. Candidates are estimated from their registers with the correction for chance
   collisions; what can still reach the threshold is verified on the full sets.
4. Verified links make components.  A bucket whose members are now all in one
   component is done.  In the others, members of different components are
   compared by their sketches in bounded blocks; what could be linked joins a
   cluster (spanning edges leave the block, not pairs).
5. A cluster's sets meet once, in blocks: every pair of different components is
   verified exactly, by intersection or by a product of incidence matrices, and spanning links
   leave the block.  So every pair that shares a bucket is connected or was checked.
6. Components again, over all links.

At a similarity of 0.8 two sets share none of the 51 keys with a probability of
2e-9; the estimate's margin is 0.25, nine standard errors (0.029 at most at this similarity,
measured on sets of 5 to 5,000 shingles: buckets draw from a small set almost independently).
Set sizes that rule the threshold out are dropped before either.

Nodes are 64-bit fingerprints of sets, shingles 64-bit fingerprints of words.

Edge cases: null and empty texts, and texts without words, have an empty set and
are linked with nothing; fewer words than a shingle make one shingle; repeated rows are equal
sets; a null doc_id takes part in links but never names a component (without any
other id the component is null); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import base
from .blocks import BLOCK, LINK, settle, verified
from .components import components
from .hyperminhash import BUCKETS, ROWS, bands, jaccard, matches, registers, shingle_sets
from .textbatch import groups, mix, words_of

PERCENT = 80
SHINGLE = 5
MARGIN = 0.25
_U = np.uint64


def _signature(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A fingerprint of each set, whatever its order; 0 for an empty set."""
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes ^ _U(0x5BD1E995)), out=total[1:])
    size = np.diff(first).astype(np.uint64)
    return np.where(size > 0, mix((total[first[1:]] - total[first[:-1]]) ^ (size << _U(40))) | _U(1), _U(0))


def _sets(batch: pa.RecordBatch, shingle: int):
    for i, j, data, off in groups(base.column(batch, "text").cast(pa.string())):
        yield i, j, *shingle_sets(words_of(data, off, lower=True), shingle)


def _sketch(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, codes, first in _sets(batch, shingle):
                reg = registers(codes, first)
                blob = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(np.arange(j - i + 1, dtype=np.int32) * 2 * BUCKETS), pa.py_buffer(np.ascontiguousarray(reg))])
                yield pa.RecordBatch.from_arrays(
                    [base.column(batch, c).slice(i, j - i) for c in ("doc_id", "k")] + [pa.array(np.diff(first)), pa.array(_signature(codes, first).view(np.int64)), blob],
                    names=["doc_id", "k", "n", "s", "reg"],
                )

    return run


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def _band_rows(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                keys = bands(_registers(base.column(part, "reg")), rows)
                s = np.repeat(np.asarray(base.column(part, "s")), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(s)], names=["key", "s"])

    return run


def _possible(reg_a, reg_b, n_a, n_b, percent: int) -> np.ndarray:
    """Pairs that can still reach the threshold: by size, then by the estimate."""
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    out = 100 * small >= percent * large
    at = np.flatnonzero(out)
    if len(at):
        j = jaccard(matches(reg_a[at], reg_b[at]), n_a[at], n_b[at])
        out[at] = j >= percent / 100 - MARGIN
    return out


def _estimate(percent: int):
    def test(t: pa.Table):
        reg, n = _registers(t["reg"].combine_chunks()), np.asarray(t["n"].combine_chunks())
        return lambda i, j: _possible(reg[i], reg[j], n[i], n[j], percent)

    return test


def _gate(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                n = [np.asarray(base.column(part, c)) for c in ("na", "nb")]
                ok = _possible(_registers(base.column(part, "ra")), _registers(base.column(part, "rb")), *n, percent)
                yield pa.RecordBatch.from_arrays([base.column(part, c).filter(pa.array(ok)) for c in ("a", "b")], names=["a", "b"])

    return run


def sketches(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, k, n, s, reg): id, row key, set size, set fingerprint, registers."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(key, text).alias("k"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_sketch(shingle), "doc_id bigint, k bigint, n bigint, s bigint, reg binary")


def _links(docs: DataFrame, sk: DataFrame, key: str, text: str, shingle: int, percent: int, rows: int, block: int) -> DataFrame:
    """(node, root) of the components of nodes that are linked."""
    sets = sk.where("n > 0")
    band = sets.select("s", "reg").mapInArrow(_band_rows(rows), "key bigint, s bigint")
    # Buckets of two nodes or more.  Stored, as every aggregate that a hot key is joined
    # with: adaptive execution splits a join only if both sides are plain exchanges.
    bucket = base.cut(band.groupBy("key").agg(F.min("s").alias("hub"), F.max("s").alias("top")).where("hub < top").select("key", "hub"))
    met = base.cut(band.join(bucket, "key").select("key", "s", "hub").distinct())
    nodes = met.select("s").distinct()
    # One row a node, with the registers and the row key of one of its texts: copies
    # are combined before the exchange
    one = base.cut(sets.groupBy("s").agg(F.min(F.struct("k", "n", "reg")).alias("x")).select("s", "x.*").join(nodes, "s", "left_semi"))
    texts = docs.select(F.xxhash64(key, text).alias("k"), F.col(text).cast("string").alias("text"))
    codes = texts.join(one.select("k", "s"), "k").select("s", "text").mapInArrow(_codes(shingle), "s bigint, codes binary")
    codes = base.cut(codes.groupBy("s").agg(F.min("codes").alias("codes")))

    pairs = met.where("s > hub").select(F.col("s").alias("a"), F.col("hub").alias("b")).distinct()
    a = one.select(F.col("s").alias("a"), F.col("n").alias("na"), F.col("reg").alias("ra"))
    b = one.select(F.col("s").alias("b"), F.col("n").alias("nb"), F.col("reg").alias("rb"))
    gated = pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_gate(percent), LINK)
    links = base.cut(verified(gated, codes, percent))
    comp = components(links)

    # Registers are all of one size, so blocks count rows only
    return settle(met, one, ["n", "reg"], lambda nodes: codes, links, comp, _estimate(percent), percent, block, F.lit(0).cast("long"))


def _codes(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, codes, first in _sets(batch, shingle):
                raw = codes.tobytes()
                yield pa.RecordBatch.from_arrays([base.column(batch, "s").slice(i, j - i), pa.array([raw[8 * a : 8 * b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())], pa.binary())], names=["s", "codes"])

    return run


def named(sk: DataFrame, comp: DataFrame) -> DataFrame:
    """(doc_id, k, n_shingles, component_id) of sets (doc_id, k, n, s) whose components are known."""
    node = sk.where("n > 0").groupBy("s").agg(F.min("doc_id").alias("least"))
    root = node.join(comp.withColumnRenamed("node", "s"), "s", "left").select("s", "least", F.coalesce("root", "s").alias("root"))
    best = base.cut(root.groupBy("root").agg(F.min("least").alias("component_id")))
    of_node = root.join(best, "root").select("s", "component_id")
    full = sk.select("doc_id", "k", "n", "s").join(of_node, "s", "left")
    return full.select("doc_id", "k", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def group(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """(doc_id, k, n_shingles, component_id) for each row: its key, the size of its set
    and the smallest id reachable over links."""
    sk = base.cut(sketches(docs, key=key, text=text, shingle=shingle))
    return named(sk, _links(docs, sk, key, text, shingle, percent, rows, block))


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group, that with the smallest id; same columns.  Of rows
    of equal id and text one stays: where they differ in other columns, that whose columns hash lowest."""
    grouped = group(docs, key=key, text=text, **options)
    lost = base.cut(grouped.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("k").distinct())
    k = base.free_name(docs, "row_key")
    left = docs.withColumn(k, F.xxhash64(key, text)).join(lost.withColumnRenamed("k", k), k, "left_anti")
    again = grouped.groupBy("k").agg(F.count("*").alias("c")).where("c > 1").select(F.col("k").alias(k))
    if again.isEmpty():
        return left.select(*docs.columns)
    rest = left.join(again, k, "left_anti")
    place = base.free_name(left, "place")
    first = F.row_number().over(Window.partitionBy(k).orderBy(F.xxhash64(*[c for c, t in docs.dtypes if "map<" not in t and t != "variant"]), *[c for c, t in docs.dtypes if t == "string"]))
    twice = left.join(again, k, "left_semi").withColumn(place, first).where(F.col(place) == 1)
    return rest.unionByName(twice.drop(place)).select(*docs.columns)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    grouped = group(docs, shingle=2)
    return grouped.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


OP3_SQL = r"""
with recursive d as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x != '') as w from documents),
s as (
  select distinct doc_id, case when len(w) < 2 then array_to_string(w, ' ') else w[i] || ' ' || w[i + 1] end as g
  from (select doc_id, w, unnest(range(1, greatest(len(w), 2))) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
both_ as (select x.doc_id as a, y.doc_id as b, count(*) as k from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by all),
link as (select a, b from both_ join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
e as (select a, b from link union all select b, a from link),
r(a, b) as (select doc_id, doc_id from d union select r.a, e.b from r join e on e.a = r.b),
c as (select a, min(b) as c from r group by a)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, c.c as component_id, d.doc_id = c.c as kept
from d left join n using (doc_id) join c on c.a = d.doc_id
"""
