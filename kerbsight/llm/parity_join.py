"""Word n-gram similarity join by parity sketches and the pigeonhole principle.

1. A text's set of word shingles becomes a sketch of bits: each shingle flips one.  What two sets share
   cancels out, so the Hamming distance of their sketches is at most their symmetric difference.
2. Sets of sizes a and b reach the similarity t only if the symmetric difference is at most
   (a + b) (1 - t) / (1 + t).  Sizes are split into bands; in the table of a band, at most d bits differ,
   and its sketches have d + 1 + e words of 64 bits: of two linked sets, e + 1 words at least are equal.  A set is in
   its own band's table, and in the next one's if a partner may be there.
3. Words are the join's keys.  A word with two bits or fewer says little, and unlike sets share it often: a set with e
   such words at most leaves them out.  If one of two linked sets does, then one of their equal words at least is
   none of these, and both have it; else both have all words.  Equal sets are one node, so copies are never paired.
   Nodes of a bucket meet its smallest node (a star, not all pairs): first each node one such hub, then, where the
   verified links have not joined them, its other hubs.
4. Pairs whose sketches differ in more bits than their sizes allow go, without loss; the
   others are verified on the full sets.
5. In buckets that hold more than one component, members of different components are compared in bounded
   blocks by their sketches, and what may be linked is verified exactly (``blocks.settle``).  So each pair
   that shares a word of its sketch is connected or was checked, and linked pairs share one: no link is lost.

A word takes in six to nine shingles of a set.  Two sets of hundreds of shingles that have nothing in common share one by
chance about once in ten million words; sets of 10 to 20 have two to four words, of which few say much, and share one about once in ten
thousand.  Chance pairs of a table grow with the square of its rows at these rates; they are told apart by sketches,
before full sets are read.

Nodes and shingles are 64-bit fingerprints of sets and of words.

Edge cases: null and empty texts, and texts without words, have an empty set and are linked with
nothing; fewer words than a shingle make one shingle; repeated rows are equal sets; a null doc_id takes part in
links but never names a component (without any other id the component is null); an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import base
from .blocks import BLOCK, LINK, settle, verified
from .components import components
from .near_dedup import _codes, _sets, _signature, named
from .textbatch import mix

PERCENT = 90
SHINGLE = 3
_U = np.uint64
#: Set sizes at which a band begins: each 1.25 times the one before.
EDGES = [1]
while EDGES[-1] < 1 << 34:
    EDGES.append(max(EDGES[-1] + 1, -(-EDGES[-1] * 5 // 4)))
_EDGES = np.array(EDGES, np.int64)
#: The lowest bits of a key name its table.
TABLE_BITS = 7
#: Words with so many bits or fewer are weak; a table has a spare word for so many others.
WEAK = 2
SPARE = 8


def most_apart(a, b, percent: int):
    """The largest symmetric difference of linked sets of two sizes."""
    return (a + b) * (100 - percent) // (100 + percent)


def words_of_table(percent: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit words of a sketch in each band's table (0 where only equal sets can be linked), and how
    many of them are spare."""
    top = _EDGES[1:] - 1
    d = most_apart(top, top, percent)
    spare = np.where(d > 0, -(-(d + 1) // SPARE), 0)
    return np.where(d > 0, d + 1 + spare, 0), spare


def _spare(percent: int) -> np.ndarray:
    return words_of_table(percent)[1]


def tables(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own table, words there, words in the next table) of sets of n shingles."""
    words = words_of_table(percent)[0]
    own = np.searchsorted(_EDGES, np.maximum(n, 1), "right") - 1
    up = (n > 0) & (100 * n // percent >= _EDGES[own + 1])
    return own, np.where(n > 0, words[own], 0), np.where(up, words[own + 1], 0)


def parity(codes: np.ndarray, first: np.ndarray, size: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
    """Adds the sketches of sets (sorted codes, one after the other) to out: size[d] words from at[d] on."""
    doc = np.repeat(np.arange(len(size)), np.diff(first))
    some = size[doc] > 0
    codes, doc = codes[some], doc[some]
    if not len(codes):
        return
    # The upper half picks the word, so the words of a set come in order
    cell = at[doc] + (((codes >> _U(32)) * size[doc].astype(np.uint64)) >> _U(32)).astype(np.int64)
    start = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    out[cell[start]] = np.bitwise_xor.reduceat(_U(1) << (codes & _U(63)), start)


def sketch(codes: np.ndarray, first: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of each set's sketches (own table, then the next one's), and their offsets."""
    _, own, up = tables(np.diff(first), percent)
    start = np.concatenate(([0], np.cumsum(own + up)))
    out = np.zeros(int(start[-1]), np.uint64)
    parity(codes, first, own, start[:-1], out)
    parity(codes, first, up, start[:-1] + own, out)
    return out, start


def _sketches(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, codes, first in _sets(batch, shingle):
                words, start = sketch(codes, first, percent)
                raw = words.tobytes()
                blobs = pa.array([raw[8 * a : 8 * b] for a, b in zip(start[:-1].tolist(), start[1:].tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [base.column(batch, c).slice(i, j - i) for c in ("doc_id", "k")] + [pa.array(np.diff(first)), pa.array(_signature(codes, first).view(np.int64)), blobs],
                    names=["doc_id", "k", "n", "s", "sk"],
                )

    return run


def keys_of(n: np.ndarray, words: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of sets of n shingles whose sketches' words lie one after the other, and the
    set that each belongs to.  Weak words are left out where that loses no link."""
    own, size, up = tables(n, percent)
    doc = np.repeat(np.arange(len(n)), size + up)
    place = np.arange(len(words)) - np.repeat(np.cumsum(size + up) - size - up, size + up)
    next_one = place >= size[doc]
    table = (own[doc] + next_one).astype(np.uint64)
    place = np.where(next_one, place - size[doc], place).astype(np.uint64)
    weak = np.bitwise_count(words) <= WEAK
    many = np.bincount(2 * doc + next_one, weak, 2 * len(n)).reshape(-1, 2) > np.stack([_spare(percent)[own], _spare(percent)[own + 1]], 1)
    used = ~weak | many[doc, next_one.astype(np.int64)]
    key = mix(words ^ mix((table << _U(40)) | place | _U(1 << 63)))
    return ((key << _U(TABLE_BITS)) | table)[used], doc[used]


def _band_rows(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in base.slices(batch, 1 << 19):
                n, s = (np.asarray(base.column(part, c)) for c in ("n", "s"))
                words = np.frombuffer(b"".join(base.column(part, "sk").to_pylist()), np.uint64)
                key, doc = keys_of(n, words, percent)
                for at in range(0, len(key), 1 << 16):
                    some = slice(at, at + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(key[some].view(np.int64)), pa.array(s[doc[some]])], names=["key", "s"])

    return run


def _in_table(blob: bytes, n: int, table: int, percent: int) -> np.ndarray | None:
    """The sketch that a set has in a table, if it has one there."""
    own, size, up = (int(x[0]) for x in tables(np.array([n]), percent))
    words = np.frombuffer(blob, np.uint64)
    return words[:size] if own == table else words[size : size + up] if own == table - 1 and up else None


def _gate(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            na, nb = (np.asarray(base.column(batch, c)) for c in ("na", "nb"))
            table = tables(np.maximum(na, nb), percent)[0].tolist()
            for i, (x, y) in enumerate(zip(base.column(batch, "ra"), base.column(batch, "rb"))):
                x, y = (_in_table(v.as_py(), int(n[i]), table[i], percent) for v, n in ((x, na), (y, nb)))
                ok[i] = x is not None and y is not None and np.bitwise_count(x ^ y).sum() <= most_apart(na[i], nb[i], percent)
            yield pa.RecordBatch.from_arrays([base.column(batch, c).filter(pa.array(ok)) for c in ("a", "b")], names=["a", "b"])

    return run


def _distance(percent: int):
    def test(t: pa.Table):
        """A bucket's rows all have a sketch in its table."""
        n, table = np.asarray(t["n"].combine_chunks()), t["g"][0].as_py() & ((1 << TABLE_BITS) - 1)
        m = np.stack([_in_table(b, k, table, percent) for b, k in zip(t["sk"].to_pylist(), n.tolist())])
        step = max(1, (1 << 19) // m.shape[1])

        def possible(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            far = np.concatenate([np.bitwise_count(m[i[k : k + step]] ^ m[j[k : k + step]]).sum(1, dtype=np.int64) for k in range(0, len(i), step)])
            return far <= most_apart(n[i], n[j], percent)

        return possible

    return test


def sketches(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, k, n, s, sk): id, row key, set size, set fingerprint, the words of its sketches."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(key, text).alias("k"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_sketches(shingle, percent), "doc_id bigint, k bigint, n bigint, s bigint, sk binary")


def _apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs whose nodes are in different components."""
    a, b = (comp.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("a", "b"))
    both = pairs.join(a, "a", "left").join(b, "b", "left")
    return both.where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")


def _codes_of(docs: DataFrame, one: DataFrame, twice: DataFrame, key: str, text: str, shingle: int, nodes: DataFrame) -> DataFrame:
    """(s, codes) of the nodes, out of one text each.  twice: row keys that several rows have; only their texts are combined."""
    texts = docs.select(F.xxhash64(key, text).alias("k"), F.col(text).cast("string").alias("text"))
    wanted = one.select("k", "s").join(nodes, "s", "left_semi")
    sets = lambda rows: rows.select("s", "text").mapInArrow(_codes(shingle), "s bigint, codes binary")
    if twice.isEmpty():
        return base.cut(sets(texts.join(wanted, "k")))
    copies = texts.join(twice, "k", "left_semi").groupBy("k").agg(F.min("text").alias("text"))
    single = wanted.join(twice, "k", "left_anti")
    return base.cut(sets(texts.join(single, "k").select("s", "text").unionByName(copies.join(wanted, "k").select("s", "text"))))


def links(docs: DataFrame, nodes: DataFrame, twice: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(node, root) of the nodes (s, k, n, sk) that are linked; k: the key of a row of docs with that set."""
    size = F.array(*[F.lit(int(x)) for x in words_of_table(percent)[0]])
    band = nodes.select("s", "n", "sk").mapInArrow(_band_rows(percent), "key bigint, s bigint")
    bucket = base.cut(band.groupBy("key").agg(F.min("s").alias("hub"), F.max("s").alias("top")).where("hub < top").select("key", "hub"))
    met = base.cut(band.join(bucket, "key").select("key", "s", "hub"))
    one = base.cut(nodes.join(met.select("s").distinct(), "s", "left_semi"))
    base.drop(bucket, nodes)

    # Pairs that the sketches let through; only their sets are read
    star = met.where("s > hub").select(F.col("s").alias("a"), F.col("hub").alias("b")).distinct()
    a = one.select(F.col("s").alias("a"), F.col("n").alias("na"), F.col("sk").alias("ra"))
    b = one.select(F.col("s").alias("b"), F.col("n").alias("nb"), F.col("sk").alias("rb"))
    star = base.cut(star.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_gate(percent), LINK))
    codes = _codes_of(docs, one, twice, key, text, shingle, star.select(F.col("a").alias("s")).union(star.select("b")).distinct())
    first = base.cut(star.groupBy("a").agg(F.min("b").alias("b")))
    found = base.cut(verified(first, codes, percent))
    comp = components(found)
    others = star.join(first.select("a", F.col("b").alias("tried")), "a").where("b != tried").select("a", "b")
    rest = base.cut(verified(_apart(others, comp), codes, percent))
    if not rest.isEmpty():
        found = base.cut(found.unionByName(rest))
        comp = components(found)
    base.drop(codes, star, first)
    weight = F.get(size, F.col("g").bitwiseAND(F.lit((1 << TABLE_BITS) - 1)).cast("int")).cast("long")
    wanted = lambda s: _codes_of(docs, one, twice, key, text, shingle, s)
    return settle(met, one, ["n", "sk"], wanted, found, comp, _distance(percent), percent, block, weight)


def group(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(doc_id, k, n_shingles, component_id) for each row: its key, the size of its set
    and the smallest id reachable over links."""
    full = base.cut(sketches(docs, key=key, text=text, shingle=shingle, percent=percent))
    # One row a node, with one of its texts' keys; copies are combined before the exchange
    nodes = base.cut(full.where("n > 0").groupBy("s").agg(F.min(F.struct("k", "n", "sk")).alias("x")).select("s", "x.*"))
    sk = base.cut(full.select("doc_id", "k", "n", "s"))
    base.drop(full)
    twice = base.cut(sk.groupBy("k").agg(F.count("*").alias("c")).where("c > 1").select("k"))
    return named(sk, links(docs, nodes, twice, key=key, text=text, shingle=shingle, percent=percent, block=block))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(base.table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


OP12_SQL = r"""
with recursive d as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x != '') as w from documents),
s as (
  select distinct doc_id, case when len(w) < 3 then array_to_string(w, ' ') else w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] end as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
both_ as (select x.doc_id as a, y.doc_id as b, count(*) as k from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by all),
link as (select a, b from both_ join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 90 * (x.n + y.n - k)),
e as (select a, b from link union all select b, a from link),
r(a, b) as (select doc_id, doc_id from d union select r.a, e.b from r join e on e.a = r.b),
c as (select a, min(b) as c from r group by a)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, c.c as component_id from d left join n using (doc_id) join c on c.a = d.doc_id
"""
