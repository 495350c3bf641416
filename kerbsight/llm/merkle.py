"""A Merkle manifest of a table: a digest and an authentication path for each row.

Leaves ascend within a group (a source); runs of three become their parent's digest until one node
is left.  The groups' roots, in the order of the groups, make one more tree of the same kind.

1. A row's leaf is a digest of its fields, by native functions; texts are read once and go no further.
2. Leaves are sorted by range, so a group of a third of all rows spreads over many tasks; a row's
   place in its group comes from counts of each (partition, group), not from a window over the group.
3. Aligned blocks of 3 ** ``HEIGHT`` leaves are hashed to their roots, these in blocks again, until a
   group has one node: as many rounds as the tree has heights / ``HEIGHT``, each on a table
   that is 3 ** ``HEIGHT`` times smaller.
4. Paths come from the top down.  The task of a block gets its leaves and, as a row of its own, the
   path above the block.  It goes through the leaves by fractal traversal: the block's tree is cut
   into stacked subtrees of ``SUBTREE`` heights.  For each of them it keeps the existing subtree, which holds the siblings on the
   present path, and a desired one, the next at that height, which takes in one leaf a step and is
   complete when the existing one is used up.

A task holds one block's digests and those subtrees, whatever the table's size.

Edge cases: null fields count as ``-``, so they differ from empty ones; a null group comes first, a null doc_id first in its
group; rows of equal id are ordered by leaf, equal rows have equal leaves at neighbouring places; a
table of one row has its leaf as the root and an empty path; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import base

ARITY = 3
HEIGHT = 6
SUBTREE = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def combine(nodes: list[bytes]) -> bytes:
    """The digest of a run of nodes, taken over their digests as hex text."""
    return sha256("".join([x.hex() for x in nodes]).encode()).digest()


class _Treehash:
    """Takes leaves one by one and keeps the nodes of some heights; else a run at most for each height."""

    def __init__(self, low: int, high: int, top: int, arity: int):
        self.low, self.high, self.top, self.arity = low, high, top, arity
        self.rows: list[list[bytes]] = [[] for _ in range(low, high)]
        self.tail: list[list[bytes]] = [[] for _ in range(top + 1)]

    def take(self, node: bytes, height: int = 0) -> None:
        while True:
            if self.low <= height < self.high:
                self.rows[height - self.low].append(node)
            run = self.tail[height]
            run.append(node)
            if height == self.top or len(run) < self.arity:
                return
            self.tail[height] = []
            node, height = combine(run), height + 1

    def close(self) -> "_Treehash":
        """Makes runs of what is left where the leaves have ended."""
        for height in range(self.top):
            if self.tail[height]:
                run, self.tail[height] = self.tail[height], []
                self.take(combine(run), height + 1)
        return self


def block_root(leaves, height: int, arity: int = ARITY) -> bytes:
    """The node that so many levels above the leaves make."""
    tree = _Treehash(0, 0, height, arity)
    for leaf in leaves:
        tree.take(leaf)
    return tree.close().tail[height][0]


def traverse(leaves, height: int, subtree: int = SUBTREE, arity: int = ARITY) -> Iterator[bytes]:
    """The path of each leaf through ``height`` levels, in order: for each level a byte with the
    place in the run, a byte with the number of siblings, and those from left to right."""
    n = len(leaves)
    cuts = [*range(0, height, subtree), height]
    stack = list(zip(cuts[:-1], cuts[1:]))  # heights low to high - 1 of each subtree level
    span = [arity**high for _, high in stack]

    def begun(i: int) -> _Treehash:
        return _Treehash(*stack[i], stack[i][1], arity)

    existing = []
    for i in range(len(stack)):
        tree = begun(i)
        for leaf in range(min(span[i], n)):
            tree.take(leaves[leaf])
        existing.append(tree.close())
    desired = [begun(i) for i in range(len(stack) - 1)]
    for t in range(n):
        path = []
        for (low, high), width, tree in zip(stack, span, existing):
            at = t % width // arity**low
            for row in tree.rows:
                own = at % arity
                run = row[at - own : at - own + arity]
                path += [bytes((own, len(run) - 1)), *run[:own], *run[own + 1 :]]
                at //= arity
        yield b"".join(path)
        for i, tree in enumerate(desired):
            ahead = (t // span[i] + 1) * span[i] + t % span[i]
            if ahead < n:
                tree.take(leaves[ahead])
            if (t + 1) % span[i] == 0:
                existing[i], desired[i] = tree.close(), begun(i)


def steps(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """(place in the run, siblings) of a path, level by level."""
    at = 0
    while at < len(path):
        own, count = path[at], path[at + 1]
        yield own, [path[at + 2 + 32 * k : at + 34 + 32 * k] for k in range(count)]
        at += 2 + 32 * count


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for own, siblings in steps(path):
        leaf = combine([*siblings[:own], leaf, *siblings[own:]])
    return leaf


def field(c: Column) -> Column:
    """A value with its length before it, so that no two rows have the same text; ``-`` if null."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*columns: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


def _partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows (g, ...) with pos, the place within g in the order given, and total, the rows of g.  seq must
    tell rows apart that are equal in all that is ordered by, so that a range of ties can be split."""
    by = ["g", *order, "seq"]
    ranked = base.cut(rows.repartitionByRange(_partitions(rows), *by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()))
    pid = F.shiftright("at", 33)
    counts = ranked.groupBy(pid.alias("pid"), "g").agg(F.min("at").alias("first"), F.count("*").alias("c"))
    # A group has a row for each partition here, not for each of its rows
    sums = "sum(c) over (partition by g order by pid) - c - first as shift", "sum(c) over (partition by g) as total"
    starts = base.cut(counts.selectExpr("pid", "g", *sums))
    both = ranked.withColumn("pid", pid).join(starts, ["pid", "g"])
    return both.withColumn("pos", F.col("at") + F.col("shift")).drop("pid", "at", "shift", "seq")


def _levels(total: Column, most: int) -> Column:
    """Levels above total nodes until one is left, at most ``most``."""
    out = F.lit(most)
    for k in range(most - 1, -1, -1):
        out = F.when(total <= ARITY**k, k).otherwise(out)
    return out


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (g, blk), which come sorted."""
    held: list[pa.RecordBatch] = []
    mark = None
    for batch in batches:
        if not batch.num_rows:
            continue
        g, b = base.column(batch, "g").dictionary_encode(), np.asarray(base.column(batch, "blk"))
        k = np.asarray(g.indices)
        cuts = [0, *(np.flatnonzero((b[1:] != b[:-1]) | (k[1:] != k[:-1])) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts[:-1], cuts[1:]):
            here = (g.dictionary[int(k[i])].as_py(), b[i])
            if held and here != mark:
                yield pa.Table.from_batches(held)
                held = []
            mark = here
            held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in _by_block(batches):
        root = block_root(t["digest"].to_pylist(), t["levels"][0].as_py())
        yield pa.RecordBatch.from_arrays([t["g"].combine_chunks()[:1], t["blk"].combine_chunks()[:1], pa.array([root], pa.binary())], names=["g", "pos", "digest"])


def _blocked(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("blk", F.floor(F.col("pos") / ARITY**height)).withColumn("levels", _levels(F.col("total"), height))


def tree(nodes: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """The tables of nodes (g, pos, digest, total) from the given leaves up to the roots, each one
    ``height`` levels above the one before."""
    out = [nodes]
    most = nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        rows = _blocked(out[-1].select("g", "pos", "digest", "total"), height)
        roots = rows.repartition("g", "blk").sortWithinPartitions("g", "blk", "pos").mapInArrow(_roots, "g string, pos bigint, digest binary")
        size = rows.select("g", "blk", F.ceil(F.col("total") / ARITY**height).alias("total")).groupBy("g", F.col("blk").alias("pos")).agg(F.max("total").alias("total"))
        out.append(base.cut(roots.join(size, ["g", "pos"])))
        most = -(-most // ARITY**height)
    return out


def _walk(carried: list[str], subtree: int):
    """Leaves of each block with their paths: the first row of a block has the path above it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_block(batches):
            t = t.combine_chunks()
            above, leaves = t.slice(0, 1), t.slice(1)
            upper = above["path"][0].as_py()
            paths = [p + upper for p in traverse(leaves["digest"].to_pylist(), leaves["levels"][0].as_py(), subtree)]
            whole = [pa.repeat(above[c][0], len(paths)) for c in ("subroot", "root")]
            yield pa.RecordBatch.from_arrays([leaves[c].combine_chunks() for c in carried] + [pa.array(paths, pa.binary()), *whole], names=[*carried, "path", "subroot", "root"])

    return run


def _descend(nodes: DataFrame, above: DataFrame, carried: list[str], height: int, subtree: int) -> DataFrame:
    """nodes' carried columns with path, subroot and root; above: (g, pos, path, subroot, root) of
    the blocks' roots."""
    rows = _blocked(nodes.select("g", "pos", "total", "digest", *[c for c in carried if c not in ("g", "pos", "total", "digest")]), height)
    head = above.select("g", F.col("pos").alias("blk"), F.lit(-1).cast("long").alias("pos"), "path", "subroot", "root")
    both = rows.unionByName(head, allowMissingColumns=True).repartition("g", "blk").sortWithinPartitions("g", "blk", "pos")
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([f"{c} {types[c]}" for c in carried] + ["path binary", "subroot binary", "root binary"])
    return both.mapInArrow(_walk(carried, subtree), schema)


def _paths(levels: list[DataFrame], top: DataFrame, carried: list[str], height: int, subtree: int) -> DataFrame:
    above = top
    for nodes in levels[-2:0:-1]:
        above = base.cut(_descend(nodes, above, ["g", "pos"], height, subtree))
    return _descend(levels[0], above, carried, height, subtree) if len(levels) > 1 else levels[0].join(above, ["g", "pos"]).select(*carried, "path", "subroot", "root")


def prove(leaves: DataFrame, *, height: int = HEIGHT, subtree: int = SUBTREE) -> DataFrame:
    """leaves (g, doc_id, digest, ...) with pos, path, subroot and root.  g: the group, as a string that sorts
    as the groups do; digest: binary.  Other columns travel along."""
    given = [c for c in leaves.columns if c != "g"]
    seq = base.cut(leaves.withColumn("seq", F.monotonically_increasing_id()))
    nodes = base.cut(placed(seq, ["doc_id", "digest"]))
    own = tree(nodes, height)
    subroots = own[-1].where("total = 1") if len(own) == 1 else own[-1]
    groups = subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest", F.lit(0).cast("long").alias("seq"))
    outer = tree(base.cut(placed(groups, ["name"])), height)
    root = outer[-1].select(F.lit("").alias("g"), F.lit(0).cast("long").alias("pos"), F.lit(b"").alias("path"), F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
    named = _paths(outer, root, ["name", "digest"], height, subtree)
    top = base.cut(named.select(F.col("name").alias("g"), F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot"), "root"))
    return _paths(own, top, [*given, "g", "pos"], height, subtree)


def group_key(source: Column) -> Column:
    """Sorts as the sources do, bytewise, with null first."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def manifest(docs: DataFrame, *, group: str = "source", fields: tuple[str, ...] = FIELDS, key: str = "doc_id", text: str = "text", height: int = HEIGHT, subtree: int = SUBTREE) -> DataFrame:
    """(doc_id, g, digest, again, pos, path, subroot, root).  again: the leaf of the row as it is
    found later; here, where crc32 of the id is even, without the text's line feeds."""
    tampered = F.replace(F.col(text), F.lit("\n"), F.lit(""))
    again = F.when(base.crc_mod(key, 2) == 0, leaf_of(*[tampered if c == text else F.col(c) for c in fields]))
    rows = docs.select(F.col(key).alias("doc_id"), group_key(F.col(group)).alias("g"), leaf_of(*[F.col(c) for c in fields]).alias("digest"), again.alias("again"))
    return prove(rows.withColumn("again", F.coalesce("again", "digest")), height=height, subtree=subtree)


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        proofs, roots = [], []
        for leaf, path in zip(base.column(batch, "again").to_pylist(), base.column(batch, "path").to_pylist()):
            proofs.append(combine([x for _, siblings in steps(path) for x in siblings]))
            roots.append(fold(leaf, path))
        keep = ["doc_id", "digest", "subroot", "root"]
        yield pa.RecordBatch.from_arrays([base.column(batch, c) for c in keep] + [pa.array(proofs, pa.binary()), pa.array(roots, pa.binary())], names=[*keep, "proof", "folded"])


def audit(proved: DataFrame) -> DataFrame:
    """What a manifest says of the rows as they are now: digests as hex text, and whether each row's
    path leads from its present leaf to the root."""
    rows = proved.mapInArrow(_audit, f"doc_id {proved.schema['doc_id'].dataType.simpleString()}, digest binary, subroot binary, root binary, proof binary, folded binary")
    text = lambda c, name: F.lower(F.hex(c)).alias(name)
    return rows.select("doc_id", text("digest", "leaf"), text("subroot", "subroot"), text("root", "root"), text("proof", "proof_sha256"), text("folded", "folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(manifest(base.table(spark, sf_dir, "documents")))


_FIELD = "coalesce(strlen(cast({0} as varchar)) || ':' || cast({0} as varchar), '-')"
_LEAF = " || ".join(_FIELD.format(c) for c in FIELDS)
# The reflected CRC-32 of the decimal id, bit by bit
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::ubigint], list_transform(string_split(cast(doc_id as varchar), ''), lambda x: ascii(x)::ubigint)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::ubigint[], lambda c, z: xor(c >> 1, 3988292384::ubigint * (c & 1::ubigint)))))"""
OP13_SQL = f"""
with recursive p as (
  select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as pos, row_number() over () as r from (
    select doc_id, coalesce({_CRC} % 2, 0) as crc, coalesce('=' || source, '') as g, sha256({_LEAF}) as leaf, sha256({_LEAF.replace("cast(text as varchar)", "replace(text, chr(10), '')")}) as cleaned from documents)),
lv(g, l, pos, h, n) as (
  select g, 0, pos, leaf, count(*) over (partition by g) from p
  union all select g, l + 1, pos // 3, sha256(string_agg(h, '' order by pos)), any_value((n + 2) // 3) from lv where n > 1 group by g, l, pos // 3),
sub as (select g, h as subroot, row_number() over (order by g) - 1 as sp from lv where n = 1),
up(l, pos, h, n) as (
  select 0, sp, subroot, count(*) over () from sub
  union all select l + 1, pos // 3, sha256(string_agg(h, '' order by pos)), any_value((n + 2) // 3) from up where n > 1 group by l, pos // 3),
runs as (select g, l, pos // 3 as run, list(h order by pos) as hs from lv where n > 1 group by all),
top as (select l, pos // 3 as run, list(h order by pos) as hs from up where n > 1 group by all),
path as (
  select r, row_number() over (partition by r order by o) as k, own, hs from (
    select r, l as o, cast((pos // cast(pow(3, l) as bigint)) % 3 as int) as own, hs from p join runs using (g) where run = pos // cast(pow(3, l + 1) as bigint)
    union all select r, 1000 + l, cast((sp // cast(pow(3, l) as bigint)) % 3 as int), hs from p join sub using (g) join top on run = sp // cast(pow(3, l + 1) as bigint))),
f(r, k, h) as (
  select r, 0, case when crc = 0 then cleaned else leaf end from p
  union all select f.r, f.k + 1, sha256(array_to_string(list_concat(list_concat(hs[:own], [f.h]), hs[own + 2:]), '')) from f join path on path.r = f.r and path.k = f.k + 1),
folded as (select r, arg_max(h, k) as folded_root from f group by r),
proof as (select r, sha256(string_agg(coalesce(array_to_string(list_concat(hs[:own], hs[own + 2:]), ''), ''), '' order by k)) as proof_sha256 from path group by r)
select doc_id, leaf, subroot, up.h as root, coalesce(proof_sha256, sha256('')) as proof_sha256, folded_root, folded_root = up.h as verified
from p join sub using (g) join folded using (r) left join proof using (r) join up on up.n = 1
"""
