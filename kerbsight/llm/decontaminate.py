"""Benchmark decontamination with one Aho-Corasick automaton.

Test items are normalised to words (ASCII letters lower-cased, every other
ASCII character but 0-9 a separator) and cut into windows of 13 consecutive
words; an item of fewer words is one window.  The automaton holds the shorter items and, of the others, the
pieces of 7 words that begin at every 7th word: each window has a whole one in it.  It reads words, not bytes: each
word of the benchmark is two symbols of a small alphabet, every other word two blanks.  Each
text is normalised and scanned once; around a piece, the windows that hold it are looked up by fingerprint and
compared word by word.  What matches is mapped back to the bytes and words of the original text.  (The trie and its failure
links are those of the ahocorasick package.)

Size of what is collected and broadcast: distinct items of about ``part_bytes`` (and one item at least), whose
automaton and windows take some 40 bytes a byte in a worker.  A benchmark of that size is one automaton and one pass.  A larger one
is worked off in so many parts, a pass each; what a pass finds is stored by a digest of the text, never the
texts, and joined to the documents in the end.

Edge cases: a null or empty text, or one without words, has no words, no hits
and is not contaminated; a null or wordless item, or one without an id, has no windows; items with
equal windows all count, repeated items once; repeated rows are judged each on their own; an empty
benchmark contaminates nothing.
"""

from __future__ import annotations

import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from . import base
from .textbatch import buffers, rolling

WINDOW = 13
PART_BYTES = 12 << 20

_TABLE = bytearray(range(256))
for _b in range(128):
    if 65 <= _b <= 90:
        _TABLE[_b] = _b + 32
    elif not (48 <= _b <= 57 or 97 <= _b <= 122):
        _TABLE[_b] = 32
_TABLE = bytes(_TABLE)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Scanner:
    """The automaton of some items; ``scan`` finds their windows in a text."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.names, self.window, self.piece = [name for name, _ in items], window, (window + 1) // 2
        number: dict[bytes, int] = {}
        long, owner, short = [np.zeros(0, np.int32)], [], {}
        for k, (_, text) in enumerate(items):
            words = words_of((text or "").encode("utf-8", "surrogatepass"))
            if not words:
                continue
            item = np.array([number.setdefault(w, len(number) + 1) for w in words], np.int32)
            if len(item) < window:
                short.setdefault(tuple(item.tolist()), set()).add(k)
            else:
                long.append(item)
                owner.append(k)
        self.number, self.empty = number, not number
        side = int(len(number) ** 0.5) + 1
        # The first symbol of a word is never a second one, so matches begin and end at words; 0 is no word.
        self.symbols = ["\0\0"] + [chr(1 + k // side) + chr(1 + side + k % side) for k in range(len(number))]
        self.code = np.random.Generator(np.random.PCG64(13)).integers(0, 2**64, len(number) + 1, dtype=np.uint64)
        patterns: dict[str, tuple[int, ...]] = {}  # none: a piece
        for item in long[1:]:
            for at in range(0, len(item) - self.piece + 1, self.piece):
                patterns[self._spell(item[at : at + self.piece])] = ()
        alone = {self._spell(words): (len(words), tuple(who)) for words, who in short.items()}
        self.auto = ahocorasick.Automaton()
        for pattern in patterns.keys() | alone.keys():
            self.auto.add_word(pattern, (pattern in patterns, *alone.get(pattern, (0, ()))))
        if not self.empty:
            self.auto.make_automaton()
        self._index(long, np.array(owner, np.int32))

    def _spell(self, words) -> str:
        return "".join([self.symbols[w] for w in words])

    def _index(self, long: list[np.ndarray], owner: np.ndarray) -> None:
        """Distinct windows by fingerprint, where each stands in an item, and whose it is."""
        self.words = np.concatenate(long)
        count = np.array([len(x) for x in long[1:]], np.int64)
        starts = np.cumsum(count) - count
        size = count - self.window + 1
        at = np.repeat(starts - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        mark = np.concatenate([rolling(self.code[x], self.window) for x in long[1:]] or [np.zeros(0, np.uint64)])
        who = np.repeat(owner, size)
        order = np.lexsort((who, mark))
        mark, at, who = mark[order], at[order], who[order]
        fresh = np.ones(len(mark), bool)
        fresh[1:] = mark[1:] != mark[:-1]
        once = fresh.copy()
        once[1:] |= who[1:] != who[:-1]
        self.marks, self.places = mark[fresh], at[fresh].astype(np.int32)
        self.owners = who[once]
        self.cuts = np.append(np.flatnonzero(fresh[once]), len(self.owners)).astype(np.int64)

    def _windows(self, numbers: np.ndarray, ends: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Windows that hold a piece which ends at one of these words."""
        first = np.unique(np.asarray(ends)[:, None] - np.arange(self.piece - 1, self.window)[None, :])
        first = first[(first >= 0) & (first + self.window <= len(numbers))]
        if not len(first):
            return [], set()
        mark = rolling(self.code[numbers], self.window)[first]
        k = np.minimum(np.searchsorted(self.marks, mark), len(self.marks) - 1)
        same = self.marks[k] == mark
        first, k = first[same], k[same]
        step = np.arange(self.window)
        same = (numbers[first[:, None] + step] == self.words[self.places[k][:, None] + step]).all(1)
        items: set[int] = set()
        for x in np.unique(k[same]).tolist():
            items.update(self.owners[self.cuts[x] : self.cuts[x + 1]].tolist())
        return [(a, a + self.window) for a in first[same].tolist()], items

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[int]]:
        """Words in the text; word ranges [from, to) that are hit, merged; item numbers."""
        words = words_of(text)
        if not words or self.empty:
            return len(words), [], []
        get = self.number.get
        numbers = [get(x, 0) for x in words]
        items: set[int] = set()
        ranges, ends = [], []
        for e, (piece, n, who) in self.auto.iter(self._spell(numbers)):
            if piece:
                ends.append(e // 2)
            if who:
                items.update(who)
                ranges.append((e // 2 + 1 - n, e // 2 + 1))
        if ends:
            found, more = self._windows(np.array(numbers, np.int32), ends)
            ranges += found
            items |= more
        return len(words), merged(ranges), sorted(items)


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same words as ranges that do not touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _word_bytes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets in the original text at which words start and end."""
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = np.frombuffer(text.translate(_TABLE), np.uint8) != 32
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


HIT = StructType(
    [
        StructField("n_words", LongType()),
        StructField("n_hit", LongType()),
        StructField("items", ArrayType(StringType())),
        StructField("span_start", ArrayType(LongType())),
        StructField("span_end", ArrayType(LongType())),
    ]
)


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    out: str = "decontam",
    window: int = WINDOW,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """docs with a struct column ``out``: n_words, n_hit, items (sorted ids as
    strings), and the byte spans (span_start, span_end) of the original text that
    occurring windows cover.  An input column named like ``out`` is replaced."""
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(item_text).cast("string").alias("t")).where("i is not null and t is not null").distinct()
    total = rows.select(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-int(total) // part_bytes))
    if parts == 1:
        return base.map_arrow(docs, _step(_held(rows), text, window, out), StructType([StructField(out, HIT)]))
    digest = base.free_name(docs, "text_digest")
    keyed = docs.withColumn(digest, F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))
    each = []
    for p in range(parts):
        held = _held(rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == p))
        hits = base.map_arrow(keyed.select(digest, text), _step(held, text, window, "hit"), StructType([StructField("hit", HIT)]), keep=[digest])
        each.append(base.cut(hits.where("hit.n_hit > 0").groupBy(digest).agg(F.min("hit").alias("hit"))))
        held.destroy()
    hits = each[0]
    for more in each[1:]:
        hits = hits.unionByName(more)
    part = base.free_name(keyed, "part_hits")
    # A text has one row of hits for each part at most
    hits = base.cut(hits.groupBy(digest).agg(F.sort_array(F.collect_list("hit")).alias(part)))
    both = keyed.join(hits, digest, "left")
    return base.map_arrow(both, _joined(text, part, out), StructType([StructField(out, HIT)]), keep=docs.columns)


def _held(rows: DataFrame):
    return rows.sparkSession.sparkContext.broadcast(sorted((r["i"], r["t"]) for r in rows.collect()))


def _structs(out: str, got: list[tuple]) -> dict[str, pa.Array]:
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    arrays = [pa.array(v, k) for v, k in zip(zip(*got), kinds)]
    return {out: pa.StructArray.from_arrays(arrays, names=HIT.names)}


def _texts(batch: pa.RecordBatch, text: str) -> list[bytes]:
    data, off = buffers(base.column(batch, text).cast(pa.string()))
    cuts = off.tolist()
    return [data[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]


#: The automaton a worker has built last: its later tasks go on with it.
_built: dict[str, Scanner] = {}


def _step(held, text: str, window: int, out: str):
    name = uuid.uuid4().hex

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        if name not in _built:
            _built.clear()
            _built[name] = Scanner(held.value, window)
        return _structs(out, [_judge(_built[name], x) for x in _texts(batch, text)])

    return run


def _joined(text: str, part: str, out: str):
    """HITs of rows that bring along what each part of the benchmark has found in their text."""

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        got = []
        for x, hits in zip(_texts(batch, text), base.column(batch, part).to_pylist()):
            starts, ends = _word_bytes(x)
            ranges = [r for h in hits or [] for r in zip(np.searchsorted(starts, h["span_start"]).tolist(), (np.searchsorted(ends, h["span_end"]) + 1).tolist())]
            got.append(_hit(len(starts), merged(ranges), {i for h in hits or [] for i in h["items"]}, starts, ends))
        return _structs(out, got)

    return run


def _judge(scanner: Scanner, text: bytes) -> tuple:
    n, ranges, items = scanner.scan(text)
    return _hit(n, ranges, {scanner.names[k] for k in items}, *(_word_bytes(text) if ranges else ([], [])))


def _hit(n: int, ranges: list[tuple[int, int]], names: set[str], starts, ends) -> tuple:
    """One text's HIT: words, hit words, items, and the bytes of each range."""
    return n, sum(b - a for a, b in ranges), sorted(names), [int(starts[a]) for a, _ in ranges], [int(ends[b - 1]) for _, b in ranges]


def contaminated(n_hit, n_words):
    return (n_hit > 0) & (F.lit(20) * n_hit >= n_words)


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the contaminated ones, same columns."""
    out = base.free_name(docs, "decontam")
    found = find(docs, benchmark, out=out, **options)
    return found.where(~contaminated(F.col(f"{out}.n_hit"), F.col(f"{out}.n_words"))).select(*docs.columns)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = find(docs, base.table(spark, sf_dir, "benchmark")).select("doc_id", "decontam.*")
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


OP2_SQL = r"""
with d as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as w from documents),
b as (
  select cast(item_id as varchar) as item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as w from benchmark),
iw as (
  select distinct item, least(len(w), 13) as n, array_to_string(w[a : a + least(len(w), 13) - 1], ' ') as t
  from (select item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as a from b where len(w) > 0 and item is not null)),
lens as (select distinct n from iw),
dw as (select r, a, n, array_to_string(w[a : a + n - 1], ' ') as t from (select r, w, n, unnest(range(1, len(w) - n + 2)) as a from d, lens where len(w) >= n)),
hit as (select r, a, n, item from dw join iw using (n, t)),
words as (select r, count(distinct p) as n_hit from (select r, unnest(range(a, a + n)) as p from hit) group by r),
items as (select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as names from hit group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join words using (r) left join items using (r)
"""
