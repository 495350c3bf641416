"""Fill-in-middle rows over run-length encoded character classes.

A text is held as its maximal runs of characters of one class; a class is white space or not,
and the number of UTF-8 bytes of a character.  Each run has the units that end in it, cumulated over the
text.  A cut after c units is in the first run that reaches c (a binary search), and as all
characters of a run have the same length, its byte and its character come from a
product: no unit is ever stored.

Units are words with the white space before them (white space at the end of a text is a unit of its own), or
code points.  The two cuts, whether a text is rearranged and the order of its parts depend on a hash
of the row's key alone, so a retry, another partitioning or a later run gives the same rows.

Edge cases: null texts count as empty; empty texts, and those that contain a sentinel, stay as they are
(form plain); a null key hashes as the empty string; equal rows give equal results;
a cut may leave any of the three parts empty; an empty table gives an empty result; a column of
the table with the name of a result gives way to it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from . import base
from .textbatch import SPACE_BYTES, buffers

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RESULT = StructType([StructField(n, LongType()) for n in ("n", "prefix_chars", "middle_chars")] + [StructField(n, StringType()) for n in ("form", "fim")])

# A character's bytes by its first one (0: inside a character), and whether it is white space
_WIDTH = np.repeat(np.array([1, 0, 2, 3, 4], np.uint8), [128, 64, 32, 16, 16])
_CLASS = _WIDTH.copy()
_CLASS[list(SPACE_BYTES)] = 5


@dataclass
class Runs:
    """The class runs of some texts that lie one behind the other."""

    start: np.ndarray  # byte at which each run begins
    units: np.ndarray  # units that end in the run
    unit_bytes: np.ndarray
    unit_chars: np.ndarray
    total: np.ndarray  # units up to and with the run, over all texts
    chars: np.ndarray  # characters before the run, over all texts
    before: np.ndarray  # units before each text; one more for the end
    chars_before: np.ndarray
    doc_start: np.ndarray

    @property
    def n(self) -> np.ndarray:
        return np.diff(self.before)

    def cut(self, doc: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte, characters from the text's begin) after c units of each text."""
        at = np.searchsorted(self.total, self.before[doc] + c, "left")
        some = c > 0
        at = np.where(some, at, 0)
        if not len(self.start):
            return self.doc_start[doc], np.zeros(len(doc), np.int64)
        inside = self.before[doc] + c - (self.total[at] - self.units[at])
        byte = np.where(some, self.start[at] + inside * self.unit_bytes[at], self.doc_start[doc])
        return byte, np.where(some, self.chars[at] + inside * self.unit_chars[at] - self.chars_before[doc], 0)


def encode(data: np.ndarray, doc_start: np.ndarray, unit: str = "word") -> Runs:
    """Class runs of the texts data[doc_start[d]:doc_start[d + 1]] (UTF-8)."""
    kind = _CLASS[data]
    begins = np.zeros(len(data), bool)
    for k, width in ((1, 1), (2, 2), (3, 3), (4, 4), (5, 1)):
        here = kind == k
        here[width:] &= kind[:-width] != k  # else the character before is of this class
        begins |= here
    cuts = doc_start[:-1][np.diff(doc_start) > 0]
    begins[cuts] = True
    start = np.flatnonzero(begins)
    end = np.append(start[1:], len(data))
    space = kind[start] == 5
    width = _WIDTH[data[start]].astype(np.int64)
    chars = (end - start) // width
    first = np.searchsorted(start, doc_start, "left")
    if unit == "char":
        units, unit_bytes, unit_chars = chars, width, np.ones(len(start), np.int64)
    elif unit == "word":
        last = np.zeros(len(start), bool)
        last[first[1:][np.diff(first) > 0] - 1] = True
        next_space = np.append(space[1:], True) | last
        units = (np.where(space, last, next_space)).astype(np.int64)
        unit_bytes, unit_chars = end - start, chars
    else:
        raise ValueError(f"no such unit: {unit!r}")
    total = np.cumsum(units)
    upto = np.concatenate(([0], total))
    counted = np.concatenate(([0], np.cumsum(chars)))
    return Runs(start, units, unit_bytes, unit_chars, total, counted[:-1], upto[first], counted[first], doc_start)


def _transform(text_name: str, hashes: list[str], unit: str, rate: int, spm: int):
    def step(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        data, off = buffers(base.column(batch, text_name))
        h = [np.asarray(base.column(batch, c)) for c in hashes]
        runs = encode(data, off, unit)
        n, doc = runs.n, np.arange(len(off) - 1)
        x, y = h[0] % (n + 1), h[1] % (n + 1)
        (p, p_chars), (m, m_chars) = runs.cut(doc, np.minimum(x, y)), runs.cut(doc, np.maximum(x, y))
        plain, late = (np.diff(off) == 0) | (h[2] % 100 >= rate), h[3] % 100 < spm
        whole = data.tobytes()
        form, fim = [], []
        for d in doc.tolist():
            text = whole[off[d] : off[d + 1]]
            if plain[d] or b"<P>" in text or b"<S>" in text or b"<M>" in text:
                form.append("plain")
                fim.append(text)
                continue
            a, b = p[d] - off[d], m[d] - off[d]
            form.append("spm" if late[d] else "psm")
            fim.append(b"".join((b"<S>", text[b:], b"<P>", text[:a], b"<M>", text[a:b]) if late[d] else (b"<P>", text[:a], b"<S>", text[b:], b"<M>", text[a:b])))
        kept = np.array([f == "plain" for f in form], bool)
        return {
            "n": pa.array(n),
            "prefix_chars": pa.array(p_chars, mask=kept),
            "middle_chars": pa.array(m_chars - p_chars, mask=kept),
            "form": pa.array(form, pa.string()),
            "fim": pa.array(fim, pa.binary()).cast(pa.string()),
        }

    return step


def transform(docs: DataFrame, *, key: str = "doc_id", text: str = "text", unit: str = "word", seed: int = 42, rate: int = 50, spm: int = 80, keep: list[str] | None = None) -> DataFrame:
    """docs' columns (or those in keep) and: n (units of the text), prefix_chars and middle_chars (code
    points; null if plain), form (plain, psm or spm) and fim, the row to train on.
    rate: per cent of the texts that are rearranged; spm: per cent of those that begin with
    the suffix."""
    if unit not in ("word", "char"):
        raise ValueError(f"no such unit: {unit!r}")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    kept = docs.columns if keep is None else keep
    digest_name, text_name, *hashes = (base.free_name(docs, n) for n in ("fim_digest", "fim_text", "h1", "h2", "h3", "h4"))
    rows = docs.withColumn(text_name, F.col(text).cast("string")).withColumn(digest_name, digest)
    for k, name in enumerate(hashes):
        rows = rows.withColumn(name, F.conv(F.substring(digest_name, 8 * k + 1, 8), 16, 10).cast("long"))
    rows = rows.select(*dict.fromkeys(kept), text_name, *hashes)
    return base.map_arrow(rows, _transform(text_name, hashes, unit, rate, spm), RESULT, keep=kept)


def restore(fim: Column, form: Column) -> Column:
    """The text that a row was made from, out of the row and its form."""
    part = F.split(fim, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    prefix, suffix = (F.when(form == "psm", F.get(part, a)).otherwise(F.get(part, b)) for a, b in ((1, 2), (2, 1)))
    return F.when(form == "plain", fim).otherwise(F.concat(prefix, F.get(part, 3), suffix))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transform(base.table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("fim", 256).alias("output_sha256"), F.sha2(restore(F.col("fim"), F.col("form")), 256).alias("restored_sha256"))


OP11_SQL = r"""
with d as (select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
w as (
  select *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as w,
    [cast('0x' || substr(h, 8 * i + 1, 8) as ubigint) for i in range(4)] as r from d),
c as (
  select *, cast(len(w) as bigint) as n, least(r[1] % (len(w) + 1), r[2] % (len(w) + 1)) as a, greatest(r[1] % (len(w) + 1), r[2] % (len(w) + 1)) as b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or r[3] % 100 >= 50 then 'plain' when r[4] % 100 < 80 then 'spm' else 'psm' end as form from w),
p as (
  select *, coalesce(array_to_string(list_slice(w, 1, a), ''), '') as p, coalesce(array_to_string(list_slice(w, a + 1, b), ''), '') as m,
    coalesce(array_to_string(list_slice(w, b + 1, n), ''), '') as s from c)
select doc_id, n, form, case when form != 'plain' then cast(length(p) as bigint) end as prefix_chars, case when form != 'plain' then cast(length(m) as bigint) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(case form when 'plain' then t else p || m || s end) as restored_sha256 from p
"""
