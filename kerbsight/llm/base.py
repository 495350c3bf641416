"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Where the session names none, a temporary folder is made and set if everything
    runs in this process (tests); on a cluster that is an error, as executors
    would write to disks of their own.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="kerbsight-")
    sc.setCheckpointDir(folder)
    return folder


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of the shared store, through Spark's own access to it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, stored in the shared folder: later steps survive lost executors."""
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    release(df.sparkSession)
    return out


def drop(*frames: DataFrame) -> None:
    """Deletes what cut has stored, once nothing reads these frames any more."""
    for df in frames:
        stored = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if stored.isDefined():
            remove_folder(df.sparkSession, stored.get())


def release(spark: SparkSession) -> None:
    """Lets Spark drop what finished steps have left: it deletes their shuffle files and
    broadcasts once the driver's objects for them are collected, which long
    iterative jobs cannot leave to chance."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Rows go through Python in slices of about so many bytes; a larger row is a slice of its own.
SLICE_BYTES = 2 << 20


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, a bounded number of bytes at a time."""
    size = np.full(batch.num_rows, 64, np.int64)
    for c in batch.columns:
        if pa.types.is_string(c.type) or pa.types.is_binary(c.type):
            size += np.asarray(pc.binary_length(c).fill_null(0))
    total = np.concatenate(([0], np.cumsum(size)))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(total, total[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def trim() -> None:
    """Gives memory that nothing uses any more back to the system: workers live on
    from stage to stage, and an executor's limit counts what they hold."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


try:
    _libc = ctypes.CDLL("libc.so.6")
    _libc.malloc_trim  # noqa: B018  glibc only
except (OSError, AttributeError):
    _libc = None


def map_arrow(
    df: DataFrame,
    step: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    added: StructType,
    *,
    keep: list[str] | None = None,
    only: str | None = None,
) -> DataFrame:
    """df's columns (or those in keep) followed by what step computes for each
    slice of rows, one value a row.  A column of df named like an added one gives way
    to it.  only: the name of a boolean result; just the rows for which it is true stay,
    without the results."""
    new_names = {f.name.lower() for f in added}
    kept = [c for c in (df.columns if keep is None else keep) if only or c.lower() not in new_names]
    schema = StructType([df.schema[c] for c in kept] + [StructField(f.name, f.dataType, True) for f in added if not only])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                new = step(part)
                arrays = [column(part, c) for c in kept]
                if only:
                    out = pa.RecordBatch.from_arrays(arrays, names=schema.names).filter(new[only])
                else:
                    out = pa.RecordBatch.from_arrays(arrays + [new[f.name] for f in added], names=schema.names)
                del new, arrays
                yield out
            trim()

    return df.mapInArrow(run, schema)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def crc_mod(doc_id: str, m: int):
    """crc32 of the id's decimal text, mod m (null: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(m))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not use yet."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name = "_" + name
    return name


def size_limit(text: str) -> int:
    """Bytes from 8m, 64k, 1g or a plain number."""
    m = re.fullmatch(r"(\d+)([kmg]?)b?", text.strip().lower())
    if not m:
        raise ValueError(f"not a size: {text!r}")
    return int(m[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[m[2]]


def first_hashes(hashes: DataFrame, limit: int) -> list[tuple]:
    """The rows of hashes (its first column a distinct 64-bit hash) that come first, at most
    ``limit``.  A threshold on the hash picks a few more than that, so what reaches the
    driver does not grow with rows or partitions."""
    h, n = hashes.columns[0], hashes.count()
    want = min(limit, n)
    share = (limit + 8 * limit**0.5 + 50) / max(1, n)
    while want:
        some = hashes if share >= 1 else hashes.where(F.col(h) < F.lit(int(-(2**63) + share * 2**64)))
        rows = sorted(tuple(r) for r in some.collect())
        if len(rows) >= want:
            return rows[:limit]
        share *= 2
    return []


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int, *, where=None, seed: int = 17) -> list:
    """At most ``limit`` labelled rows (doc_id, text, label), always the same for the
    same tables: those whose hashed id comes first.  A document labelled twice
    takes its smallest label, an id with several texts its smallest text; a null label or id is
    no label, nor is one without a document.  Only about ``limit`` ids are
    broadcast, and only ``limit`` texts reach the driver."""
    picked = labels.select(F.col("doc_id").alias("i"), F.col(label).cast("int").alias("y")).where("i is not null and y is not null")
    if where is not None:
        picked = picked.where(where("i"))
    there = picked.join(docs.select(F.col("doc_id").alias("d")), F.col("i") == F.col("d"))
    there = there.groupBy("i").agg(F.min("y").alias("y")).select(F.xxhash64("i", F.lit(seed)).alias("h"), "i", "y")
    ids = docs.sparkSession.createDataFrame([(i, y) for _, i, y in first_hashes(there, limit)], "i long, y int")
    rows = docs.select(F.col("doc_id").alias("d"), F.coalesce(F.col("text"), F.lit("")).alias("t")).join(F.broadcast(ids), F.col("d") == F.col("i"))
    return sorted((r["d"], r["t"], r["y"]) for r in rows.groupBy("d").agg(F.min("t").alias("t"), F.min("y").alias("y")).collect())
