"""A corpus pipeline of five stages, each written as Parquet and reread by the next.

Quality rules, MinHash near-dedup, substring dedup, benchmark decontamination,
and SentencePiece encoding.  Each stage takes (spark, docs, sf_dir); all but the
last return the columns of documents.

Edge cases, as the stages have them: null and empty texts, and those without words, fail
the quality rules and go; of equal rows, and of rows with equal words, one stays; a null
doc_id is no reason to go, but any other id of its group stays before it; null lang, source and n_chars
pass through, as do further columns of any name; a text that loses all its words to repeats
goes; without benchmark items nothing is contaminated, and without labels the quality rules
judge by their prior; an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbsight.llm import base, decontaminate, near_dedup, pieces, quality, repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the count rules and the line labelling."""
    return quality.keep(docs, base.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its five-word shingles."""
    return near_dedup.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the word windows that occur more than once."""
    return repeats.clean(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without too many words of the benchmark's items."""
    return decontaminate.clean(docs, base.table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its sampled pieces, and whether they decode to its text."""
    coded = pieces.round_trip(docs)
    return coded.withColumn("n_pieces", F.size("pieces").cast("long"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", decontaminated),
    ("sentencepiece", encoded),
]

#: The line labelling, the sketches and the sampling have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stored in the shared folder; what a stage has read
    goes once the next one's rows are written, so the last stage's rows are what is left."""
    folder = f"{base.shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = base.table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}_{name}")
        docs = spark.read.parquet(f"{folder}/{k}_{name}")
        if k:
            base.remove_folder(spark, f"{folder}/{k - 1}_{STAGES[k - 1][0]}")
    return docs
