"""Counts over candidates: by class, by field of view, by sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import VIEW_CLASSES


def view_class_counts(rows: DataFrame) -> DataFrame:
    """(view_class, candidate_count): the five known classes always, others if they occur."""
    spark = rows.sparkSession
    known = spark.createDataFrame([(c,) for c in VIEW_CLASSES], "view_class string")
    counted = rows.groupBy("view_class").agg(F.count("*").alias("n"))
    both = known.select("view_class", F.lit(0).cast("long").alias("n")).unionByName(counted)
    return both.groupBy("view_class").agg(F.sum("n").alias("candidate_count"))


def fov_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count_if("target_in_fov").alias("fov_true"),
        F.count_if(~F.col("target_in_fov")).alias("fov_false"),
        F.count_if(F.col("target_in_fov").isNull()).alias("fov_unknown"),
    )


def overall(rows: DataFrame) -> DataFrame:
    """One row: all global counts, zero for empty input."""
    sequence = F.nullif("sequence_id", F.lit(""))
    return rows.agg(
        F.count("*").alias("candidate_count"),
        F.count_distinct(sequence).alias("sequence_count"),
        F.count_if(sequence.isNull()).alias("unsequenced_count"),
        *[F.count_if(F.col("view_class") == c).alias(f"{c}_count") for c in VIEW_CLASSES],
        F.count_if("target_in_fov").alias("fov_true"),
        F.count_if(~F.col("target_in_fov")).alias("fov_false"),
        F.count_if(F.col("target_in_fov").isNull()).alias("fov_unknown"),
    )


def sequences(rows: DataFrame) -> DataFrame:
    """One row for each sequence that has a name (order: min_distance_m, sequence_id)."""
    return (
        rows.where(F.coalesce("sequence_id", F.lit("")) != "")
        .groupBy("sequence_id")
        .agg(
            F.count("*").alias("candidate_count"),
            F.min("distance_m").alias("min_distance_m"),
            *[F.count_if(F.col("view_class") == c).alias(f"{c}_count") for c in VIEW_CLASSES],
            F.count_if("target_in_fov").alias("target_in_fov_count"),
        )
    )


def ordered_sequences(rows: DataFrame) -> DataFrame:
    return sequences(rows).orderBy("min_distance_m", "sequence_id")
