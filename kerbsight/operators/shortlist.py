"""A deterministic shortlist: by tier, capped for each sequence, then overall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .survey import fence, positive

MAX_ITEMS, PER_SEQUENCE = 24, 4
NO_ERROR = 999.0


def tier(panoramic: Column, view: Column, in_fov: Column) -> Column:
    """0: target in view; 1: front with unknown field of view; 2: panorama; else null."""
    pano = F.coalesce(panoramic, F.lit(False)) | F.coalesce(view == "panoramic", F.lit(False))
    front = F.coalesce(view == "front", F.lit(False))
    return F.when(~pano & F.coalesce(in_fov, F.lit(False)), 0).when(~pano & front & in_fov.isNull(), 1).when(pano, 2)


def tiered(rows: DataFrame) -> DataFrame:
    """Behind a fence: pushed below the angles, the filter would evaluate them many times over."""
    return fence(rows.withColumn("tier", tier(F.col("panoramic"), F.col("view_class"), F.col("target_in_fov")))).where("tier is not null")


def _keys() -> list[Column]:
    distance = F.coalesce(F.col("distance_m").try_cast("double"), F.lit(float("inf")))
    error = F.coalesce(F.col("heading_error_deg").try_cast("double"), F.lit(NO_ERROR))
    return [F.col("tier"), distance, error, F.coalesce("source_id", F.lit(""))]


def capped(rows: DataFrame, per_sequence: int = PER_SEQUENCE) -> DataFrame:
    """The best of each sequence; a candidate without one is a group of its own.
    Spark keeps only the best of each group before the exchange already."""
    positive(per_sequence=per_sequence)
    known = F.coalesce("sequence_id", F.lit("")) != ""
    group = F.when(known, F.col("sequence_id")).otherwise(F.concat(F.lit("__unsequenced__:"), F.coalesce("source_id", F.lit(""))))
    best = Window.partitionBy("group_key").orderBy(*_keys())
    return rows.withColumn("group_key", group).withColumn("place", F.row_number().over(best)).where(F.col("place") <= per_sequence).drop("place", "group_key")


def shortlist(rows: DataFrame, *, max_items: int = MAX_ITEMS, per_sequence: int = PER_SEQUENCE) -> DataFrame:
    """At most max_items candidates with their tier and rank, in rank order."""
    positive(max_items=max_items)
    top = capped(tiered(rows), per_sequence).orderBy(*_keys()).limit(max_items)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*_keys()))).orderBy("rank")
