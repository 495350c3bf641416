"""Files: recorded search pages, survey documents, site configurations."""

from __future__ import annotations

import tomllib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import CANDIDATE


def pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_no, body): one JSON document a file, numbered by file name.  The names, and they alone, are
    sorted in one task."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    order = files.select("file").distinct().select("file", (F.row_number().over(Window.orderBy("file")) - 1).cast("long").alias("page_no"))
    return files.join(order, "file").select("page_no", F.col("value").alias("body"))


def survey_document(spark: SparkSession, path: str) -> DataFrame:
    """The candidates of a survey document, or of a folder of them; if one has no candidate list, a ValueError."""
    text = spark.read.text(path, wholetext=True)
    if not text.select(F.coalesce(F.startswith(F.schema_of_variant(F.try_variant_get(F.try_parse_json("value"), "$.candidates", "variant")), F.lit("ARRAY")), F.lit(False)).alias("ok")).agg(F.min("ok").alias("ok")).first()["ok"]:
        raise ValueError("not a survey document: it lists no candidates")
    rows = spark.read.json(path, multiLine=True, schema=f"candidates array<struct<{', '.join(f'{f.name}: {f.dataType.simpleString()}' for f in CANDIDATE)}>>")
    return rows.select(F.posexplode("candidates").alias("input_pos", "c")).where("c is not null").select("c.*")


def target_of(latitude: float | None, longitude: float | None, site: str | None) -> tuple[float, float]:
    """Coordinates from arguments, where missing from a TOML site file."""
    if site and (latitude is None or longitude is None):
        found = tomllib.loads(Path(site).read_text(encoding="utf-8"))
        latitude = found.get("latitude") if latitude is None else latitude
        longitude = found.get("longitude") if longitude is None else longitude
    if latitude is None or longitude is None:
        raise ValueError("latitude and longitude are needed, as arguments or in a site file")
    return float(latitude), float(longitude)
