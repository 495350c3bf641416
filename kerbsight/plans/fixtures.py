"""Synthetic picture items projected from the events table, typed and as JSON pages.

Invented data: integer arithmetic on ids only, so that any engine gets the same
values.  The JSON form spells the same items the way loosely typed catalogues do.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.survey import Target
from ..sources import files

TARGET = Target(45.9086611, 6.0984374, 500.0)
PAGE = 100

ITEMS_SQL = """
select event_id, concat('pic-', cast(event_id as {S})) as source_id,
  cast(45.9086611 as double) + cast((event_id * 7919) % 2001 - 1000 as double) * cast('1e-5' as double) as latitude,
  cast(6.0984374 as double) + cast((event_id * 104729) % 2003 - 1001 as double) * cast('1e-5' as double) as longitude,
  case when event_id % 5 = 0 then null else cast((event_id * 31) % 720 - 180 as double) end as raw_heading,
  case when event_id % 3 = 0 then null when event_id % 11 = 0 then cast(360 as double) else cast(30 + (event_id * 17) % 90 as double) end as fov,
  case event_type when 'signup' then true when 'view' then false end as pano_flag,
  case when user_id % 10 = 0 then null else concat('seq-', cast(user_id as {S})) end as sequence_id
from {events}
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ITEMS_SQL.format(S="string", events="{events}"), events=events(spark, sf_dir))


def typed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    fov, flag = F.col("fov"), F.col("pano_flag")
    from ..functions.stac import panoramic_from_fov

    return raw_items(spark, sf_dir).select(
        "source_id",
        "latitude",
        "longitude",
        F.pmod("raw_heading", F.lit(360.0)).alias("heading_deg"),
        fov.alias("field_of_view_deg"),
        F.coalesce(flag, panoramic_from_fov(fov)).alias("panoramic"),
        "sequence_id",
    )


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(target_id, latitude, longitude, radius_m): a target for each customer, by arithmetic on its key."""
    k, step = F.col("c_custkey"), 1e-5
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        k.alias("target_id"),
        (F.lit(TARGET.latitude) + ((k * 6151) % 2003 - 1001).cast("double") * step).alias("latitude"),
        (F.lit(TARGET.longitude) + ((k * 3571) % 2011 - 1005).cast("double") * step).alias("longitude"),
        (5 + (k * 37) % 56).cast("double").alias("radius_m"),
    )


def json_pages(spark: SparkSession, sf_dir: str, *, page: int = PAGE) -> DataFrame:
    """(page_no, body): the items as search pages of so many features, with keys and
    types varied by id; every seventh feature comes again with another time, every third
    links to itself."""
    e = F.col("event_id")
    number = lambda c: F.col(c).cast("string")
    part = lambda name, value: F.when(value.isNull(), "").otherwise(F.concat(F.lit(f'"{name}":'), value, F.lit(",")))
    heading = F.when(e % 2 == 0, part("view:azimuth", number("raw_heading"))).otherwise(part("heading", number("raw_heading")))
    fov = F.when(e % 4 == 0, part("view:fov", number("fov"))).otherwise(part("pers:interior_orientation", F.concat(F.lit('{"field_of_view":'), number("fov"), F.lit("}"))))
    pano = F.when(e % 2 == 0, part("panoramic", number("pano_flag"))).otherwise(part("view:type", F.when(F.col("pano_flag"), F.lit('"Spherical"')).when(~F.col("pano_flag"), F.lit('"flat"'))))
    props = F.concat(F.lit('"properties":{'), heading, fov, pano, F.lit('"datetime":"2024-01-01T00:00:00Z"},'))
    own = F.when(e % 3 == 0, F.concat(F.lit('"links":[{"rel":"self","href":"https://items.example/'), F.col("source_id"), F.lit('"}],'))).otherwise("")
    place = F.concat(F.lit('"geometry":{"type":"Point","coordinates":['), number("longitude"), F.lit(","), number("latitude"), F.lit("]},"))
    collection = part("collection", F.concat(F.lit('" '), F.col("sequence_id"), F.lit(' "')))
    feature = F.concat(F.lit("{"), props, own, place, collection, F.lit('"id":"'), F.col("source_id"), F.lit('"}'))
    rows = raw_items(spark, sf_dir).select("event_id", feature.alias("feature"), F.floor(e / page).alias("page_no"))
    twice = rows.withColumn("copy", F.explode(F.when(e % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    twice = twice.withColumn("feature", F.when(F.col("copy") == 1, F.replace("feature", F.lit("2024-"), F.lit("1999-"))).otherwise(F.col("feature")))
    listed = twice.groupBy("page_no").agg(F.sort_array(F.collect_list(F.struct("event_id", "copy", "feature"))).alias("x"))
    return listed.select("page_no", F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.col("x.feature"), ","), F.lit('],"links":[]}')).alias("body"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: below spark.checkpoint.dir, or, where all run in one
    process and it is unset, a temporary one."""
    sc = spark.sparkContext
    top = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="kerbsight-")
    return f"{top}/{name}-{uuid.uuid4().hex}"


def page_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with a file for each search page, written by the tasks that made them."""
    folder = scratch(spark, "pages")
    spark.dataSource.register(files.FileSink)
    pages = json_pages(spark, sf_dir).select(F.format_string("%012d.json", "page_no").alias("name"), F.col("body").cast("binary").alias("content"))
    pages.write.format("named_files").mode("append").save(folder)
    return folder
