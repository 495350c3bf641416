"""The registered survey queries and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, stac
from ..operators import preview, shortlist, summary, survey
from .. import schemas
from ..sources import documents, recorded
from . import fixtures
from .fixtures import TARGET

LAT, LON, RADIUS = TARGET.latitude, TARGET.longitude, TARGET.radius_m
WEST, SOUTH, EAST, NORTH = geo.bbox_for_radius(LAT, LON, RADIUS)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

# --- shared oracle text -------------------------------------------------------

_ITEMS = f"items as ({fixtures.ITEMS_SQL.format(S='varchar', events='events')})"
_D = "cast({} as double)".format
_RADIANS = f"radians({_D(LAT)})"
_DISTANCE = (
    f"round({_D(2 * geo.EARTH_RADIUS_M)} * asin(sqrt(sin(radians(latitude - {_D(LAT)}) / 2) * sin(radians(latitude - {_D(LAT)}) / 2)"
    f" + cos({_RADIANS}) * cos(radians(latitude)) * sin(radians(longitude - {_D(LON)}) / 2) * sin(radians(longitude - {_D(LON)}) / 2))), 3)"
)
_BEARING = (
    f"fmod(degrees(atan2(sin(radians({_D(LON)} - longitude)) * cos({_RADIANS}),"
    f" cos(radians(latitude)) * sin({_RADIANS}) - sin(radians(latitude)) * cos({_RADIANS}) * cos(radians({_D(LON)} - longitude)))) + 360, 360)"
)
_BASE = f"""with {_ITEMS},
measured as (select *, {_DISTANCE} as distance_m, {_BEARING} as bearing, fmod(raw_heading + 720, 360) as heading_deg,
  coalesce(pano_flag, case when not isnan(fov) and fov >= 359 then true end) as panoramic from items),
judged as (select *, abs(fmod(heading_deg - bearing + 540, 360) - 180) as error from measured where distance_m <= {RADIUS}),
cand as (select source_id, latitude, longitude, distance_m, sequence_id, heading_deg, fov as field_of_view_deg, panoramic,
  round(bearing, 3) as target_bearing_deg, round(error, 3) as heading_error_deg,
  case when panoramic then true when error is not null and not isnan(fov) and fov > 0 then error <= least(fov, 360) / 2 end as target_in_fov,
  case when panoramic then 'panoramic' when error is null then 'unknown' when error <= 45 then 'front' when error < 135 then 'lateral' else 'rear' end as view_class
  from judged)"""
_TIER = """case when not coalesce(panoramic, false) and view_class != 'panoramic' and target_in_fov then 0
  when not coalesce(panoramic, false) and view_class = 'front' and target_in_fov is null then 1
  when coalesce(panoramic, false) or view_class = 'panoramic' then 2 end"""
_ORDER = "tier, distance_m, coalesce(heading_error_deg, 999), source_id"
_TIERED = f"{_BASE}, tiered as (select *, {_TIER} as tier from cand)"
_CAPPED = f"""{_TIERED}, capped as (select * from (select *, row_number() over (
  partition by coalesce(nullif(sequence_id, ''), '__unsequenced__:' || source_id) order by {_ORDER}) as place
  from tiered where tier is not null) where place <= 4)"""
_SHORT = f"{_CAPPED}, short as (select *, row_number() over (order by {_ORDER}) as rank from capped qualify rank <= 24)"

_COLUMNS = ["source_id", "latitude", "longitude", "distance_m", "sequence_id", "heading_deg", "field_of_view_deg", "panoramic", "target_bearing_deg", "heading_error_deg", "target_in_fov", "view_class"]


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.candidates(fixtures.typed_items(spark, sf_dir), TARGET).select(*_COLUMNS)


# --- geometry -----------------------------------------------------------------


@query(f"{_BASE} select {', '.join(_COLUMNS)} from cand")
def candidates_in_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.ordered(_candidates(spark, sf_dir))


@query(f"with {_ITEMS} select source_id, {_DISTANCE} as distance_m, round({_BEARING}, 3) as bearing_deg from items")
def haversine_bearing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.raw_items(spark, sf_dir).select(
        "source_id",
        F.round(geo.haversine_m(LAT, LON, "latitude", "longitude"), 3).alias("distance_m"),
        F.round(geo.bearing_deg("latitude", "longitude", LAT, LON), 3).alias("bearing_deg"),
    )


@query("select event_id, abs(fmod(cast(event_id % 720 - 360 as double) - cast((event_id * 7) % 360 as double) + 1260, 360) - 180) as difference from events")
def angular_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return fixtures.events(spark, sf_dir).select("event_id", geo.angle_between_deg((e % 720 - 360).cast("double"), ((e * 7) % 360).cast("double")).alias("difference"))


@query(f"with {_ITEMS} select source_id, fmod(raw_heading + 720, 360) as heading_deg from items")
def heading_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.raw_items(spark, sf_dir).select("source_id", geo.floor_mod("raw_heading", 360.0).alias("heading_deg"))


@query(f"with {_ITEMS} select source_id from items where longitude between {_D(repr(WEST))} and {_D(repr(EAST))} and latitude between {_D(repr(SOUTH))} and {_D(repr(NORTH))}")
def bbox_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.raw_items(spark, sf_dir).where(geo.in_bbox("latitude", "longitude", (WEST, SOUTH, EAST, NORTH))).select("source_id")


@query(f"with {_ITEMS} select source_id, coalesce(pano_flag, case when not isnan(fov) and fov >= 359 then true end) as panoramic from items")
def panoramic_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.typed_items(spark, sf_dir).select("source_id", "panoramic")


_TARGETS = f"""targets as (select c_custkey as target_id, {_D(LAT)} + cast((c_custkey * 6151) % 2003 - 1001 as double) * cast('1e-5' as double) as target_latitude,
  {_D(LON)} + cast((c_custkey * 3571) % 2011 - 1005 as double) * cast('1e-5' as double) as target_longitude, cast(5 + (c_custkey * 37) % 56 as double) as target_radius_m from customer)"""


@query(
    f"""with {_ITEMS}, {_TARGETS},
measured as (select t.target_id, t.target_radius_m, i.*, {_DISTANCE.replace(_D(LAT), "target_latitude").replace(_D(LON), "target_longitude")} as distance_m,
  {_BEARING.replace(_D(LAT), "target_latitude").replace(_D(LON), "target_longitude")} as bearing, fmod(raw_heading + 720, 360) as heading_deg,
  coalesce(pano_flag, case when not isnan(fov) and fov >= 359 then true end) as panoramic from items i join targets t
  on abs(i.latitude - t.target_latitude) < 0.001 and abs(i.longitude - t.target_longitude) < 0.002)
select target_id, source_id, distance_m, round(bearing, 3) as target_bearing_deg,
  case when panoramic then 'panoramic' when heading_deg is null then 'unknown' when abs(fmod(heading_deg - bearing + 540, 360) - 180) <= 45 then 'front'
  when abs(fmod(heading_deg - bearing + 540, 360) - 180) < 135 then 'lateral' else 'rear' end as view_class
from measured where distance_m <= target_radius_m"""
)
def candidates_of_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer is a target of its own, with a place and a radius of 5 to 60 m."""
    found = survey.candidates_of_targets(fixtures.typed_items(spark, sf_dir), fixtures.targets(spark, sf_dir))
    return found.select("target_id", "source_id", "distance_m", "target_bearing_deg", "view_class")


# --- loosely typed JSON -------------------------------------------------------

_V = """case event_id % 7 when 0 then concat('{"v":"  s', event_id, ' "}') when 1 then '{"v":5}' when 2 then '{"v":"   "}'
  when 3 then '{"v":null}' when 4 then '{}' when 5 then '{"v":true}' else '{"v":["a"]}' end"""
_AB = """case event_id % 6 when 0 then '{"a":"x","b":"y"}' when 1 then '{"a":" ","b":"y"}' when 2 then '{"a":7,"b":" z "}'
  when 3 then '{"b":null}' when 4 then concat('{"a":"k', event_id, '"}') else '{"a":{},"b":"w"}' end"""
_N = """case event_id % 8 when 0 then '{"a":1.5,"b":2}' when 1 then '{"a":"9","b":2}' when 2 then '{"a":true}' when 3 then '{"a":false,"b":4}'
  when 4 then '{"a":null,"b":3.25}' when 5 then '{"b":[1]}' when 6 then concat('{"a":', event_id, '}') else '{}' end"""
_F = """case event_id % 6 when 0 then '{"view:fov":60,"field_of_view":70}' when 1 then '{"view:fov":"60","pers:horizontal_fov":80.5}'
  when 2 then '{"pers:interior_orientation":{"horizontal_fov":75}}' when 3 then '{"pers:interior_orientation":{"field_of_view":"x","horizontal_fov":76}}'
  when 4 then '{"panoramax:horizontal_fov":true}' else '{"pers:interior_orientation":[1]}' end"""
_S = """case event_id % 7 when 0 then '{"properties":{"proj:shape":[3000,4000]}}' when 1 then '{"properties":{"proj:shape":[3000.7,4000]}}'
  when 2 then '{"properties":{"proj:shape":["300","400"]}}' when 3 then '{"properties":{"proj:shape":["300.5",1],"geovisio:image":{"width":11,"height":12}}}'
  when 4 then '{"properties":{"geovisio:image":{"width":1.5,"height":2}},"assets":{"z":{"width":3},"b":{"width":5,"height":6},"a":{"width":7,"height":8}}}'
  when 5 then '{"properties":{},"assets":[]}' else concat('{"properties":{"geovisio:image":{"width":', event_id, ',"height":9}}}') end"""


def _doc(spark: SparkSession, sf_dir: str, doc: str) -> DataFrame:
    return fixtures.events(spark, sf_dir).selectExpr("event_id", f"{doc} as doc")


def _text(path: str) -> str:
    return f"case when json_type(doc, '{path}') = 'VARCHAR' then nullif(trim(json_extract_string(doc, '{path}')), '') end"


def _number(path: str) -> str:
    return (
        f"case when json_type(doc, '{path}') in ('BIGINT', 'UBIGINT', 'DOUBLE') then cast(json_extract_string(doc, '{path}') as double)"
        f" when json_type(doc, '{path}') = 'BOOLEAN' then case json_extract_string(doc, '{path}') when 'true' then 1.0 else 0.0 end end"
    )


def _from(doc: str) -> str:
    return f"from (select event_id, {doc} as doc from events)"


@query(f"select event_id, {_text('$.v')} as value {_from(_V)}")
def optional_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doc(spark, sf_dir, _V).select("event_id", stac.text_of(stac.get(stac.parse_object(F.col("doc")), "v")).alias("value"))


@query(f"select event_id, coalesce({_text('$.a')}, {_text('$.b')}) as value {_from(_AB)}")
def first_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doc(spark, sf_dir, _AB).select("event_id", stac.first_text(stac.parse_object(F.col("doc")), ("a", "b")).alias("value"))


@query(f"select event_id, cast(coalesce({_number('$.a')}, {_number('$.b')}) as double) as value {_from(_N)}")
def first_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doc(spark, sf_dir, _N).select("event_id", stac.first_number(stac.parse_object(F.col("doc")), ("a", "b")).alias("value"))


_FOV_PATHS = ['$."view:fov"', '$."pers:horizontal_fov"', '$."panoramax:horizontal_fov"', "$.field_of_view", '$."pers:interior_orientation".field_of_view', '$."pers:interior_orientation".horizontal_fov']


@query(f"select event_id, cast(coalesce({', '.join(map(_number, _FOV_PATHS))}) as double) as fov {_from(_F)}")
def field_of_view_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doc(spark, sf_dir, _F).select("event_id", stac.field_of_view(stac.parse_object(F.col("doc"))).alias("fov"))


@query(
    f"""select event_id,
  case event_id % 7 when 0 then 4000 when 1 then 4000 when 2 then 400 when 3 then 11 when 4 then 5 when 5 then null else event_id end as width,
  case event_id % 7 when 0 then 3000 when 1 then 3000 when 2 then 300 when 3 then 12 when 4 then 6 when 5 then null else 9 end as height {_from(_S)}"""
)
def image_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _doc(spark, sf_dir, _S).select("event_id", stac.as_object(stac.get(stac.parse_object(F.col("doc")), "properties")).alias("p"), F.from_json("doc", "assets map<string,variant>").assets.alias("assets"))
    size = stac.dimensions(F.col("p"), F.col("assets"))
    return parsed.select("event_id", size.width.alias("width"), size.height.cast("long").alias("height"))


_URL = "case when cast(substr(source_id, 5) as bigint) % 3 = 0 then concat('https://items.example/', source_id) else concat('" + schemas.ENDPOINT + "/pictures/', source_id) end"
_CARRIED = f"'2024-01-01T00:00:00Z' as captured_at, {_URL} as source_url, '{schemas.PROVIDER}' as provider, 'CC-BY-4.0' as license_id, 'https://license.example/' as license_url"


@query(f"{_BASE} select {', '.join(_COLUMNS)}, {_CARRIED} from cand")
def json_path_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = survey.survey(fixtures.json_pages(spark, sf_dir), TARGET, limit=None, license_id="CC-BY-4.0", license_url="https://license.example/")
    return found.select(*_COLUMNS, "captured_at", "source_url", "provider", "license_id", "license_url")


@query("select distinct concat('pic-', event_id) as source_id from events")
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = survey.dedupe_first(survey.shredded(fixtures.json_pages(spark, sf_dir), stac.FEATURE_ID))
    return first.select(stac.text_of(F.col("id")).alias("source_id"))


@query(f"{_BASE.replace('from items)', 'from (select * from items order by event_id limit 700))', 1)} select source_id, distance_m from cand")
def limit_before_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.survey(fixtures.json_pages(spark, sf_dir), TARGET, limit=700).select("source_id", "distance_m")


@query(f"{_BASE} select {', '.join(_COLUMNS)}, {_CARRIED} from cand")
def recorded_page_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through files: pages written by tasks and read as recorded pages."""
    pages = recorded.pages(spark, fixtures.page_files(spark, sf_dir))
    found = survey.survey(pages, TARGET, limit=None, license_id="CC-BY-4.0", license_url="https://license.example/")
    return found.select(*_COLUMNS, "captured_at", "source_url", "provider", "license_id", "license_url")


# --- summaries ----------------------------------------------------------------

_CLASSES = "panoramic front lateral rear unknown".split()
_COUNTS = ", ".join(f"count(*) filter (view_class = '{c}') as {c}_count" for c in _CLASSES)


@query(f"{_BASE} select c as view_class, count(source_id) as candidate_count from (values {', '.join(f"('{c}')" for c in _CLASSES)}) v(c) left join cand on view_class = c group by c")
def view_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.view_class_counts(_candidates(spark, sf_dir))


@query(f"{_BASE} select count(*) filter (target_in_fov) as fov_true, count(*) filter (not target_in_fov) as fov_false, count(*) filter (target_in_fov is null) as fov_unknown from cand")
def fov_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.fov_counts(_candidates(spark, sf_dir))


@query(
    f"""{_BASE} select count(*) as candidate_count, count(distinct nullif(sequence_id, '')) as sequence_count,
  count(*) filter (coalesce(sequence_id, '') = '') as unsequenced_count, {_COUNTS}, count(*) filter (target_in_fov) as fov_true,
  count(*) filter (not target_in_fov) as fov_false, count(*) filter (target_in_fov is null) as fov_unknown from cand"""
)
def survey_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.overall(_candidates(spark, sf_dir))


@query(
    f"""{_BASE} select sequence_id, count(*) as candidate_count, min(distance_m) as min_distance_m, {_COUNTS},
  count(*) filter (target_in_fov) as target_in_fov_count from cand where coalesce(sequence_id, '') != '' group by sequence_id"""
)
def sequence_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.ordered_sequences(_candidates(spark, sf_dir))


# --- shortlist and preview ----------------------------------------------------


@query(f"{_SHORT} select cast(rank as int) as rank, tier, source_id, sequence_id, distance_m, view_class, target_in_fov, heading_error_deg from short")
def shortlisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortlist.shortlist(_candidates(spark, sf_dir)).select("rank", "tier", "source_id", "sequence_id", "distance_m", "view_class", "target_in_fov", "heading_error_deg")


@query(f"{_TIERED} select tier, count(*) as candidate_count from tiered where tier is not null group by tier")
def shortlist_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortlist.tiered(_candidates(spark, sf_dir)).groupBy("tier").agg(F.count("*").alias("candidate_count"))


@query(f"{_CAPPED} select source_id, tier from capped")
def shortlist_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortlist.capped(shortlist.tiered(_candidates(spark, sf_dir))).select("source_id", "tier")


_LICENSES = [
    (1, '{"pictures_license":" cc-by ","license_url":"https://l/1"}', '{"links":[{"rel":"license","href":"https://l/2","title":"T"}]}'),
    (2, '{"license":""}', '{"links":[5,{"rel":"self"},{"rel":"license","href":" https://l/2 ","title":"","id":"etalab"}]}'),
    (3, "{}", '{"links":{"rel":"license"}}'),
    (4, '{"license_id":3,"picture_license_url":"https://l/4"}', '{"links":[{"rel":"license","title":5,"id":"x"}]}'),
]


@query("select * from (values (1, 'cc-by', 'https://l/1'), (2, 'etalab', 'https://l/2'), (3, null, null), (4, null, 'https://l/4')) t(n, license_id, license_url)")
def license_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame(_LICENSES, "n int, conf string, landing string")
    return rows.select("n", survey.licenses(F.col("conf"), F.col("landing")).alias("x")).select("n", "x.*")


_T = """case event_id % 6 when 0 then '{"properties":{"geovisio:thumbnail":" https://t/0 "},"assets":{"thumb":{"href":"https://t/x"}}}'
  when 1 then '{"assets":{"z":{"roles":["data"],"href":"https://t/d"},"b":{"roles":["thumbnail"],"href":" "},"c":{"roles":["x","thumbnail"],"href":"https://t/1"},"a":{"roles":["thumbnail"],"href":"https://t/late"}}}'
  when 2 then '{"assets":{"thumb":{"href":"https://t/2"}}}' when 3 then '{"assets":{"thumbnail":{"href":"https://t/3"},"thumb":{"href":"https://t/no"}}}'
  when 4 then '{"assets":{"hd":{"href":"https://t/hd","roles":"thumbnail"}}}' else '{"properties":[],"assets":[]}' end"""


@query(f"select event_id, case event_id % 6 when 0 then 'https://t/0' when 1 then 'https://t/1' when 2 then 'https://t/2' when 3 then 'https://t/3' end as url {_from(_T)}")
def thumbnail_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doc(spark, sf_dir, _T).select("event_id", preview.thumbnail_of(F.col("doc")).alias("url"))


_U = """case event_id % 7 when 0 then 'https://h/x' when 1 then 'http://h' when 2 then 'ftp://h/x' when 3 then 'https:///x' when 4 then 'h/x' when 5 then null else 'HTTPS://h' end"""


@query(f"select event_id, coalesce(regexp_matches(doc, '^(?i:https?)://[^/?#]'), false) as valid {_from(_U)}")
def http_url_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doc(spark, sf_dir, _U).select("event_id", stac.is_http_url(F.col("doc")).alias("valid"))


_C = """case event_id % 6 when 0 then 'image/jpeg' when 1 then ' IMAGE/PNG ; q=1' when 2 then 'image/webp' when 3 then 'image/gif' when 4 then 'image/jpg;x' else '' end"""
_EXT = "case lower(trim(split_part(doc, ';', 1))) when 'image/jpeg' then '.jpg' when 'image/jpg' then '.jpg' when 'image/webp' then '.webp' when 'image/png' then '.png' else '.img' end"


@query(f"select event_id, {_EXT} as extension {_from(_C)}")
def content_type_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doc(spark, sf_dir, _C).select("event_id", stac.extension(F.col("doc")).alias("extension"))


@query(f"select event_id, concat(lpad(cast(event_id % 30 + 1 as varchar), 2, '0'), '_', 'pic-', event_id, 'x_1', {_EXT}) as name {_from(_C)}")
def safe_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _doc(spark, sf_dir, _C)
    ident = F.concat(F.lit("pic-"), F.col("event_id").cast("string"), F.lit("/x.:_ 1"))
    return rows.select("event_id", stac.safe_name((F.col("event_id") % 30 + 1).cast("int"), ident, F.col("doc")).alias("name"))


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shortlist joined to recorded answers that hit every outcome by rank.  The answers name ranks alone, so
    the shortlist is made once."""
    top = shortlist.shortlist(survey.of_pages(fixtures.json_pages(spark, sf_dir), TARGET, limit=None))
    r = F.col("rank") % 6
    answers = spark.range(1, shortlist.MAX_ITEMS + 1, numPartitions=1).select(F.col("id").cast("int").alias("rank")).select(
        "rank",
        F.when(r != 1, F.lit(200)).otherwise(F.lit(404)).alias("item_status"),
        F.when(r == 2, F.lit("[1]")).when(r == 3, F.lit("{}")).otherwise(F.lit('{"properties":{"geovisio:thumbnail":"https://t/1"}}')).alias("item_body"),
        F.lit(200).alias("thumb_status"),
        F.when(r == 4, F.lit("text/html")).otherwise(F.lit("image/jpeg; q=1")).alias("content_type"),
        F.lit(b"12345").alias("content"),
    )
    return preview.judge(top, answers)


@query(f"{_SHORT} select count(*) as selected_count, count(*) filter (rank % 6 in (0, 5)) as downloaded_count, count(*) filter (rank % 6 not in (0, 5)) as failed_count from short")
def manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview.counts(_fetched(spark, sf_dir))


_FAILURE = """case rank % 6 when 1 then 'fetching the item failed: status 404' when 2 then 'the item is no JSON object' when 3 then 'the item names no thumbnail'
  when 4 then 'the thumbnail''s type is no image: ''text/html''' end"""


@query(
    f"""{_SHORT} select cast(rank as int) as rank, source_id, sequence_id, distance_m, view_class, target_in_fov, heading_error_deg, '2024-01-01T00:00:00Z' as captured_at, {_URL} as source_url,
  case when rank % 6 in (0, 5) then 'downloaded' else 'failed' end as status, {_FAILURE} as error, case when rank % 6 in (0, 4, 5) then 'https://t/1' end as thumbnail_url,
  case when rank % 6 in (0, 5) then concat('thumbnails/', lpad(cast(rank as varchar), 2, '0'), '_', source_id, '.jpg') end as local_file,
  cast(case when rank % 6 in (0, 5) then 5 end as bigint) as bytes, case when rank % 6 in (0, 5) then 'image/jpeg' end as content_type from short"""
)
def preview_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fetched(spark, sf_dir).drop("content")


@query(f"{_SHORT} select cast(rank as int) as rank, tier, source_id, sequence_id, distance_m, view_class, target_in_fov, heading_error_deg from short")
def survey_file_shortlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shortlist of a survey in parts: told to files by the tasks, read back by Spark."""
    folder = fixtures.scratch(spark, "survey")
    folder = folder if "://" in folder else f"file://{folder}"
    survey.of_pages(fixtures.json_pages(spark, sf_dir), TARGET, limit=None).write.parquet(f"{folder}/rows")
    rows = survey.ordered(spark.read.parquet(f"{folder}/rows"))
    documents.write_survey(rows, documents.survey_head(rows, TARGET), f"{folder}/document")
    found = recorded.survey_document(spark, f"{folder}/document")
    return shortlist.shortlist(found).select("rank", "tier", "source_id", "sequence_id", "distance_m", "view_class", "target_in_fov", "heading_error_deg")




_PICTURE = """case when rank % 6 in (0, 5) then concat('<img alt="', source_id, '" loading="lazy" src="thumbnails/', lpad(cast(rank as varchar), 2, '0'), '_', source_id, '.jpg">')
  else concat('<div class="missing">', case rank % 6 when 1 then 'fetching the item failed: status 404' when 2 then 'the item is no JSON object' when 3 then 'the item names no thumbnail'
  else 'the thumbnail&#x27;s type is no image: &#x27;text/html&#x27;' end, '</div>') end"""


@query(
    f"""{_SHORT} select cast(rank as int) as rank, concat('<figure>', {_PICTURE}, '<figcaption><b>', rank, '</b> ', view_class, ', ', distance_m, ' m, ',
  case when target_in_fov then 'in view' when not target_in_fov then 'out of view' else 'view unknown' end, '<br>', source_id, ' of ', coalesce(sequence_id, 'no sequence'),
  ' <a rel="noreferrer" href="', {_URL}, '">item</a></figcaption></figure>') as card from short"""
)
def gallery_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview.cards(_fetched(spark, sf_dir))


QUERIES["shortlist"], ORACLES["shortlist"] = QUERIES.pop("shortlisted"), ORACLES.pop("shortlisted")
