"""From provider pages, or typed items, to candidates around a target."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .. import schemas
from ..functions import geo, stac


@dataclass(frozen=True)
class Target:
    """What a survey is centred on."""

    latitude: float
    longitude: float
    radius_m: float

    def __post_init__(self) -> None:
        if not self.radius_m > 0:
            raise ValueError("radius_m must be positive")

    def at(self) -> tuple[Column, Column, Column]:
        return F.lit(float(self.latitude)), F.lit(float(self.longitude)), F.lit(float(self.radius_m))


def positive(**named: int) -> None:
    for name, value in named.items():
        if value <= 0:
            raise ValueError(f"{name} must be positive")


def fence(rows: DataFrame) -> DataFrame:
    """The same rows behind a generator: filters above are not rewritten into the
    long expressions below, which would evaluate those many times over."""
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


#: A place is the page's number with so many bits behind it for the position in the page.
POSITION_BITS = 28


def shredded(pages: DataFrame, feature: StructType = stac.FEATURE, *, carry: tuple[str, ...] = ()) -> DataFrame:
    """(place, *carry, *feature): the objects of each page's feature list, their known keys read in one pass.
    place ascends in page order.  A page without such a list fails the job.  pages: (page_no, body)."""
    number = F.col("page_no")
    listed = stac.feature_list(F.col("body"), feature)
    listed = F.coalesce(listed, F.raise_error(F.concat(F.lit("search page without a feature list: "), number.cast("string"))).cast(ArrayType(feature)))  # named once: it is parsed as often
    rows = pages.select("page_no", *carry, F.posexplode(listed).alias("pos", "f")).where("f is not null")
    return rows.select(_place(number, F.col("pos")).alias("place"), *carry, "f.*")


def _place(number: Column, pos: Column) -> Column:
    fits = number.between(0, (1 << (62 - POSITION_BITS)) - 1) & (pos < 1 << POSITION_BITS)
    return F.when(fits, F.shiftleft(number.cast("long"), POSITION_BITS) + pos).otherwise(F.raise_error(F.lit("page number or feature list out of range")).cast("long"))


def dedupe_key(v: Column) -> Column:
    """The id (a variant) as text for finding duplicates: unstripped, whatever its type; null if it
    is missing, empty, zero or false."""
    return F.when(stac.truthy(v), F.when(stac.kind(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v)))


def first_places(rows: DataFrame) -> DataFrame:
    """(place): where each id occurs first; features without an id have none.  A minimum of whole numbers, so
    it is combined by hashing before the exchange, and nothing but ids and places crosses it."""
    keyed = fence(rows.select(dedupe_key(F.col("id")).alias("dedupe_key"), "place")).where("dedupe_key is not null")
    return keyed.groupBy("dedupe_key").agg(F.min("place").alias("place")).select("place")


def dedupe_first(rows: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """The first feature of each id in page order.  places: where those are, if known from elsewhere.  They are as many
    as the ids, though Spark may reckon them small: never broadcast, as that would pass them all through the driver."""
    return rows.join((first_places(rows) if places is None else places).hint("merge"), "place", "left_semi")


def limit_first(places: DataFrame, limit: int | None) -> DataFrame:
    """The first places in page order, before any other filter; None keeps all."""
    if limit is None:
        return places
    positive(limit=limit)
    return places.orderBy("place").limit(limit)


def licenses(configuration: Column, landing: Column) -> Column:
    """struct<license_id, license_url> from the two JSON documents of a provider: the
    configuration counts first, the landing page's link fills what is missing."""
    conf, page = stac.parse_object(configuration), stac.parse_object(landing)
    link = stac.link_by_rel(stac.get(page, "links"), "license")
    return F.struct(
        F.coalesce(stac.first_text(conf, stac.LICENSE_ID_KEYS), stac.present_text(stac.get(link, "title"), stac.get(link, "id"))).alias("license_id"),
        F.coalesce(stac.first_text(conf, stac.LICENSE_URL_KEYS), stac.text_of(stac.get(link, "href"))).alias("license_url"),
    )


def items(rows: DataFrame, *, endpoint: str = schemas.ENDPOINT, carry: tuple[str, ...] = (), near: Target | None = None) -> DataFrame:
    """Typed items of shredded features; those without a usable id or position go.  near: only those within its
    radius are wanted.  Positions come first, so nothing else of the others is typed."""
    p, coords, kept = F.col("properties"), F.col("coords"), (*carry, "id", "collection", "properties", "assets", "links")
    props = fence(rows.select(*kept, stac.as_list(F.col("geometry.coordinates")).alias("coords")))
    placed = fence(props.select(*kept, stac.coordinate(coords, 1).alias("latitude"), stac.coordinate(coords, 0).alias("longitude"))).where("latitude is not null and longitude is not null")
    if near is not None:
        placed = _within(placed, *near.at()).drop("distance_m")
    named = fence(placed.withColumn("self", stac.link_by_rel(F.col("links"), "self"))).select(
        *carry,
        stac.text_of(F.col("id")).alias("source_id"),
        "latitude",
        "longitude",
        stac.present_text(F.col("collection"), stac.get(p, "collection")).alias("sequence_id"),
        stac.present_text(*[stac.get(p, k) for k in stac.TIME_KEYS]).alias("captured_at"),
        stac.dimensions(p, F.col("assets")).alias("size"),
        stac.heading(p).alias("heading_deg"),
        stac.field_of_view(p).alias("field_of_view_deg"),
        "properties",
        "self",
    )
    return fence(named).select(
        *carry,
        "source_id",
        "latitude",
        "longitude",
        "sequence_id",
        "captured_at",
        F.col("size.width").alias("width"),
        F.col("size.height").alias("height"),
        "heading_deg",
        "field_of_view_deg",
        stac.panoramic(p, F.col("field_of_view_deg")).alias("panoramic"),
        F.when(F.size("self") > 0, stac.text_of(stac.get(F.col("self"), "href"))).otherwise(F.concat(F.lit(endpoint.rstrip("/") + "/pictures/"), F.col("source_id"))).alias("source_url"),
    ).where("source_id is not null")


def _within(rows: DataFrame, latitude: Column, longitude: Column, radius_m: Column) -> DataFrame:
    """Rows within the radius, with their rounded distance."""
    distance = F.round(geo.haversine_m(latitude, longitude, "latitude", "longitude"), 3)
    # NaN passes no comparison in the provider's arithmetic; Spark sorts it last
    return fence(rows.select("*", distance.alias("distance_m"))).where((F.col("distance_m") <= radius_m) & ~F.isnan("distance_m"))


def _judged(rows: DataFrame, latitude: Column, longitude: Column, radius_m: Column, fixed: dict[str, Column]) -> DataFrame:
    """Rows within the radius as candidates, with distance, bearing and view class.  Classes come from
    unrounded angles, the radius test from the rounded distance."""
    bearing = geo.bearing_deg("latitude", "longitude", latitude, longitude)
    within = _within(rows, latitude, longitude, radius_m)
    return _classed(within.select("*", bearing.alias("bearing"), F.when(F.col("heading_deg").isNotNull(), geo.heading_error("heading_deg", bearing)).alias("error")), fixed)


def _classed(measured: DataFrame, fixed: dict[str, Column], carry: tuple[str, ...] = ()) -> DataFrame:
    """Candidates of measured rows, which have distance_m, and bearing and error before rounding."""
    have = set(measured.columns)
    fixed = fixed | {
        "target_bearing_deg": geo.thousandths("bearing"),
        "heading_error_deg": geo.thousandths("error"),
        "target_in_fov": geo.target_in_fov("error", "field_of_view_deg", "panoramic"),
        "view_class": geo.view_class("error", "panoramic"),
    }
    columns = []
    for field in schemas.CANDIDATE:
        if field.name in fixed:
            column = fixed[field.name]
        elif field.name in have:
            column = F.col(field.name)
        else:
            column = F.lit(None)
        columns.append(column.cast(field.dataType).alias(field.name))
    return measured.select(*carry, *columns)


def _provenance(provider: str, license_id: Column | None, license_url: Column | None) -> dict[str, Column]:
    none = F.lit(None).cast("string")
    return {"provider": F.lit(provider), "license_id": none if license_id is None else license_id, "license_url": none if license_url is None else license_url}


def candidates(
    rows: DataFrame,
    target: Target,
    *,
    license_id: Column | None = None,
    license_url: Column | None = None,
    provider: str = schemas.PROVIDER,
    prefilter: bool = False,
) -> DataFrame:
    """Items within the radius of one target (unordered: see ``ordered``).  prefilter adds a box that covers
    the circle, for scans that can push it down."""
    if prefilter:
        rows = rows.where(geo.in_bbox("latitude", "longitude", geo.covering_box(target.latitude, target.longitude, target.radius_m)))
    return _judged(rows, *target.at(), _provenance(provider, license_id, license_url))


def candidates_of_targets(
    rows: DataFrame,
    targets: DataFrame,
    *,
    license_id: Column | None = None,
    license_url: Column | None = None,
    provider: str = schemas.PROVIDER,
) -> DataFrame:
    """(target_id, *candidate): the items within each target's radius.  targets: (target_id, latitude,
    longitude, radius_m); those of a radius that is not positive, or without a position, have none.

    Circles and items meet in the cells of a grid (``geo.cells_of_circle``), by an equi-join that keeps a pair if its chord is
    short enough; only where that cannot tell is the exact distance tested too.  A circle is in some dozens of cells of its
    level, an item in one cell of each level in use, so a pair meets once.  The join shuffles both sides even where one is
    small: its work is the pairs, not the rows.  So whatever one side alone decides, angles' sines among it, is worked out
    before the join, and no pair is made again by a generator.
    Levels in use are whole numbers up to ``geo.FINEST``, so that list is short whatever the number of targets."""
    named = targets.select("target_id", *[_known(F.col(c)).alias(f"target_{c}") for c in ("latitude", "longitude", "radius_m")])
    usable = named.where((F.col("target_radius_m") > 0) & F.col("target_latitude").between(-90, 90) & ~F.isnan("target_longitude") & ~F.isnan("target_radius_m"))
    levels = sorted(r[0] for r in usable.select(geo.level_of_radius("target_radius_m")).distinct().collect()) or [0]
    # A table of targets is small before each is many cells, and may be a single split
    circles = _cells_of_circles(usable.repartition(*named.columns))
    celled = circles.select("*", *_trigonometry("target_"), *[_known(c).alias(f"target_{n}") for n, c in zip(("inner", "outer"), geo.chords_of_radius("target_radius_m"))])
    rows = rows.select(*[c for c in rows.columns if c in schemas.CANDIDATE.names]).withColumns({c: _known(F.col(c)) for c in ("latitude", "longitude")})
    # A row for each level before its cell is reckoned: cells of all levels at once are too long an expression to be compiled
    leveled = rows.select("*", F.explode(F.array(*map(F.lit, levels))).alias("level"))
    cell = F.coalesce(geo.cell_of_point("latitude", "longitude", F.col("level")), F.lit(-1))
    placed = leveled.select(*rows.columns, cell.alias("item_cell"), *_trigonometry("", "item_"), geo.floor_mod("heading_deg", geo.FULL_CIRCLE).alias("item_heading"))
    both = placed.hint("merge").join(celled, (F.col("item_cell") == F.col("cell")) & _near())
    # Step by step, so that each number is worked out once for a pair
    pair = both.select(*rows.columns, "target_id", "item_heading", _pair_distance().alias("distance"), _pair_direction().alias("direction"))
    turned = pair.select("*", geo.once_around("direction").alias("bearing")).select("*", (F.col("item_heading") - F.col("bearing") + 180.0).alias("swing"))
    measured = turned.select(*rows.columns, "target_id", geo.thousandths("distance").alias("distance_m"), "bearing", F.abs(geo.once_around("swing") - 180.0).alias("error"))
    return _classed(measured, _provenance(provider, license_id, license_url), ("target_id",))


def _cells_of_circles(targets: DataFrame) -> DataFrame:
    """A row for each cell of ``geo.cells_of_circle``, row by row of the grid: nested arrays of cells would not be compiled."""
    circle = tuple(F.col(f"target_{n}") for n in ("latitude", "longitude", "radius_m"))
    level, row, columns = F.col("level"), F.col("row"), F.col("columns")
    rows = targets.withColumn("level", geo.level_of_radius(circle[2])).select("*", F.explode_outer(geo.rows_of_circle(*circle, level)).alias("row"))
    spans = rows.select("*", geo.columns_of_row(row, level).alias("columns"))
    cells = spans.select("*", F.explode_outer(geo.span_of_circle(*circle, columns)).alias("column"))
    return cells.select(*targets.columns, geo.cell(level, row, columns, F.col("column")).alias("cell"))


def _known(number: Column) -> Column:
    """A number that is NaN, which is near nothing, where it is missing; so nothing reckoned from it is checked for null
    once more for each pair, which would make the loop over pairs too long to be compiled."""
    return F.coalesce(number.cast("double"), F.lit(float("nan")))


def _trigonometry(of: str, to: str | None = None) -> list[Column]:
    """What pairs need of each side's place: its point of the unit sphere and the cosine of its latitude."""
    vector = zip("xyz", geo.unit_vector(f"{of}latitude", f"{of}longitude"))
    return [_known(c).alias(f"{of if to is None else to}{n}") for n, c in (*vector, ("cos", F.cos(F.radians(f"{of}latitude"))))]


def _chord() -> Column:
    """The square of a pair's chord on the unit sphere."""
    apart = [F.col(f"item_{n}") - F.col(f"target_{n}") for n in "xyz"]
    return sum((d * d for d in apart[1:]), apart[0] * apart[0])


def _pair_distance() -> Column:
    return geo.haversine_m("target_latitude", "target_longitude", "latitude", "longitude", cosines=(F.col("target_cos"), F.col("item_cos")))


def _pair_direction() -> Column:
    ends = ((F.col("item_z"), F.col("item_cos")), (F.col("target_z"), F.col("target_cos")))
    return geo.direction_deg("latitude", "longitude", "target_latitude", "target_longitude", sines_cosines=ends)


def _near() -> Column:
    """Whether an item is within the radius of a target, by its rounded distance: told from the chord, but for
    those about a radius away."""
    exact = F.round(_pair_distance(), 3) <= F.col("target_radius_m")
    return (_chord() <= F.col("target_outer")) & ((_chord() <= F.col("target_inner")) | exact)


def ordered(rows: DataFrame) -> DataFrame:
    return rows.orderBy("distance_m", "source_id")


def around(pictures: DataFrame, target: Target, *, limit: int | None = 2000, box: tuple[float, float, float, float] | None = None, endpoint: str = schemas.ENDPOINT, license_id: str | None = None, license_url: str | None = None) -> DataFrame:
    """Ordered candidates of searched pictures (page_no, pos, longitude, latitude, feature), a row for each feature.
    Its box, the provider's search box unless another is given, is a plain filter on their position: a source that
    takes filters asks for no more than that."""
    within = pictures.where(geo.in_bbox("latitude", "longitude", box or geo.bbox_for_radius(target.latitude, target.longitude, target.radius_m)))
    rows = fence(within.select(_place(F.col("page_no"), F.col("pos")).alias("place"), F.from_json("feature", stac.FEATURE).alias("f"))).select("place", "f.*")
    first = dedupe_first(rows, limit_first(first_places(rows), limit))
    return ordered(candidates(items(first, endpoint=endpoint), target, license_id=F.lit(license_id), license_url=F.lit(license_url)))


def of_pages(pages: DataFrame, target: Target, *, limit: int | None = 2000, endpoint: str = schemas.ENDPOINT, license_id: str | None = None, license_url: str | None = None) -> DataFrame:
    """Candidates of recorded search pages (page_no, body), unordered.  First places are found by ids alone;
    features meet them as typed rows, and only those within the radius."""
    places = limit_first(first_places(shredded(pages, stac.FEATURE_ID)), limit)
    first = dedupe_first(items(shredded(pages), endpoint=endpoint, carry=("place",), near=target), places)
    return candidates(first, target, license_id=F.lit(license_id), license_url=F.lit(license_url))


def survey(pages: DataFrame, target: Target, **named) -> DataFrame:
    """The same, ordered.  Sorting samples the rows first, so the pages are read once more: where another order
    follows, as in a shortlist, take ``of_pages``."""
    return ordered(of_pages(pages, target, **named))
