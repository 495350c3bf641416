"""Loosely typed picture items (JSON) as native columns.

Objects are read as map<string, variant>, which keeps both the order of keys and the
type of each value; a value counts only if it has the type that is asked for.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType, VariantType

OBJECT = "map<string,variant>"

# Property names of the picture catalogues, in order of preference.
HEADING_KEYS = ("view:azimuth", "pers:heading", "panoramax:heading", "heading")
FOV_KEYS = ("view:fov", "pers:horizontal_fov", "panoramax:horizontal_fov", "field_of_view")
FOV_PARENT, FOV_NESTED_KEYS = "pers:interior_orientation", ("field_of_view", "horizontal_fov")
PANORAMIC_KEYS = ("panoramax:is_panoramic", "is_panoramic", "panoramic")
ROUND_TYPES = ("equirectangular", "spherical", "panorama", "360")
FLAT_TYPES = ("perspective", "rectilinear", "flat")
TIME_KEYS = ("datetime", "datetimetz", "created")
LICENSE_ID_KEYS = ("pictures_license", "picture_license", "license", "license_id")
LICENSE_URL_KEYS = ("pictures_license_url", "picture_license_url", "license_url")
PANORAMIC_FOV = 359.0
OTHER_KEYS = ("collection", "view:type", "proj:shape", "geovisio:image")
EXTENSIONS = {"image/jpeg": ".jpg", "image/jpg": ".jpg", "image/webp": ".webp", "image/png": ".png"}


def _variants(*names: str) -> StructType:
    return StructType([StructField(n, VariantType()) for n in names])


#: What is read of a feature, in one pass: the known keys alone, each with the type that it has.  A repeated
#: key counts as it comes last.  Assets keep their order.
FEATURE = StructType(
    [StructField(n, VariantType()) for n in ("id", "collection", "links")]
    + [
        StructField("geometry", _variants("coordinates")),
        StructField("properties", _variants(*HEADING_KEYS, *FOV_KEYS, FOV_PARENT, *PANORAMIC_KEYS, *TIME_KEYS, *OTHER_KEYS)),
        StructField("assets", MapType(StringType(), VariantType())),
    ]
)
FEATURE_ID = _variants("id")


def feature_list(body: Column, feature: StructType = FEATURE) -> Column:
    """The feature list of a search page, each item read as ``feature``; null if there is no such list.
    An item that is no object is null.  Such an item makes Spark give up the list, so then, and only
    then, the page is read again item by item."""
    listed = lambda kind: F.from_json(body, f"features array<{kind}>").features
    known = F.from_json(body, StructType([StructField("features", ArrayType(feature))])).features
    item = lambda text, v: F.when(F.when(v.isNotNull(), is_object(v)).otherwise(text.startswith("{")), F.from_json(text, feature))
    return F.coalesce(known, F.zip_with(listed("string"), F.coalesce(listed("variant"), F.array().cast("array<variant>")), item))


def parse_object(text: Column) -> Column:
    """A JSON text as an object; null for anything else."""
    return F.from_json(text, OBJECT)


def kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_object(v: Column) -> Column:
    return as_object(v).isNotNull()


def as_object(v: Column) -> Column:
    """A variant object as a map; null if it is none.  Keys come sorted: where their
    order matters, parse the text with parse_object instead."""
    return F.try_variant_get(v, "$", OBJECT)


def as_list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def get(obj: Column, key: str) -> Column:
    """A key of a map, or of a struct that names it; null if it is missing."""
    return obj.getItem(key)


def strip(text: Column) -> Column:
    """Without white space (Unicode's) at either end."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f\x85]+|[\s\x1c-\x1f\x85]+$", "")


def text_of(v: Column) -> Column:
    """A string value that isn't blank, stripped; other types are null."""
    return F.when(kind(v) == "STRING", F.nullif(strip(F.try_variant_get(v, "$", "string")), F.lit("")))


def first_text(obj: Column, keys) -> Column:
    return F.coalesce(*[text_of(get(obj, k)) for k in keys])


def number_of(v: Column) -> Column:
    """A number as double; booleans count as 1 and 0, numeric strings do not count.  As JSON text, a value
    tells its kind by itself: a string has quotes, so it is no number."""
    text = F.to_json(v)
    return F.coalesce(text.try_cast("double"), text.try_cast("boolean").cast("double"))


def first_number(obj: Column, keys) -> Column:
    return F.coalesce(*[number_of(get(obj, k)) for k in keys])


def truthy(v: Column) -> Column:
    """Whether a value counts as present: not missing, null, false, zero or empty."""
    empty = F.to_json(v).rlike(r'^(null|false|""|\[\]|\{\}|-?0(\.0+)?([eE][+-]?\d+)?)$')
    return ~F.coalesce(empty, F.lit(True))


def present_text(*values: Column) -> Column:
    """The text of the first present value, even if that value is no usable text."""
    out = text_of(values[-1])
    for v in reversed(values[:-1]):
        out = F.when(truthy(v), text_of(v)).otherwise(out)
    return out


def link_by_rel(links: Column, rel: str) -> Column:
    """The first object of a list whose rel is the one asked for, as a map."""
    match = F.filter(as_list(links), lambda x: F.to_json(F.try_variant_get(x, "$.rel", "variant")) == json.dumps(rel))
    return as_object(F.get(match, 0))


def field_of_view(props: Column) -> Column:
    return F.coalesce(first_number(props, FOV_KEYS), first_number(as_object(get(props, FOV_PARENT)), FOV_NESTED_KEYS))


def heading(props: Column) -> Column:
    return F.pmod(first_number(props, HEADING_KEYS), F.lit(360.0))


def panoramic_from_fov(fov: Column) -> Column:
    return F.when(~F.isnan(fov) & (fov >= PANORAMIC_FOV), True)


def panoramic(props: Column, fov: Column) -> Column:
    """Explicit flags first, then the view type, then a field of view of 359 or more."""
    flags = [F.when(kind(get(props, k)) == "BOOLEAN", F.try_variant_get(get(props, k), "$", "boolean")) for k in PANORAMIC_KEYS]
    v = get(props, "view:type")
    named = F.when(kind(v) == "STRING", F.lower(F.try_variant_get(v, "$", "string")))
    by_type = F.when(named.isin(*ROUND_TYPES), True).when(named.isin(*FLAT_TYPES), False)
    return F.coalesce(*flags, by_type, panoramic_from_fov(fov))


def _whole(v: Column) -> Column:
    """An integer value (booleans included) as bigint; null for other types."""
    text = F.to_json(v)
    return F.coalesce(text.try_cast("bigint"), text.try_cast("boolean").cast("bigint"))


def _coerced(v: Column) -> Column:
    """A value turned into an integer: numbers truncated, integer strings read."""
    digits = strip(F.try_variant_get(v, "$", "string"))
    spelled = F.when(digits.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$") & (kind(v) == "STRING"), F.regexp_replace(digits, "_", "").try_cast("bigint"))
    return F.coalesce(_whole(v), F.to_json(v).try_cast("double").try_cast("bigint"), spelled)


def _pair(w: Column, h: Column) -> Column:
    return F.when(w.isNotNull() & h.isNotNull(), F.struct(w.alias("width"), h.alias("height")))


def dimensions(props: Column, assets: Column) -> Column:
    """struct<width, height>: from the projected shape [h, w], the image's own size,
    or the first asset (in document order) with whole numbers for both."""
    shape = as_list(get(props, "proj:shape"))
    by_shape = _pair(_coerced(F.get(shape, 1)), _coerced(F.get(shape, 0)))
    size = lambda v: _pair(_whole(F.try_variant_get(v, "$.width", "variant")), _whole(F.try_variant_get(v, "$.height", "variant")))
    by_image, sizes = size(get(props, "geovisio:image")), F.transform(F.map_values(assets), size)
    by_asset = F.get(F.filter(sizes, lambda x: x.isNotNull()), 0)
    return F.coalesce(by_shape, by_image, by_asset)


def coordinate(coords: Column, at: int) -> Column:
    """A coordinate as double: numbers, booleans, and strings that spell a number."""
    v = F.get(coords, at)
    spelled = F.when(kind(v) == "STRING", F.regexp_replace(strip(F.try_variant_get(v, "$", "string")), r"(?<=[0-9])_(?=[0-9])", "").try_cast("double"))
    return F.coalesce(number_of(v), spelled)


def thumbnail_url(props: Column, assets: Column) -> Column:
    """Only an advertised thumbnail: the property, an asset with that role (in
    document order), or an asset of that name."""
    href = lambda a: text_of(F.try_variant_get(a, "$.href", "variant"))
    role = lambda a: F.exists(F.coalesce(as_list(F.try_variant_get(a, "$.roles", "variant")), F.array().cast("array<variant>")), lambda r: F.coalesce((kind(r) == "STRING") & (F.try_variant_get(r, "$", "string") == "thumbnail"), F.lit(False)))
    by_role = F.get(F.filter(F.transform(F.map_values(assets), lambda a: F.when(is_object(a) & role(a), href(a))), lambda x: x.isNotNull()), 0)
    named = [F.when(is_object(get(assets, k)), href(get(assets, k))) for k in ("thumbnail", "thumb")]
    return F.coalesce(text_of(get(props, "geovisio:thumbnail")), by_role, *named)


def is_http_url(url: Column) -> Column:
    """http or https with a host; null is false."""
    return F.coalesce(F.regexp_like(url, F.lit(r"^(?i:https?)://[^/?#]")), F.lit(False))


def content_type_name(content_type: Column) -> Column:
    return strip(F.split_part(content_type, F.lit(";"), F.lit(1)))


def extension(content_type: Column) -> Column:
    name = F.lower(content_type_name(content_type))
    out = F.lit(".img")
    for k, v in EXTENSIONS.items():
        out = F.when(name == k, v).otherwise(out)
    return out


def safe_name(rank: Column, source_id: Column, content_type: Column) -> Column:
    """rank (two digits), the letters, digits, - and _ of the id, and the extension."""
    ident = F.when(F.coalesce(source_id, F.lit("")) == "", F.concat(F.lit("rank-"), rank.cast("string"))).otherwise(source_id)
    return F.format_string("%02d_%s%s", rank, F.regexp_replace(ident, r"[^\p{L}\p{N}_-]", ""), extension(content_type))


def escape_html(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text
