import pytest
from pyspark.sql import functions as F

from kerbsight.functions import stac
from kerbsight.operators import preview, survey


def value(spark, doc, f):
    return spark.createDataFrame([(doc,)], "d string").select(f(F.col("d")).alias("v")).first().v


def prop(f, key="v"):
    return lambda d: f(stac.get(stac.parse_object(d), key))


@pytest.mark.parametrize(
    ("doc", "text", "number"),
    [
        ('{"v":" a "}', "a", None),
        ('{"v":" \\t"}', None, None),
        ('{"v":5}', None, 5.0),
        ('{"v":5.25}', None, 5.25),
        ('{"v":true}', None, 1.0),
        ('{"v":false}', None, 0.0),
        ('{"v":"9"}', "9", None),
        ('{"v":null}', None, None),
        ('{"v":{}}', None, None),
        ('{"v":[1]}', None, None),
        ("{}", None, None),
        ("not json", None, None),
        (None, None, None),
        ('{"v":1,"v":2}', None, 1.0),  # of repeated keys the first counts
    ],
)
def test_types(spark, doc, text, number):
    assert value(spark, doc, prop(stac.text_of)) == text
    assert value(spark, doc, prop(stac.number_of)) == number


def test_presence_blocks_the_next_value(spark):
    f = lambda d: stac.present_text(stac.get(stac.parse_object(d), "a"), stac.get(stac.parse_object(d), "b"))
    assert value(spark, '{"a":"","b":"x"}', f) == "x"
    assert value(spark, '{"a":0,"b":"x"}', f) == "x"
    assert value(spark, '{"a":[],"b":"x"}', f) == "x"
    assert value(spark, '{"a":"  ","b":"x"}', f) is None
    assert value(spark, '{"a":5,"b":"x"}', f) is None


def test_link(spark):
    f = lambda d: stac.get(stac.link_by_rel(stac.get(stac.parse_object(d), "links"), "self"), "href")
    g = lambda d: stac.text_of(f(d))
    assert value(spark, '{"links":[3,{"rel":"x","href":"0"},{"rel":"self","href":" 1 "},{"rel":"self","href":"2"}]}', g) == "1"
    assert value(spark, '{"links":{"rel":"self","href":"1"}}', g) is None


@pytest.mark.parametrize(
    ("doc", "want"),
    [
        ('{"panoramic":false,"view:fov":360}', False),
        ('{"panoramic":"true","view:type":"EquiRectangular"}', True),
        ('{"view:type":"flat","view:fov":360}', False),
        ('{"view:type":"other","view:fov":359}', True),
        ('{"view:fov":358.9}', None),
        ("{}", None),
    ],
)
def test_panoramic(spark, doc, want):
    f = lambda d: stac.panoramic(stac.parse_object(d), stac.field_of_view(stac.parse_object(d)))
    assert value(spark, doc, f) == want


def feature(extra="", ident='"a"', lon="6.0984374", lat="45.9086611"):
    return f'{{"id":{ident},"geometry":{{"coordinates":[{lon},{lat}]}}{extra}}}'


def items_of(spark, *features):
    page = spark.createDataFrame([(0, '{"features":[' + ",".join(features) + "]}")], "page_no long, body string")
    return survey.items(survey.shredded(page), endpoint="https://e/").collect()


def test_items(spark):
    (r,) = items_of(spark, feature(',"collection":" c ","properties":{"heading":-10,"created":"t"},"assets":{"z":{"width":3,"height":4},"a":{"width":5,"height":6}}'))
    assert (r.source_id, r.sequence_id, r.heading_deg, r.captured_at, r.width, r.height) == ("a", "c", 350.0, "t", 3, 4)
    assert r.source_url == "https://e/pictures/a"
    (r,) = items_of(spark, feature(',"links":[{"rel":"self","href":5}],"properties":5', ident='" a "', lon='"6.5"', lat="true"))
    assert (r.source_id, r.source_url, r.longitude, r.latitude) == ("a", None, 6.5, 1.0)
    assert items_of(spark, feature(ident="7"), feature(lon='"x"'), '{"id":"q"}', feature(lon="null")) == []


def test_pages_dedupe_and_limit(spark):
    body = lambda *f: '{"features":[' + ",".join(f) + "]}"
    far = feature(lon="7.5")
    pages = spark.createDataFrame([(0, body(far, '5', '"x"', feature(ident='"b"'))), (1, body(feature(), feature(ident='" b"'), feature(ident="7"), feature(ident='""')))], "page_no long, body string")
    first = survey.dedupe_first(survey.shredded(pages)).orderBy("place").collect()
    assert [divmod(r.place, 1 << survey.POSITION_BITS) for r in first] == [(0, 0), (0, 3), (1, 1), (1, 2)]
    target = survey.Target(45.9086611, 6.0984374, 100.0)
    assert survey.survey(pages, target, limit=1).count() == 0  # the limit comes before the radius
    found = survey.survey(pages, target)
    assert [r.source_id for r in found.collect()] == ["b", "b"]
    assert found.schema.names[0] == "provider" and found.first().distance_m == 0.0


@pytest.mark.parametrize("schema", [stac.FEATURE, stac.FEATURE_ID])
@pytest.mark.parametrize("body", ['{"features":{}}', '{"features":5}', '{"features":null}', "{}", "[]", "5", "{", None])
def test_page_without_features_fails(spark, body, schema):
    with pytest.raises(Exception, match="without a feature list"):
        survey.shredded(spark.createDataFrame([(0, body)], "page_no long, body string"), schema).collect()


def test_shredding_keeps_what_it_can(spark):
    """Items of other types than objects are left out, whatever stands beside them; a part of another
    type than expected is missing; a repeated key counts as it comes last."""
    odd = ['5', "null", "[1]", '"x"', "{}", '{"id":"a","properties":[1],"geometry":5,"assets":7,"links":"l"}', '{"id":"b","id":"c","properties":{"view:fov":"x","heading":true,"unknown":{"deep":[1]}},"geometry":{"coordinates":[1,2]}}']
    body = '{"type":"FeatureCollection","features":[' + ",".join(odd) + '],"links":[]}'
    rows = survey.shredded(spark.createDataFrame([(3, body)], "page_no long, body string")).orderBy("place").collect()
    assert [r.place & 7 for r in rows] == [4, 5, 6] and [r.id.toPython() if r.id else None for r in rows] == [None, "a", "c"]
    assert rows[1].properties is None and rows[1].assets is None and rows[2].properties["heading"].toPython() is True
    with pytest.raises(Exception, match="out of range"):
        survey.shredded(spark.createDataFrame([(-1, body)], "page_no long, body string")).collect()


def test_first_places_combine_by_hashing(spark):
    pages = spark.createDataFrame([(0, '{"features":[]}')], "page_no long, body string")
    plan = survey.survey(pages, survey.Target(45.0, 6.0, 10.0), limit=None)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "LeftSemi" in plan
    # Only ids are read for them, and what is not within the radius goes before the join
    narrow = [x for x in plan.split("\n") if "from_json" in x and "features,ArrayType(StructType(StructField(id,VariantType,true)),true)" in x]
    assert narrow and plan.index("distance_m") < plan.rindex("Exchange")


def test_thumbnail_needs_an_advertised_one(spark):
    assert value(spark, '{"assets":{"b":{"roles":["thumbnail"],"href":"u1"},"a":{"roles":["thumbnail"],"href":"u2"}}}', preview.thumbnail_of) == "u1"
    assert value(spark, '{"assets":{"hd":{"href":"u"}}}', preview.thumbnail_of) is None
    assert value(spark, '{"properties":{"geovisio:thumbnail":" u "},"assets":{"thumb":{"href":"v"}}}', preview.thumbnail_of) == "u"


def test_escape(spark):
    assert value(spark, "<a href=\"x\">&'", stac.escape_html) == "&lt;a href=&quot;x&quot;&gt;&amp;&#x27;"
