import math

import pytest
from pyspark.sql import functions as F

from kerbsight.functions import geo


def one(spark, **cols):
    return spark.range(1).select(*[v.alias(k) for k, v in cols.items()]).first()


def test_distance_and_bearing(spark):
    r = one(spark, zero=geo.haversine_m(45.0, 6.0, 45.0, 6.0), degree=geo.haversine_m(0.0, 0.0, 0.0, 1.0), north=geo.bearing_deg(0.0, 0.0, 1.0, 0.0), east=geo.bearing_deg(0.0, 0.0, 0.0, 1.0), west=geo.bearing_deg(0.0, 0.0, 0.0, -1.0))
    assert r.zero == 0.0
    assert r.degree == pytest.approx(geo.EARTH_RADIUS_M * math.pi / 180)
    assert (r.north, r.east, r.west) == (0.0, 90.0, 270.0)


def test_angles(spark):
    rows = spark.createDataFrame([(359.0, 1.0, 2.0), (10.0, 190.0, 180.0), (-350.0, 10.0, 0.0)], "a double, b double, want double")
    assert all(r.got == r.want for r in rows.select("want", geo.angle_between_deg("a", "b").alias("got")).collect())
    assert one(spark, x=geo.floor_mod(-10.0, 360.0)).x == 350.0


@pytest.mark.parametrize(
    ("error", "fov", "pano", "want"),
    [
        (45.0, 90.0, None, ("front", True)),
        (45.1, 90.0, False, ("lateral", False)),
        (134.9, None, None, ("lateral", None)),
        (135.0, 270.0, None, ("rear", True)),
        (10.0, 0.0, None, ("front", None)),
        (10.0, float("nan"), None, ("front", None)),
        (180.0, 999.0, None, ("rear", True)),
        (None, 90.0, None, ("unknown", None)),
        (None, None, True, ("panoramic", True)),
        (170.0, 10.0, True, ("panoramic", True)),
        (float("nan"), 90.0, None, ("rear", False)),
    ],
)
def test_view(spark, error, fov, pano, want):
    row = spark.createDataFrame([(error, fov, pano)], "e double, f double, p boolean")
    r = row.select(geo.view_class("e", "p").alias("c"), geo.target_in_fov("e", "f", "p").alias("t")).first()
    assert (r.c, r.t) == want


def test_boxes():
    w, s, e, n = geo.bbox_for_radius(0.0, 0.0, 111_320.0)
    assert (w, s, e, n) == pytest.approx((-1, -1, 1, 1))
    assert geo.covering_box(89.9999, 0.0, 500.0)[::2] == (-180.0, 180.0)
    assert geo.covering_box(0.0, 179.9999, 500.0)[::2] == (-180.0, 180.0)


@pytest.mark.parametrize(("lat", "radius"), [(0.0, 500.0), (45.9, 500.0), (60.0, 2_000_000.0), (-80.0, 900_000.0)])
def test_covering_box_holds_the_circle(spark, lat, radius):
    reach = radius / geo.EARTH_RADIUS_M
    w, s, e, n = geo.covering_box(lat, 10.0, radius)
    for k in range(72):
        b = math.radians(5 * k)
        p = math.asin(math.sin(math.radians(lat)) * math.cos(reach) + math.cos(math.radians(lat)) * math.sin(reach) * math.cos(b))
        x = math.radians(10) + math.atan2(math.sin(b) * math.sin(reach) * math.cos(math.radians(lat)), math.cos(reach) - math.sin(math.radians(lat)) * math.sin(p))
        assert s <= math.degrees(p) <= n
        assert w <= math.degrees(x) <= e or (w, e) == (-180.0, 180.0)


def test_expressions_stay_native(spark):
    plan = spark.range(3).select(geo.haversine_m(1.0, 2.0, F.col("id"), F.col("id")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "*(1)" in plan


def test_thousandths_are_rounded_numbers(spark):
    rows = spark.range(200_000).select((F.col("id") / 2000.0).alias("x")).union(spark.range(20_000).select((F.rand(3) * 400.0).alias("x"))).union(spark.range(20_000).select((F.rand(4) * 2e7).alias("x")))
    ties = rows.union(spark.createDataFrame([(0.0,), (1.0005,), (2.0005,), (359.9995,), (0.0004999999999999999,), (20015114.3525,), (float("nan"),), (None,)], "x double"))
    assert ties.where(~geo.thousandths("x").eqNullSafe(F.round("x", 3))).isEmpty()


def test_once_around_is_the_remainder(spark):
    rows = spark.createDataFrame([(x,) for x in (-359.5, -0.25, 0.0, 12.5, 359.75, 360.0, 540.0, 719.5, float("nan"), None)], "x double")
    assert rows.where(~geo.once_around("x").eqNullSafe(geo.floor_mod("x", 360.0))).isEmpty()
