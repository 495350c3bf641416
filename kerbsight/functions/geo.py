"""Spherical geometry as native columns: distance, bearing, view classification."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_008.8
METRES_PER_DEGREE = 111_320.0
FRONT_DEG, REAR_DEG = 45.0, 135.0
FULL_CIRCLE = 360.0


def _col(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(float(x))


def haversine_m(lat1, lon1, lat2, lon2, *, cosines: tuple[Column, Column] | None = None) -> Column:
    """Great-circle distance in metres on the mean sphere.  cosines: those of the latitudes, if at hand."""
    lat1, lon1, lat2, lon2 = map(_col, (lat1, lon1, lat2, lon2))
    cos1, cos2 = cosines or (F.cos(F.radians(lat1)), F.cos(F.radians(lat2)))
    north, east = F.sin(F.radians(lat2 - lat1) * 0.5), F.sin(F.radians(lon2 - lon1) * 0.5)
    chord = north * north + cos1 * cos2 * east * east
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(chord))


def floor_mod(x, m: float) -> Column:
    """Remainder with the sign of the divisor."""
    return F.pmod(_col(x), F.lit(m))


def once_around(x) -> Column:
    """An angle of more than minus one turn and less than two, in [0, 360): ``floor_mod`` without a division."""
    x = _col(x)
    return F.when(x >= FULL_CIRCLE, x - FULL_CIRCLE).when(x < 0, x + FULL_CIRCLE).otherwise(x)


def thousandths(x) -> Column:
    """``round(x, 3)`` of a number from 0 to 10 ** 9: the same result, without decimal arithmetic but for numbers about
    half-way between two thousandths."""
    x = _col(x)
    nearest = F.rint(x * 1000.0)
    return F.when(F.abs(x * 1000.0 - nearest) < 0.4999, nearest / 1000.0).otherwise(F.round(x, 3))


def direction_deg(lat1, lon1, lat2, lon2, *, sines_cosines: tuple[tuple[Column, Column], tuple[Column, Column]] | None = None) -> Column:
    """Initial bearing from the first point to the second, and half a turn to one and a half: [180, 540].
    sines_cosines: those of the latitudes, if at hand."""
    p1, p2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    (sin1, cos1), (sin2, cos2) = sines_cosines or ((F.sin(p1), F.cos(p1)), (F.sin(p2), F.cos(p2)))
    turn = F.radians(_col(lon2) - _col(lon1))
    east = F.sin(turn) * cos2
    north = cos1 * sin2 - sin1 * cos2 * F.cos(turn)
    return F.degrees(F.atan2(east, north)) + FULL_CIRCLE


def bearing_deg(lat1, lon1, lat2, lon2) -> Column:
    """Initial bearing from the first point to the second, in [0, 360)."""
    return floor_mod(direction_deg(lat1, lon1, lat2, lon2), FULL_CIRCLE)


def angle_between_deg(a, b) -> Column:
    """Smallest unsigned difference of two directions, in [0, 180]."""
    return F.abs(floor_mod(_col(a) - _col(b) + 180.0, FULL_CIRCLE) - 180.0)


def heading_error(heading, bearing) -> Column:
    return angle_between_deg(floor_mod(heading, FULL_CIRCLE), bearing)


def view_class(error, panoramic) -> Column:
    """Class of a view from its unrounded heading error; panoramas come first."""
    error, panoramic = _col(error), _col(panoramic)
    return (
        F.when(panoramic, "panoramic").when(error.isNull(), "unknown").when(error <= FRONT_DEG, "front").when(error < REAR_DEG, "lateral").otherwise("rear")
    )


def target_in_fov(error, fov, panoramic) -> Column:
    """Whether the target lies in the field of view; null where that is unknown.
    NaN is no field of view here, though Spark orders it above every number."""
    error, fov, panoramic = _col(error), _col(fov), _col(panoramic)
    usable = error.isNotNull() & ~F.isnan(fov) & (fov > 0)
    return F.when(panoramic, True).when(usable, error <= F.least(fov, F.lit(FULL_CIRCLE)) / 2)


def bbox_for_radius(latitude: float, longitude: float, radius_m: float) -> tuple[float, float, float, float]:
    """(west, south, east, north) of the provider's search box.  It is slightly
    smaller than the circle and neither wraps at the antimeridian nor at the poles."""
    half = radius_m / METRES_PER_DEGREE
    across = half / max(math.cos(math.radians(latitude)), 1e-6)
    return longitude - across, latitude - half, longitude + across, latitude + half


def in_bbox(lat, lon, box: tuple[float, float, float, float]) -> Column:
    west, south, east, north = box
    return _col(lon).between(west, east) & _col(lat).between(south, north)


def covering_box(latitude: float, longitude: float, radius_m: float) -> tuple[float, float, float, float]:
    """A box that holds the whole circle, to push to a scan before the exact test;
    at the poles, or around them, it spans all longitudes."""
    reach = radius_m / EARTH_RADIUS_M * (1 + 1e-9)
    half = math.degrees(reach)
    south, north = latitude - half, latitude + half
    if south <= -90 or north >= 90 or reach >= math.pi / 2:
        return -180.0, max(south, -90.0), 180.0, min(north, 90.0)
    across = math.degrees(math.asin(min(1.0, math.sin(reach) / math.cos(math.radians(latitude)))))
    if longitude - across < -180 or longitude + across > 180:
        return -180.0, south, 180.0, north
    return longitude - across, south, longitude + across, north


#: The finest grid has 2 ** FINEST cells around the equator, of about 2.4 metres.
FINEST = 24


#: Cells are at most a circle's width high, halved so many times: the finer they are, the fewer points share a cell
#: with a circle that they are not in, and the more cells a circle has.
HALVED = 2


def level_of_radius(radius_m) -> Column:
    """The level of a circle's cells, of 2 ** level cells around the equator: between a quarter of its width and half of that high."""
    cells = F.lit(math.pi * EARTH_RADIUS_M * 2**HALVED) / F.greatest(_col(radius_m), F.lit(1e-3))
    return F.greatest(F.lit(0), F.least(F.lit(FINEST), F.floor(F.log2(cells)).cast("int")))


def _cells_around(level: Column) -> Column:
    """Cells of a level around the equator."""
    return F.call_function("shiftleft", F.lit(1), level).cast("double")


def _row_of(latitude: Column, level: Column) -> Column:
    """Rows of a level from the south pole up, each 360 / 2 ** level degrees high."""
    return F.floor((latitude + 90.0) / 360.0 * _cells_around(level)).cast("long")


def columns_of_row(row: Column, level: Column) -> Column:
    """Cells of a row: fewer towards the poles, so that none is much narrower than high."""
    height = F.lit(360.0) / _cells_around(level)
    south, north = row * height - 90.0, (row + 1) * height - 90.0
    widest = F.when(south * north <= 0, 0.0).otherwise(F.least(F.abs(south), F.abs(north)))
    return F.greatest(F.lit(1), F.floor(F.cos(F.radians(F.least(widest, F.lit(90.0)))) * _cells_around(level))).cast("long")


def _column_at(longitude: Column, columns: Column) -> Column:
    return F.floor((longitude + 180.0) / 360.0 * columns).cast("long")


def cell(level: Column, row: Column, columns: Column, column: Column) -> Column:
    """One whole number for a cell: rows and columns of a level are at most 2 ** FINEST.  Longitudes wrap around."""
    return F.shiftleft(F.shiftleft(level.cast("long"), FINEST) + row, FINEST) + F.pmod(column, columns)


def cell_of_point(latitude, longitude, level) -> Column:
    """The cell of a point."""
    latitude, longitude, level = _col(latitude), _col(longitude), F.lit(level).cast("int")
    row = _row_of(latitude, level)
    columns = columns_of_row(row, level)
    return cell(level, row, columns, _column_at(longitude, columns))


def _reach(radius_m: Column) -> Column:
    """A radius as an angle.  Distances are rounded to a millimetre before the test, so it is taken a little larger."""
    return (radius_m + 0.001) / EARTH_RADIUS_M * (1 + 1e-9)


def rows_of_circle(latitude: Column, longitude: Column, radius_m: Column, level: Column) -> Column:
    """The rows that a circle touches: five to nine at the level of its radius."""
    half = F.degrees(_reach(radius_m))
    return F.sequence(_row_of(F.greatest(latitude - half, F.lit(-90.0)), level), _row_of(F.least(latitude + half, F.lit(90.0)), level))


def span_of_circle(latitude: Column, longitude: Column, radius_m: Column, columns: Column) -> Column:
    """The columns that a circle touches in a row of so many, counted on beyond the antimeridian.  Around a pole it
    touches all cells of its rows, which are few there."""
    reach = _reach(radius_m)
    polar = (F.abs(latitude) + F.degrees(reach) >= 90.0) | (reach >= math.pi / 2)
    across = F.when(polar, 180.0).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), F.sin(reach) / F.cos(F.radians(latitude))))) * (1 + 1e-9))
    first, last = _column_at(longitude - across, columns), _column_at(longitude + across, columns)
    return F.sequence(first, F.least(last, first + columns - 1))


def cells_of_circle(latitude, longitude, radius_m) -> Column:
    """The cells that a circle touches, at the level of its radius."""
    circle = _col(latitude), _col(longitude), _col(radius_m)
    level = level_of_radius(radius_m)

    def of_row(row: Column) -> Column:
        columns = columns_of_row(row, level)
        return F.transform(span_of_circle(*circle, columns), lambda c: cell(level, row, columns, c))

    return F.flatten(F.transform(rows_of_circle(*circle, level), of_row))


def unit_vector(latitude, longitude) -> tuple[Column, Column, Column]:
    """A place as a point of the unit sphere."""
    latitude, longitude = F.radians(_col(latitude)), F.radians(_col(longitude))
    return F.cos(latitude) * F.cos(longitude), F.cos(latitude) * F.sin(longitude), F.sin(latitude)


def chords_of_radius(radius_m) -> tuple[Column, Column]:
    """Squares of two chords of the unit sphere: whatever is no further apart than the first is within the radius, and
    whatever is further apart than the second is not.  They leave room for a distance's rounding to millimetres and for the
    error of unit vectors.  Distances above 1,000 km are less exact: there the first holds nothing."""
    radius_m, reach = _col(radius_m), lambda m: F.greatest(m, F.lit(0.0)) / (2 * EARTH_RADIUS_M)
    chord = lambda half: F.sin(F.least(half, F.lit(math.pi / 2))) * 2
    inner, outer = chord(reach(radius_m - 0.001) * (1 - 1e-9)), chord(reach(radius_m + 0.001) * (1 + 1e-9))
    told = radius_m.between(0.01, 1e6)
    return F.when(told, inner * inner * (1 - 1e-12)).otherwise(-1.0), outer * outer * (1 + 1e-12)

