"""Geometry as column expressions. Points are structs with ``lat`` and ``lng`` in degrees."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchback import fixed_values as V

POINTS = "array<struct<lat:double,lng:double>>"
MEMBERS = (
    "array<struct<type:string,ref:bigint,role:string,tags:map<string,string>,"
    "geometry:array<struct<lat:double,lon:double>>>>"
)
METRES_PER_DEGREE = math.pi * V.EARTH_RADIUS_M / 180.0


def _chord(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / F.lit(2.0))
    half_lng = F.sin(F.radians(lng2 - lng1) / F.lit(2.0))
    return F.pow(half_lat, F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(half_lng, F.lit(2.0))


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    a = _chord(lat1, lng1, lat2, lng2)
    # not `least`, which would turn a missing coordinate into half the globe
    return F.lit(2 * V.EARTH_RADIUS_M) * F.asin(F.sqrt(F.when(a > 1.0, F.lit(1.0)).otherwise(a)))


def apart(p: Column, q: Column) -> Column:
    """Metres between two point structs, NULL when either is missing."""
    return haversine_m(p["lat"], p["lng"], q["lat"], q["lng"])


def between(p: Column, q: Column) -> Column:
    """As :func:`apart` for points known to be there, in the shorter form that suits array functions."""
    return F.lit(2 * V.EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(_chord(p["lat"], p["lng"], q["lat"], q["lng"]))))


def path_length_m(points: Column) -> Column:
    """Length of an array of points; fewer than two points give 0."""
    n = F.size(points)
    starts = F.slice(points, F.lit(1), F.greatest(n - 1, F.lit(0)))
    ends = F.slice(points, F.lit(2), F.greatest(n - 1, F.lit(0)))
    return F.when(n < 2, F.lit(0.0)).otherwise(
        F.aggregate(F.zip_with(starts, ends, between), F.lit(0.0), lambda total, d: total + d)
    )


def way_points(geometry: Column) -> Column:
    """Geometry entries that carry both coordinates, as points."""
    usable = F.filter(
        F.coalesce(geometry, F.array().cast("array<struct<lat:double,lon:double>>")),
        lambda p: p["lat"].isNotNull() & p["lon"].isNotNull(),
    )
    return F.transform(usable, lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lng")))


def element_lines(kind: Column, geometry: Column, members: Column) -> Column:
    """The lines an element consists of: its own geometry, or for a relation those of its member ways."""
    none = F.array().cast("array<struct<lat:double,lon:double>>")
    ways = F.transform(
        F.filter(F.coalesce(members, F.array().cast(MEMBERS)), lambda m: m["type"] == "way"),
        lambda m: F.coalesce(m["geometry"], none),
    )
    geometries = F.when(kind == "relation", ways).otherwise(F.array(F.coalesce(geometry, none)))
    return F.filter(F.transform(geometries, way_points), lambda line: F.size(line) > 0)


def with_joined_lines(df: DataFrame, lines: str, out: str) -> DataFrame:
    """Joins an array of lines in order into one line, each turned so that its nearer end comes first.

    The fold carries only the open end and one (reverse, drop) decision per
    line, so it does not copy the growing result.
    """
    start = F.struct(
        F.element_at(F.try_element_at(F.col(lines), F.lit(1)), -1).alias("tail"),
        F.array(F.struct(F.lit(False).alias("flip"), F.lit(False).alias("drop"))).alias("plan"),
    )

    def join_next(state: Column, line: Column) -> Column:
        tail, first, last = state["tail"], F.element_at(line, 1), F.element_at(line, -1)
        from_first, from_last = between(tail, first), between(tail, last)
        flip = from_last < from_first
        drop = F.least(from_first, from_last) < V.JOINT_TOLERANCE_M
        step = F.struct(flip.alias("flip"), drop.alias("drop"))
        far = F.when(flip, first).otherwise(last)
        new_tail = F.when(drop & (F.size(line) == 1), tail).otherwise(far)
        return F.struct(new_tail.alias("tail"), F.concat(state["plan"], F.array(step)).alias("plan"))

    rest = F.slice(F.col(lines), F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    plan = F.when(F.size(lines) > 0, F.aggregate(rest, start, join_next)["plan"])
    laid = F.zip_with(
        F.col(lines),
        F.col("_plan"),
        lambda line, p: F.slice(
            F.when(p["flip"], F.reverse(line)).otherwise(line),
            F.when(p["drop"], F.lit(2)).otherwise(F.lit(1)),
            F.size(line),
        ),
    )
    joined = F.coalesce(F.flatten(laid), F.array().cast(POINTS))
    return df.withColumn("_plan", plan).withColumn(out, joined).drop("_plan")


# ---- grid cells -------------------------------------------------------------
# Bands of latitude are `radius` high. Within a band all cells have the same
# width, a whole fraction of the circle that is at least the longitude reach of
# `radius` anywhere in the band, so cells line up and wrap at 180 degrees.


def _band_height(radius: float) -> float:
    return radius * (1 + 1e-9) / METRES_PER_DEGREE


def _reach(radius: float, max_abs_lat: Column) -> Column:
    """Largest longitude difference in degrees of two points within ``radius``, up to that latitude."""
    half = math.sin(radius / (2 * V.EARTH_RADIUS_M)) * (1 + 1e-9)
    cos_lat = F.greatest(F.cos(F.radians(F.least(max_abs_lat, F.lit(90.0)))), F.lit(1e-12))
    return F.degrees(F.lit(2.0) * F.asin(F.least(F.lit(1.0), F.lit(half) / cos_lat)))


def _band(lat: Column, radius: float) -> Column:
    return F.floor(lat / F.lit(_band_height(radius)))


def _columns(band: Column, radius: float) -> Column:
    """Number of cells in a band, from the latitude of its outer edge."""
    edge = F.greatest(F.abs(band), F.abs(band + 1)) * F.lit(_band_height(radius))
    return F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(360.0) / _reach(radius, edge)))


def _column(lng: Column, columns: Column) -> Column:
    return F.floor((lng + F.lit(180.0)) * columns / F.lit(360.0))


def with_cell(df: DataFrame, lat: Column, lng: Column, radius: float) -> DataFrame:
    """Adds the grid cell (gy, gx) of a position."""
    placed = df.withColumn("gy", _band(lat, radius)).withColumn("_n", _columns(F.col("gy"), radius))
    return placed.withColumn("gx", F.pmod(_column(lng, F.col("_n")), F.col("_n"))).drop("_n")


def with_cells_around(df: DataFrame, lat: Column, lng: Column, radius: float) -> DataFrame:
    """One row per cell that can hold a point within ``radius`` of the position."""
    home = df.withColumn("_home", _band(lat, radius))
    # both latitudes enter the reach, so use the outer edge of the outermost of the three bands
    edge = F.greatest(F.abs(F.col("_home") - 1), F.abs(F.col("_home") + 2)) * F.lit(_band_height(radius))
    wide = home.withColumn("_reach", F.least(_reach(radius, edge), F.lit(180.0)))
    bands = wide.withColumn("gy", F.explode(F.sequence(F.col("_home") - 1, F.col("_home") + 1)))
    bands = bands.withColumn("_n", _columns(F.col("gy"), radius))
    bands = bands.withColumn("_west", _column(lng - F.col("_reach"), F.col("_n")))
    bands = bands.withColumn("_east", _column(lng + F.col("_reach"), F.col("_n")))
    # a circle that spans the whole band visits each of its cells once
    bands = bands.withColumn("_east", F.least(F.col("_east"), F.col("_west") + F.col("_n") - 1))
    cells = bands.withColumn("gx", F.explode(F.sequence(F.col("_west"), F.col("_east"))))
    return cells.withColumn("gx", F.pmod("gx", "_n")).drop("_home", "_reach", "_n", "_west", "_east")


# A crowded cell is cut in 2 ** level by 2 ** level parts, numbered by row and column inside the cell.


def with_subcell(df: DataFrame, lat: Column, lng: Column, radius: float, level: Column) -> DataFrame:
    """Adds the part (sy, sx) of its cell (gy, gx) that a position lies in; (0, 0) at level 0."""
    parts = F.pow(F.lit(2.0), level)
    inside = lambda at, cell: F.least(F.floor((at - cell) * parts), parts - 1).cast("int")
    columns = _columns(F.col("gy"), radius)
    across = (lng + F.lit(180.0)) * columns / F.lit(360.0)
    return df.withColumn("sy", inside(lat / F.lit(_band_height(radius)), F.col("gy"))).withColumn("sx", inside(across, F.floor(across)))


def with_subcells_around(df: DataFrame, lat: Column, lng: Column, radius: float, level: Column) -> DataFrame:
    """One row per part of the row's cell (gy, gx) that can hold a point within ``radius`` of the position.

    ``df`` comes from :func:`with_cells_around` of the same position.
    """
    height = _band_height(radius)
    parts = F.pow(F.lit(2.0), level)
    first = lambda at: F.floor(F.greatest(F.lit(0.0), at) * parts).cast("int")
    last = lambda at: F.floor(F.least(F.lit(1.0) - F.lit(1e-12), at) * parts).cast("int")
    y = lat / F.lit(height) - F.col("gy")
    edge = F.greatest(F.abs(F.col("gy") - 2), F.abs(F.col("gy") + 3)) * F.lit(height)
    columns = _columns(F.col("gy"), radius)
    reach = F.least(_reach(radius, edge), F.lit(180.0)) * columns / F.lit(360.0)
    across = (lng + F.lit(180.0)) * columns / F.lit(360.0)
    # the cell's place nearest to the position, around the globe
    x = across - F.col("gx")
    x = x - F.round(x / columns) * columns
    wide = reach * 2 + 1 >= columns
    rows = df.withColumn("sy", F.explode(F.sequence(first(y - F.lit(1 + 1e-9)), F.greatest(first(y - F.lit(1 + 1e-9)), last(y + F.lit(1 + 1e-9))))))
    low = F.when(wide, F.lit(0)).otherwise(first(x - reach))
    high = F.when(wide, parts.cast("int") - 1).otherwise(F.greatest(first(x - reach), last(x + reach)))
    return rows.withColumn("sx", F.explode(F.sequence(low, high)))
