"""GeoJSON geometry as column expressions.

A geometry is ``struct<type: string, coordinates: string>`` with the coordinates as raw JSON text, so that
features of different kinds share one column; of a GeometryCollection it is the text of its geometries. Coordinates are
longitude and latitude in degrees.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A geometry as it stands in JSON, see :func:`as_read`.
JSON_GEOMETRY_TYPE = "struct<type:string,coordinates:string,geometries:string>"
COLLECTION = "GeometryCollection"
# Collections within collections that are looked into.
NESTED = 4

# WGS84 semi-major axis in metres and squared eccentricity.
WGS84_AXIS = 6378137.0
WGS84_ECCENTRICITY2 = 0.00669437999014


def as_read(geometry: Column) -> Column:
    """The geometry from one parsed by :data:`JSON_GEOMETRY_TYPE`."""
    text = F.when(geometry["type"] == COLLECTION, geometry["geometries"]).otherwise(geometry["coordinates"])
    return F.when(geometry.isNotNull(), F.struct(geometry["type"].alias("type"), text.alias("coordinates")))


def members(geometry: Column, nested: int = NESTED) -> Column:
    """The geometries of a GeometryCollection and of those within it as an array; those nested deeper fail the job."""
    if not nested:
        return F.raise_error(F.lit(f"More than {NESTED} geometry collections within each other")).cast(
            "array<struct<type:string,coordinates:string>>"
        )
    parsed = F.from_json(geometry["coordinates"], f"array<{JSON_GEOMETRY_TYPE}>", {"mode": "FAILFAST"})
    inner = F.transform(F.filter(parsed, lambda g: g.isNotNull()), as_read)
    flat = F.transform(inner, lambda g: F.when(g["type"] == COLLECTION, members(g, nested - 1)).otherwise(F.array(g)))
    return F.filter(F.flatten(F.filter(flat, lambda part: part.isNotNull())), lambda g: g["coordinates"].isNotNull())


def _of_members(geometry: Column, of_one: Callable[[Column], Column], together: Callable[[Column], Column]) -> Column:
    """``of_one`` of a geometry, of a GeometryCollection what ``together`` makes of those that its members have."""
    found = F.filter(F.transform(members(geometry), of_one), lambda one: one.isNotNull())
    whole = F.when(F.size(found) > 0, together(found))
    return F.when(geometry["type"] == COLLECTION, whole).otherwise(of_one(geometry))


def polygons(geometry: Column) -> Column:
    """Coordinates of any geometry in one shape: polygon, ring, vertex, ordinate. Collections give those of all members."""
    return _of_members(geometry, _polygons, F.flatten)


def area_polygons(geometry: Column) -> Column:
    """:func:`polygons` of what has an area, also within collections; NULL without any."""

    def of_one(one: Column) -> Column:
        return F.when(one["type"].isin("Polygon", "MultiPolygon"), _polygons(one))

    return _of_members(geometry, of_one, F.flatten)


def _polygons(geometry: Column) -> Column:
    """Coordinates of one geometry in the shape of :func:`polygons`.

    Shallower kinds are wrapped before the text is parsed, so every kind costs one parse. Kinds without
    coordinates give NULL.
    """
    kind, text = geometry["type"], geometry["coordinates"]
    nested = (
        F.when(kind == "MultiPolygon", text)
        .when(kind.isin("Polygon", "MultiLineString"), F.concat(F.lit("["), text, F.lit("]")))
        .when(kind.isin("LineString", "MultiPoint"), F.concat(F.lit("[["), text, F.lit("]]")))
        .when(kind == "Point", F.concat(F.lit("[[["), text, F.lit("]]]")))
    )
    return F.from_json(nested, "array<array<array<array<double>>>>")


def vertices(geometry: Column) -> Column:
    """All vertices as ``array<array<double>>``; ordinates after the second are left as they are."""
    return F.flatten(F.flatten(polygons(geometry)))


def vertex_count(geometry: Column) -> Column:
    """Number of vertices, the repeated closing ones included; NULL without a geometry."""
    return F.array_size(vertices(geometry))


def label_point(geometry: Column) -> Column:
    """``struct<lon, lat>``: plain mean of all vertices, the repeated closing one included; NULL if none."""
    start = F.struct(F.lit(0.0).alias("lon"), F.lit(0.0).alias("lat"), F.lit(0).alias("n"))
    return F.aggregate(
        vertices(geometry),
        start,
        lambda acc, v: F.struct(
            (acc["lon"] + F.get(v, 0)).alias("lon"), (acc["lat"] + F.get(v, 1)).alias("lat"), (acc["n"] + 1).alias("n")
        ),
        lambda acc: F.when(
            acc["n"] > 0, F.struct((acc["lon"] / acc["n"]).alias("lon"), (acc["lat"] / acc["n"]).alias("lat"))
        ),
    )


def _summed(*names: str) -> Callable[[Column], Column]:
    """Sums of numbers over an array of structs that have them."""
    zero = F.struct(*[F.lit(0.0).alias(name) for name in names])
    return lambda parts: F.aggregate(parts, zero, lambda acc, part: F.struct(*[(acc[n] + part[n]).alias(n) for n in names]))


def _ring_moments(ring: Column, sign: Column) -> Column:
    """Signed area and first moments of one ring, whatever way round it runs.

    Sums run relative to the ring's first vertex, so that the small area of a block is not lost between
    products of large coordinates.
    """
    x0, y0 = F.get(F.get(ring, 0), 0), F.get(F.get(ring, 0), 1)

    def step(acc: Column, v: Column) -> Column:
        x, y = F.get(v, 0) - x0, F.get(v, 1) - y0
        cross = acc["x"] * y - x * acc["y"]
        return F.struct(
            x.alias("x"),
            y.alias("y"),
            (acc["a"] + cross).alias("a"),
            (acc["mx"] + cross * (acc["x"] + x)).alias("mx"),
            (acc["my"] + cross * (acc["y"] + y)).alias("my"),
        )

    def finish(acc: Column) -> Column:
        turned = sign * F.signum(acc["a"])
        area = turned * acc["a"] / 2
        return F.struct(
            area.alias("area"),
            (turned * acc["mx"] / 6 + area * x0).alias("mx"),
            (turned * acc["my"] / 6 + area * y0).alias("my"),
        )

    zero = F.struct(*[F.lit(0.0).alias(name) for name in ("x", "y", "a", "mx", "my")])
    return F.aggregate(ring, zero, step, finish)


def area_moments(geometry: Column) -> Column:
    """``struct<area, mx, my>`` of a Polygon or MultiPolygon in the lon/lat plane; holes count negative.

    The centroid is ``(mx / area, my / area)``, and moments of several geometries may be added up. A collection adds up
    its members. Other kinds give NULL.
    """
    return _of_members(geometry, _area_moments, _summed("area", "mx", "my"))


def _area_moments(geometry: Column) -> Column:
    rings = F.transform(
        _polygons(geometry),
        lambda polygon: F.transform(
            polygon, lambda ring, i: _ring_moments(ring, F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0)))
        ),
    )
    return F.when(geometry["type"].isin("Polygon", "MultiPolygon"), _summed("area", "mx", "my")(F.flatten(rings)))


def line_moments(geometry: Column) -> Column:
    """``struct<length, mx, my>`` of a LineString or MultiLineString in the lon/lat plane; other kinds give NULL.

    A collection adds up its members.
    """
    return _of_members(geometry, _line_moments, _summed("length", "mx", "my"))


def _line_moments(geometry: Column) -> Column:
    def step(acc: Column, v: Column) -> Column:
        x, y = F.get(v, 0), F.get(v, 1)
        length = F.coalesce(F.hypot(x - acc["x"], y - acc["y"]), F.lit(0.0))
        return F.struct(
            x.alias("x"),
            y.alias("y"),
            (acc["length"] + length).alias("length"),
            (acc["mx"] + length * F.coalesce((x + acc["x"]) / 2, F.lit(0.0))).alias("mx"),
            (acc["my"] + length * F.coalesce((y + acc["y"]) / 2, F.lit(0.0))).alias("my"),
        )

    names = ("length", "mx", "my")
    zero = [F.lit(0.0).alias(name) for name in names]
    start = F.struct(F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"), *zero)
    lines = F.transform(F.flatten(_polygons(geometry)), lambda line: F.aggregate(line, start, step))
    return F.when(geometry["type"].isin("LineString", "MultiLineString"), _summed(*names)(lines))


def centroid_parts(geometry: Column) -> Column:
    """What a geometry adds to the centroid of many: ``array<struct<dimension, part, weight, mx, my>>``.

    A polygon or line is one part, weighted by area or length and named by a hash of its text; points are a part
    each, weighing 1 and named by their position. So parts that occur twice can be told by their names, which are
    short. A collection has the parts of its members. No geometry gives NULL.
    """
    return _of_members(geometry, _centroid_parts, F.flatten)


def _centroid_parts(geometry: Column) -> Column:
    name = F.sha2(F.concat(geometry["type"], geometry["coordinates"]), 256)

    def one(dimension: int, moments: Column, weight: str) -> Column:
        return F.array(_part(F.lit(dimension), name, moments[weight], moments["mx"], moments["my"]))

    points = F.transform(
        F.flatten(F.flatten(_polygons(geometry))),
        lambda v: _part(F.lit(0), F.concat_ws(",", F.get(v, 0), F.get(v, 1)), F.lit(1.0), F.get(v, 0), F.get(v, 1)),
    )
    kind = geometry["type"]
    return (
        F.when(kind.isin("Polygon", "MultiPolygon"), one(2, _area_moments(geometry), "area"))
        .when(kind.isin("LineString", "MultiLineString"), one(1, _line_moments(geometry), "length"))
        .when(kind.isin("Point", "MultiPoint"), points)
    )


def _part(dimension: Column, name: Column, weight: Column, mx: Column, my: Column) -> Column:
    return F.struct(
        dimension.alias("dimension"), name.alias("part"), weight.alias("weight"), mx.alias("mx"), my.alias("my")
    )


def distance_m(lat: Column, lon: Column, lat0: float | Column, lon0: float | Column) -> Column:
    """Metres from a fixed point on the WGS84 ellipsoid.

    Uses the radii of curvature at the mid latitude: good to millimetres over a city, to be replaced by a
    geodesic solver beyond some tens of kilometres.
    """
    lat0 = lat0 if isinstance(lat0, Column) else F.lit(float(lat0))
    lon0 = lon0 if isinstance(lon0, Column) else F.lit(float(lon0))
    middle = (lat + lat0) / 2 * F.lit(math.pi / 180)
    flat = 1 - WGS84_ECCENTRICITY2 * F.sin(middle) * F.sin(middle)
    north = WGS84_AXIS * (1 - WGS84_ECCENTRICITY2) / F.pow(flat, F.lit(1.5)) * F.radians(lat - lat0)
    east = WGS84_AXIS / F.sqrt(flat) * F.cos(middle) * F.radians(lon - lon0)
    return F.sqrt(north * north + east * east)
