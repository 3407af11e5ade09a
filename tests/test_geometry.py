import json
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from areaprice.functions.geometry import area_moments, distance_m, label_point, vertex_count, vertices
from areaprice.operators.centers import area_centroids, bbox_center, bids_center, union_center
from areaprice.sources.features import read_features
from areaprice.sources.sinks import write_features

RING = (
    "[[30.380581811999996,59.99604609],[30.385111436000003,59.995476652],[30.387655220999996,59.995156770000015],"
    "[30.391310228,59.99469712099999],[30.394411875,59.999665858],[30.394875984000006,60.000113259999985],"
    "[30.391061955000005,60.00076645500001],[30.386164698000005,60.00158489999999],[30.380581811999996,59.99604609]]"
)
SQUARE = "[[0,0],[4,0],[4,4],[0,4],[0,0]]"
HOLE = "[[1,1],[1,2],[2,2],[2,1],[1,1]]"
FAR = "[[10,0],[12,0],[12,2],[10,2],[10,0]]"
SCHEMA = "id int, geometry struct<type:string,coordinates:string>"
CENTER = (60.009376, 30.400951)
# Key suffix: centroid lon, centroid lat, metres from the centre point.
GOLDEN = {
    "5203": (30.388071132410857, 59.99803899245931, 1453.1989012269837),
    "5209": (30.39438842324531, 60.00480608920553, 627.1103822210085),
    "5225": (30.43305007492609, 59.9950557950965, 2398.5753938873486),
}


def shapes(spark, *geometries):
    return spark.createDataFrame(list(enumerate(geometries)), SCHEMA)


def _exact_centroid(ring):
    points = [(Fraction(x), Fraction(y)) for x, y in ring]
    pairs = list(zip(points, points[1:]))
    crosses = [p[0] * q[1] - q[0] * p[1] for p, q in pairs]
    return [float(sum(c * (p[i] + q[i]) for c, (p, q) in zip(crosses, pairs)) / (3 * sum(crosses))) for i in (0, 1)]


def test_golden_centroid_and_distance(spark):
    row = area_centroids(shapes(spark, ("Polygon", f"[{RING}]"))).first()
    # The golden centroids carry the rounding error of sums over absolute coordinates, up to 2e-7 degrees.
    assert (row.centroid_lon, row.centroid_lat) == pytest.approx(GOLDEN["5203"][:2], abs=2e-7)
    assert (row.centroid_lon, row.centroid_lat) == pytest.approx(_exact_centroid(json.loads(RING)), abs=1e-13)
    places = spark.createDataFrame(list(GOLDEN.values()), "lon double, lat double, expected double")
    for row in places.withColumn("d", distance_m(F.col("lat"), F.col("lon"), *CENTER)).collect():
        assert row.d == pytest.approx(row.expected, abs=1e-4)


@pytest.mark.parametrize(
    "geometry, count, label, centroid",
    [
        (("Point", "[3,5]"), 1, (3, 5), None),
        (("Point", "[3,5,99]"), 1, (3, 5), None),
        (("MultiPoint", "[[0,0],[2,4]]"), 2, (1, 2), None),
        (("LineString", "[[0,0],[2,4]]"), 2, (1, 2), None),
        (("MultiLineString", "[[[0,0],[2,4]],[[4,8],[6,12]]]"), 4, (3, 6), None),
        (("Polygon", f"[{SQUARE}]"), 5, (1.6, 1.6), (2, 2)),
        (("Polygon", f"[{SQUARE},{HOLE}]"), 10, (1.5, 1.5), ((32 - 1.5) / 15, (32 - 1.5) / 15)),
        (("MultiPolygon", f"[[{SQUARE}],[{FAR}]]"), 10, ((8 + 54) / 10, (8 + 4) / 10), ((32 + 44) / 20, (32 + 4) / 20)),
        (("Polygon", "[[[0,0],[1,1],[2,2],[0,0]]]"), 4, (0.75, 0.75), None),
        (("Polygon", "[]"), 0, None, None),
        (("GeometryCollection", None), None, None, None),
        (None, None, None, None),
    ],
)
def test_every_kind(spark, geometry, count, label, centroid):
    row = (
        area_centroids(shapes(spark, geometry))
        .select("*", vertex_count(F.col("geometry")).alias("n"), label_point(F.col("geometry")).alias("at"))
        .first()
    )
    assert row.n == count
    assert (tuple(row["at"]) if row["at"] else None) == (pytest.approx(label) if label else None)
    found = (row.centroid_lon, row.centroid_lat)
    assert found == (pytest.approx(centroid) if centroid else (None, None))


def test_centroid_does_not_depend_on_ring_direction(spark):
    turned = "[[0,0],[0,4],[4,4],[4,0],[0,0]]"
    rows = area_centroids(shapes(spark, ("Polygon", f"[{SQUARE},{HOLE}]"), ("Polygon", f"[{turned},{HOLE}]"))).collect()
    assert rows[0][2:] == pytest.approx(rows[1][2:])


def test_bbox_center(spark):
    center = bbox_center(shapes(spark, ("Polygon", f"[{SQUARE}]"), None, ("Point", "[10,-2]"))).first()
    assert (center.lat, center.lon) == (1.0, 5.0)
    assert tuple(bbox_center(shapes(spark, None)).first()) == (None, None)


def test_union_center(spark):
    square, far = ("Polygon", f"[{SQUARE}]"), ("Polygon", f"[{FAR}]")
    center = union_center(shapes(spark, square, far, square, ("Point", "[500,500]"), None)).first()
    assert (center.lon, center.lat) == pytest.approx(((32 + 44) / 20, (32 + 4) / 20))
    points = union_center(shapes(spark, ("Point", "[0,0]"), ("MultiPoint", "[[0,0],[3,6]]"))).first()
    assert (points.lon, points.lat) == (1.5, 3.0)
    assert tuple(union_center(shapes(spark, None)).first()) == (None, None)


def test_bids_center(spark):
    bids = spark.createDataFrame([(1.0, 10.0), (3.0, 30.0)], "lat double, lon double")
    assert tuple(bids_center(bids).first()) == (2.0, 20.0)
    assert tuple(bids_center(bids.where("lat > 5")).first()) == (None, None)


def test_distance_along_axes(one):
    degree = one(distance_m(F.lit(60.0), F.lit(30.001), 60.0, 30.0))
    assert degree == pytest.approx(math.radians(0.001) * 6378137 / math.sqrt(1 - 0.00669437999014 * 0.75) * 0.5, rel=1e-9)
    assert one(distance_m(F.lit(60.0), F.lit(30.0), 60.0, 30.0)) == 0


def test_union_centre_takes_the_highest_dimension(spark):
    line = ("LineString", "[[0,0],[4,0],[4,2]]")
    lines = ("MultiLineString", "[[[10,10],[10,12]],[[0,0],[2,0]]]")
    point, square = ("Point", "[100,100]"), ("Polygon", "[[[0,0],[2,0],[2,2],[0,2],[0,0]]]")
    schema = "geometry struct<type:string,coordinates:string>"

    def center(*shapes):
        return tuple(union_center(spark.createDataFrame([(shape,) for shape in shapes], schema)).first())

    assert center(line, line, point) == pytest.approx(((0 * 4 + 1 * 2) / 6, (2 * 4 + 4 * 2) / 6))
    assert center(lines) == pytest.approx(((11 * 2 + 0 * 2) / 4, (10 * 2 + 1 * 2) / 4))
    assert center(line, point, square, square, None) == pytest.approx((1.0, 1.0))
    assert center(point, ("MultiPoint", "[[0,0],[100,100]]")) == pytest.approx((50.0, 50.0))
    assert center(None) == (None, None)


def collected(rng, depth):
    """A random GeometryCollection, and the simple geometries in it."""
    geometries, simple = [], []
    for _ in range(rng.randint(0, 4)):
        kind = rng.choice(["Point", "LineString", "Polygon", "MultiPolygon", "GeometryCollection", "GeometryCollection"])
        x, y = rng.randint(0, 9), rng.randint(0, 9)
        ring = [[x, y], [x + 2, y], [x + 2, y + 1], [x, y + 1], [x, y]]
        coordinates = {"Point": [x, y], "LineString": ring[:3], "Polygon": [ring], "MultiPolygon": [[ring], [[[a + 20, b] for a, b in ring]]]}
        if kind == "GeometryCollection":
            if depth:
                inner, parts = collected(rng, depth - 1)
                geometries.append(inner)
                simple += parts
        else:
            simple.append({"type": kind, "coordinates": coordinates[kind]})
            geometries.append(simple[-1])
    return {"type": "GeometryCollection", "geometries": geometries}, simple


def test_collections_are_their_members(spark, tmp_path):
    rng = random.Random(6)
    made = [collected(rng, 3) for _ in range(40)]
    path = tmp_path / "f.geojson"
    path.write_text(json.dumps({"features": [{"type": "Feature", "id": i, "geometry": g, "properties": {}} for i, (g, _) in enumerate(made)]}))
    read = read_features(spark, str(path))
    found = {int(r.id): r for r in area_centroids(read).select("id", vertex_count(F.col("geometry")).alias("n"), label_point(F.col("geometry")).alias("at"), "centroid_lon", "centroid_lat").collect()}
    alone = spark.createDataFrame([(i, (g["type"], json.dumps(g["coordinates"]))) for i, (_, parts) in enumerate(made) for g in parts], SCHEMA)
    assert len(found) == 40 and alone.count() > 60
    rows = alone.select("id", vertices(F.col("geometry")).alias("v"), area_moments(F.col("geometry")).alias("m")).collect()
    for i, row in found.items():
        points = [p for r in rows if r.id == i for p in r.v]
        areas = [r.m for r in rows if r.id == i and r.m]
        assert (row.n or 0) == len(points)
        assert (row.at is None) == (not points)
        if points:
            assert (row.at.lon, row.at.lat) == pytest.approx([sum(p[k] for p in points) / len(points) for k in (0, 1)])
        assert (row.centroid_lon is None) == (not areas)
        if areas:
            total = sum(m.area for m in areas)
            assert (row.centroid_lon, row.centroid_lat) == pytest.approx((sum(m.mx for m in areas) / total, sum(m.my for m in areas) / total))
    for dissolve in (True, False):
        together, apart = (union_center(table, dissolve=dissolve).first() for table in (read, alone))
        assert tuple(together) == pytest.approx(tuple(apart))
    assert tuple(bbox_center(read).first()) == pytest.approx(tuple(bbox_center(alone).first()))
    out = write_features(read, str(tmp_path / "out"))
    written = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert sorted(written, key=lambda f: f["id"]) == json.loads(path.read_text())["features"]


def test_collections_nested_too_deep_fail(spark):
    deep = {"type": "Point", "coordinates": [1, 2]}
    for depth in range(6):
        deep = {"type": "GeometryCollection", "geometries": [deep]}
        table = shapes(spark, ("GeometryCollection", json.dumps(deep["geometries"])))
        if depth < 4:
            assert table.select(vertex_count(F.col("geometry"))).first()[0] == 1
    with pytest.raises(Exception, match="geometry collections"):
        table.select(vertex_count(F.col("geometry"))).collect()
