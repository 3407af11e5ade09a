"""What polygons cover together against plain Python."""

import json
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from areaprice.operators import union
from areaprice.operators.centers import union_center
from areaprice.plans.maps import map_quick


def table(spark, shapes):
    """Features of shapes: a list of rings is a Polygon, a list of these a MultiPolygon."""
    rows = [("MultiPolygon" if isinstance(s[0][0][0], list) else "Polygon", json.dumps(s)) for s in shapes]
    return spark.createDataFrame(rows, "type string, coordinates string").selectExpr("named_struct('type', type, 'coordinates', coordinates) as geometry")


def square(x, y, side):
    return [[x, y], [x + side, y], [x + side, y + side], [x, y + side], [x, y]]


def box(x, y, w, h):
    return [[x, y], [x, y + h], [x + w, y + h], [x + w, y], [x, y]]


def centre(spark, shapes, **options):
    row = union_center(table(spark, shapes), **options).first()
    return row["lon"], row["lat"]


def plain_boxes(boxes):
    """Area and moments of axis-parallel boxes, exactly, on the grid of all their sides."""
    xs = sorted({Fraction(v) for x, _, w, _ in boxes for v in (x, x + w)})
    ys = sorted({Fraction(v) for _, y, _, h in boxes for v in (y, y + h)})
    area = mx = my = Fraction(0)
    for x0, x1 in zip(xs, xs[1:]):
        for y0, y1 in zip(ys, ys[1:]):
            if any(x <= x0 and x1 <= x + w and y <= y0 and y1 <= y + h for x, y, w, h in boxes):
                part = (x1 - x0) * (y1 - y0)
                area, mx, my = area + part, mx + part * (x0 + x1) / 2, my + part * (y0 + y1) / 2
    return float(area), float(mx), float(my)


def test_what_lies_within_another_counts_once(spark):
    shapes = [[square(0, 0, 2)], [square(0.5, 0.5, 1)], [square(10, 0, 2)]]
    assert centre(spark, shapes) == pytest.approx((6.0, 1.0))
    assert centre(spark, shapes, dissolve=False) == pytest.approx((49 / 9, 1.0))
    copies = [[square(0, 0, 1)]] * 5 + [[square(3, 0, 1)]]
    assert centre(spark, copies) == pytest.approx((2.0, 0.5))


@pytest.mark.parametrize("seed", range(4))
def test_boxes_that_overlap(spark, monkeypatch, seed):
    rng = random.Random(seed)
    boxes = [(rng.randint(0, 40) / 4, rng.randint(0, 40) / 4, rng.randint(1, 12) / 4, rng.randint(1, 12) / 4) for _ in range(30)]
    boxes += [boxes[0], (2.0, 2.0, 8.0, 6.0), (0.0, 9.0, 0.25, 0.25)]
    monkeypatch.setattr(union, "CELL_EDGES", (256, 60, 40, 90)[seed])
    monkeypatch.setattr(union, "DIVIDE", (16, 3, 2, 5)[seed])
    monkeypatch.setattr(union, "TASK_EDGES", (1 << 17, 30, 10, 50)[seed])
    found = union.union_moments(table(spark, [[box(*b)] for b in boxes])).first()
    assert tuple(found) == pytest.approx(plain_boxes(boxes), rel=1e-12)


def grid_share(polygons, n=400, size=10.0):
    """Area and moments by counting the middles of small squares."""
    x, y = np.meshgrid((np.arange(n) + 0.5) * size / n, (np.arange(n) + 0.5) * size / n)
    covered = np.zeros(x.shape, dtype=bool)
    for rings in polygons:
        inside = np.zeros(x.shape, dtype=bool)
        for ring in rings:
            for (x0, y0), (x1, y1) in zip(ring, ring[1:]):
                if y0 != y1:
                    inside ^= ((y0 <= y) != (y1 <= y)) & (x < x0 + (y - y0) * (x1 - x0) / (y1 - y0))
        covered |= inside
    part = (size / n) ** 2
    return covered.sum() * part, x[covered].sum() * part, y[covered].sum() * part


def star(rng, x, y, size, points=9):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(points))
    ring = [[x + size * rng.uniform(0.2, 1) * math.cos(a), y + size * rng.uniform(0.2, 1) * math.sin(a)] for a in angles]
    return [*ring, ring[0]]


@pytest.mark.parametrize(("edges", "divide"), [(256, 16), (120, 4)])
def test_any_polygons_that_overlap(spark, monkeypatch, edges, divide):
    rng = random.Random(edges)
    polygons = [[star(rng, rng.uniform(2, 8), rng.uniform(2, 8), rng.uniform(0.3, 2))] for _ in range(40)]
    polygons[3].append(star(rng, 5, 5, 0.4))  # a hole, or a part outside
    polygons[4] = [star(rng, 5, 5, 2.5, 40), star(rng, 5, 5, 1, 20)]
    plain = grid_share(polygons)
    in_one = union.covered_moments([[np.array(r) for r in rings] for rings in polygons])
    assert in_one == pytest.approx(plain, rel=5e-3)
    monkeypatch.setattr(union, "CELL_EDGES", edges)
    monkeypatch.setattr(union, "DIVIDE", divide)
    shapes = [polygons[:20], *polygons[20:]]  # one MultiPolygon
    assert tuple(union.union_moments(table(spark, shapes)).first()) == pytest.approx(in_one, rel=1e-10)


def test_rings_are_cut_at_lines():
    ring = np.array([[0, 0], [4, 0], [4, 1], [2, 3], [0, 1]], dtype=float)
    left, right = union.clipped(ring, 0, -1.0, 1.5), union.clipped(ring, 0, 1.5, 9.0)
    assert union.ring_area(left) + union.ring_area(right) == pytest.approx(union.ring_area(ring))
    assert left[:, 0].max() == right[:, 0].min() == 1.5
    assert len(union.clipped(ring, 1, 5.0, 6.0)) == 0 and union.clipped(ring, 1, 0.0, 3.0) is ring


def test_a_dense_spot_is_divided_and_large_polygons_are_not(spark, monkeypatch):
    monkeypatch.setattr(union, "CELL_EDGES", 100)
    monkeypatch.setattr(union, "DIVIDE", 4)
    small = [(50 + i / 16, 50 + j / 16, 1 / 16, 1 / 16) for i in range(12) for j in range(12)]
    boxes = [(0, 0, 100, 100)]
    found = union.union_moments(table(spark, [[box(*b)] for b in boxes + small])).first()
    assert tuple(found) == pytest.approx((1e4, 5e5, 5e5))
    boxes = [(0, 0, 100, 10), (0, 90, 100, 10)]
    found = union.union_moments(table(spark, [[box(*b)] for b in boxes + small])).first()
    assert tuple(found) == pytest.approx(plain_boxes(boxes + small))


def test_nothing_that_has_an_area(spark):
    empty = spark.createDataFrame([(("Point", "[1, 2]"),), (None,), (("LineString", "[[1,2],[3,4]]"),)], "geometry struct<type:string,coordinates:string>")
    assert tuple(union.union_moments(empty).first()) == (None, None, None)
    assert tuple(union_center(empty).first()) == pytest.approx((3.0, 2.0))
    assert tuple(union_center(empty.limit(0)).first()) == (None, None)
    odd = [[[[1, 1], [1, 1], [1, 1], [1, 1]]], [[[0, 0], [5, 5], [0, 0]]], [[[0, 0], [None, 1], [1, 1], [0, 0]]], [square(3, 3, 1)]]
    assert centre(spark, odd) == pytest.approx((3.5, 3.5))


def test_centre_of_a_map_of_overlapping_features(spark):
    shapes = table(spark, [[square(0, 0, 2)], [square(0.5, 0.5, 1)], [square(10, 0, 2)]]).selectExpr("geometry", "'a' as k", "'{}' as properties")
    values = spark.createDataFrame([("a", 1.0)], "k string, v double")
    for dissolve, lon in ((True, 6.0), (False, 49 / 9)):
        built = map_quick(shapes, values, "k", "v", unique=True, dissolve=dissolve)
        assert built.center.first()["lon"] == pytest.approx(lon)
