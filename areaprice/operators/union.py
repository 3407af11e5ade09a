"""Area and centre of what polygons cover together, where they overlap counted once.

The plane is divided into square cells. Polygons are cut along the cells, and in a cell with few edges a scan from edge
to edge, between all heights at which one ends or two cross, adds up what is covered. A cell with many edges is divided
again; one that a polygon covers whole is done at once. So nothing but pieces of cells is shuffled, and a task holds
the pieces of a few cells.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import area_polygons
from ..scratch import stored, stored_and_observed

# Edges of a cell that is scanned; cells with more are divided, by so many a side at most.
CELL_EDGES, DIVIDE = 256, 16
# After so many divisions cells are scanned however many edges they have, as where very many polygons meet in a point.
DIVISIONS = 10
# Edges that one task scans, in whole cells.
TASK_EDGES = 1 << 17

_PIECES = "x double, y double, side double, rings array<array<double>>, edges int, whole boolean"
_MOMENTS = "area double, mx double, my double"


def clipped(ring: np.ndarray, axis: int, low: float, high: float) -> np.ndarray:
    """The part of a ring (rows of x and y) between two lines across an axis, with its ends along them."""
    for bound, sign in ((low, 1.0), (high, -1.0)):
        if not len(ring):
            break
        inside = sign * (ring[:, axis] - bound) >= 0
        if inside.all():
            continue
        after = np.roll(ring, -1, axis=0)
        crosses = inside != np.roll(inside, -1)
        found = np.empty((len(ring), 2, 2))
        found[:, 0] = ring
        run = (bound - ring[crosses, axis]) / (after[crosses, axis] - ring[crosses, axis])
        found[crosses, 1] = ring[crosses] + run[:, None] * (after[crosses] - ring[crosses])
        found[crosses, 1, axis] = bound
        ring = found[np.column_stack([inside, crosses])]
    return ring


def ring_area(ring: np.ndarray) -> float:
    """Signed area, relative to the first vertex."""
    x, y = (ring - ring[:1]).T
    return float(np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y)) / 2


def _divided(rings: list[np.ndarray], x: float, y: float, side: float, by: int) -> Iterator[tuple]:
    """The pieces of one polygon in the cells that a cell is divided into."""
    width = side / by
    ends = [np.array([x + i * width for i in range(by)] + [x + side]), np.array([y + i * width for i in range(by)] + [y + side])]

    def places(parts: list[np.ndarray], axis: int) -> range:
        low, high = min(p[:, axis].min() for p in parts), max(p[:, axis].max() for p in parts)
        first = int(np.searchsorted(ends[axis], low, side="right")) - 1
        return range(max(0, first), min(by, int(np.searchsorted(ends[axis], high, side="left"))))

    def cut(parts: list[np.ndarray], axis: int, at: int) -> list[np.ndarray]:
        cuts = [clipped(p, axis, ends[axis][at], ends[axis][at + 1]) for p in parts]
        return [p for p in cuts if len(p) > 2 and (np.ptp(p, axis=0) > 0).all()]

    for i in places(rings, 0):
        if column := cut(rings, 0, i):
            for j in places(column, 1):
                if piece := cut(column, 1, j):
                    low, high = np.array([ends[0][i], ends[1][j]]), np.array([ends[0][i + 1], ends[1][j + 1]])
                    ring = piece[0]
                    on_border = ((ring == low) | (ring == high)).any(axis=1).all()
                    whole = len(piece) == 1 and on_border and abs(ring_area(ring)) >= np.prod(high - low) * (1 - 1e-12)
                    yield float(low[0]), float(low[1]), width, [] if whole else piece, sum(map(len, piece)), bool(whole)


def _divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the cells that their cells are divided into, ``by`` a side."""
    schema = pa.schema(
        [("x", pa.float64()), ("y", pa.float64()), ("side", pa.float64()), ("rings", pa.list_(pa.list_(pa.float64()))), ("edges", pa.int32()), ("whole", pa.bool_())]
    )
    for batch in batches:
        cells = [batch.column(name).to_pylist() for name in ("x", "y", "side", "by")]
        rows: list[tuple] = []
        for x, y, side, by, rings in zip(*cells, batch.column("rings"), strict=True):
            points = [ring.values.to_numpy().reshape(-1, 2) for ring in rings if len(ring.values) >= 6]
            if points:
                rows += _divided(points, x, y, side, by)
            if len(rows) > 4096:
                yield _batch(rows, schema)
                rows = []
        yield _batch(rows, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    columns[3] = [[ring.reshape(-1) for ring in rings] for rings in columns[3]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def covered_moments(pieces: list[list[np.ndarray]]) -> np.ndarray:
    """Area and first moments of what some polygons cover together; a polygon is what an odd number of its rings is around."""
    edges = []
    for number, rings in enumerate(pieces):
        for ring in rings:
            after = np.roll(ring, -1, axis=0)
            edges.append(np.column_stack([ring, after, np.full(len(ring), number)]))
    edges = np.concatenate(edges) if edges else np.zeros((0, 5))
    edges = edges[edges[:, 1] != edges[:, 3]]
    if not len(edges):
        return np.zeros(3)
    up = edges[:, 1] < edges[:, 3]
    xa, ya, xb, yb = np.where(up[:, None], edges[:, :4], edges[:, [2, 3, 0, 1]]).T
    of = edges[:, 4].astype(np.int64)
    slope = (xb - xa) / (yb - ya)
    heights = [ya, yb]
    order = np.argsort(ya, kind="stable")
    lowest = ya[order]
    for at, edge in enumerate(order):  # crossings with the edges that start later, while this one lasts
        other = order[at + 1 : np.searchsorted(lowest, yb[edge], side="left")]
        turn = slope[edge] - slope[other]
        other = other[turn != 0]
        y = ya[other] + (xa[other] - xa[edge] - slope[edge] * (ya[other] - ya[edge])) / turn[turn != 0]
        heights.append(y[(y > ya[other]) & (y < np.minimum(yb[other], yb[edge]))])
    heights = np.unique(np.concatenate(heights))
    total = np.zeros(3)
    step = max(1, (1 << 20) // len(edges))
    for start in range(0, len(heights) - 1, step):
        low, high = heights[start : start + step + 1][:-1], heights[start : start + step + 1][1:]
        slab, edge = np.nonzero((ya <= low[:, None]) & (yb >= high[:, None]))
        x0 = xa[edge] + slope[edge] * (low[slab] - ya[edge])
        x1 = xa[edge] + slope[edge] * (high[slab] - ya[edge])
        order = np.lexsort((x0 + x1, slab))
        slab, edge, x0, x1 = slab[order], edge[order], x0[order], x1[order]
        # Of a polygon's edges in a slab every other one enters it, from the left.
        group = slab * len(pieces) + of[edge]
        by_group = np.argsort(group, kind="stable")
        first = np.flatnonzero(np.diff(group[by_group], prepend=-1))
        place = np.arange(len(group)) - np.repeat(first, np.diff(first, append=len(group)))
        enters = np.empty(len(group), dtype=np.int64)
        enters[by_group] = np.where(place % 2 == 0, 1, -1)
        left = np.flatnonzero((np.cumsum(enters) > 0)[:-1] & (slab[1:] == slab[:-1]))
        h, y0 = (high - low)[slab[left]], low[slab[left]]
        l0, l1, r0, r1 = x0[left], x1[left], x0[left + 1], x1[left + 1]
        w0, w1 = r0 - l0, r1 - l1
        total += (
            np.sum(h * (w0 + w1) / 2),
            np.sum(h * (r0 * r0 + r0 * r1 + r1 * r1 - l0 * l0 - l0 * l1 - l1 * l1) / 6),
            np.sum(h * (y0 * (w0 + w1) / 2 + h * (w0 / 6 + w1 / 3))),
        )
    return total


def _scan(table: pa.Table) -> pa.Table:
    """Moments of what is covered in some cells, added up."""
    x, y = table.column("x").to_numpy(), table.column("y").to_numpy()
    side = table.column("side").to_numpy()
    rings = table.column("rings")
    order = np.lexsort((side, y, x))
    new = np.flatnonzero(np.concatenate([[True], (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0) | (np.diff(side[order]) != 0)]))
    found = []
    for rows in np.split(order, new[1:]):
        corner = np.array([x[rows[0]], y[rows[0]]])
        pieces = [[ring.values.to_numpy().reshape(-1, 2) - corner for ring in rings[int(row)]] for row in rows]
        area, mx, my = covered_moments(pieces)
        found.append((area, mx + area * corner[0], my + area * corner[1]))
    return pa.table({name: pa.array(values) for name, values in zip(("area", "mx", "my"), zip(*found, strict=True), strict=True)})


def union_moments(features: DataFrame) -> DataFrame:
    """One row with ``area``, ``mx`` and ``my`` of what all Polygons and MultiPolygons cover together, also those in
    collections; NULL if there are none.

    Moments are in the lon/lat plane. Copies of a polygon, and pieces that are alike in a cell, go on as one. Polygons
    with a vertex that isn't two numbers are left out.
    """
    one = features.select(F.explode(area_polygons(F.col("geometry"))).alias("polygon"))
    flat = F.transform("polygon", lambda ring: F.flatten(F.transform(ring, lambda v: F.array(F.get(v, 0), F.get(v, 1)))))
    shapes = one.select(flat.alias("rings")).where(~F.exists("rings", lambda ring: F.exists(ring, lambda v: v.isNull() | F.isnan(v))))
    ordinates = F.flatten("rings")
    xs, ys = (F.filter(ordinates, lambda v, i: i % 2 == odd) for odd in (0, 1))
    measures = {"n": F.sum(F.size(ordinates)) / 2, "west": F.min(F.array_min(xs)), "south": F.min(F.array_min(ys))}
    measures |= {"east": F.max(F.array_max(xs)), "north": F.max(F.array_max(ys))}
    box = shapes.agg(*[measure.alias(name) for name, measure in measures.items()]).first()
    root = max(box["east"] - box["west"], box["north"] - box["south"]) if box["n"] else 0.0
    if not root:
        return features.sparkSession.createDataFrame([(None, None, None)], _MOMENTS)
    by = max(1, min(DIVIDE, math.ceil(math.sqrt(box["n"] / (CELL_EDGES / 4)))))
    cells = {"x": F.lit(box["west"]), "y": F.lit(box["south"]), "side": F.lit(root), "by": F.lit(by)}
    found: list[DataFrame] = []
    todo = shapes.select(*[value.alias(name) for name, value in cells.items()], "rings")
    while True:
        cell = ("x", "y", "side")
        pieces = stored(todo.mapInArrow(_divide, _PIECES).dropDuplicates([*cell, "rings", "whole"]))
        per_cell = pieces.groupBy(*cell).agg(F.bool_or("whole").alias("covered"), F.sum("edges").alias("edges_all"))
        is_large = F.col("edges_all") > (CELL_EDGES if len(found) < 2 * DIVISIONS else math.inf)
        kind = F.when(F.col("covered"), 0).when(is_large, 2).otherwise(1).alias("kind")
        of_kind = lambda n, value: F.sum(F.when(F.col("kind") == n, value))
        sizes, seen = stored_and_observed(per_cell.select(*cell, "edges_all", kind), scan=of_kind(1, F.col("edges_all")), divide=of_kind(2, 1))
        s, mid_x, mid_y = F.col("side"), F.col("x") + F.col("side") / 2, F.col("y") + F.col("side") / 2
        found.append(sizes.where("kind = 0").select((s * s).alias("area"), (s * s * mid_x).alias("mx"), (s * s * mid_y).alias("my")))
        known = pieces.join(sizes, list(cell))
        tasks = max(1, math.ceil((seen["scan"] or 0) / TASK_EDGES))
        scanned = known.where("kind = 1").select(*cell, "rings", F.pmod(F.xxhash64(*cell), F.lit(tasks)).alias("task"))
        found.append(stored(scanned.groupBy("task").applyInArrow(_scan, _MOMENTS)))
        if not seen["divide"]:
            break
        parts = F.ceil(F.sqrt(F.col("edges_all") / (CELL_EDGES / 4)))
        todo = known.where("kind = 2").select(*cell, F.least(F.lit(DIVIDE), F.greatest(F.lit(2), parts)).cast("int").alias("by"), "rings")
    moments = found[0]
    for part in found[1:]:
        moments = moments.union(part)
    return moments.agg(*[F.sum(name).alias(name) for name in ("area", "mx", "my")])
