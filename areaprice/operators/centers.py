"""Map centres: one row with ``lat`` and ``lon``, NULL if there is nothing to centre on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import area_moments, centroid_parts, vertices
from ..functions.numbers import nan_to_null
from ..scratch import stored
from .union import union_moments


def bids_center(bids: DataFrame) -> DataFrame:
    """Mean position of offers."""
    return bids.agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def bids_summary(bids: DataFrame) -> DataFrame:
    """One row about offers: their number ``n``, mean position ``lat`` and ``lon``, price scale ``lo`` and ``hi``."""
    price = nan_to_null(F.col("price_per_sqm").cast("double"))
    return bids.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("lat").alias("lat"),
        F.avg("lon").alias("lon"),
        F.min(price).alias("lo"),
        F.max(price).alias("hi"),
    )


def bbox_center(features: DataFrame) -> DataFrame:
    """Middle of the bounding box of all vertices."""
    points = features.select(vertices(F.col("geometry")).alias("v"))
    lons, lats = F.transform("v", lambda p: F.get(p, 0)), F.transform("v", lambda p: F.get(p, 1))
    # One scalar per feature and bound, so that only four numbers per task reach the shuffle.
    box = points.agg(
        F.min(F.array_min(lats)).alias("south"),
        F.max(F.array_max(lats)).alias("north"),
        F.min(F.array_min(lons)).alias("west"),
        F.max(F.array_max(lons)).alias("east"),
    )
    return box.select(
        ((F.col("south") + F.col("north")) / 2).alias("lat"), ((F.col("west") + F.col("east")) / 2).alias("lon")
    )


def union_center(features: DataFrame, dissolve: bool = True) -> DataFrame:
    """Centroid of all geometries together, in the lon/lat plane.

    Polygons are weighted by area; only if none has any, lines by length, and without these the points. As in a
    geometric union, what several polygons cover counts once, see :func:`~areaprice.operators.union.union_moments`,
    which starts jobs; lines and points that occur twice count once.

    ``dissolve=False`` is one pass without jobs, in which polygons that overlap in part are not dissolved, but one that
    occurs twice counts once: the same for layers without overlaps.
    """
    if dissolve:
        moments = stored(union_moments(features))
        if not moments.where("area > 0").isEmpty():
            return moments.select((F.col("my") / F.col("area")).alias("lat"), (F.col("mx") / F.col("area")).alias("lon"))
    return parts_center(features.select(centroid_parts(F.col("geometry")).alias("parts")))


def parts_center(parts: DataFrame) -> DataFrame:
    """:func:`union_center` from the ``parts`` of each feature, without dissolving. Names and moments are shuffled, no geometry is."""
    numbers = ("weight", "mx", "my")
    single = parts.select(F.inline("parts")).groupBy("dimension", "part").agg(*[F.first(n).alias(n) for n in numbers])
    sums = single.agg(
        *[F.sum(F.when(F.col("dimension") == d, F.col(n))).alias(f"{n}{d}") for d in (2, 1, 0) for n in numbers]
    )

    def middle(moment: str) -> Column:
        return F.coalesce(*[F.when(F.col(f"weight{d}") > 0, F.col(f"{moment}{d}") / F.col(f"weight{d}")) for d in (2, 1, 0)])

    return sums.select(middle("my").alias("lat"), middle("mx").alias("lon"))


def area_centroids(features: DataFrame) -> DataFrame:
    """Features with ``centroid_lon`` and ``centroid_lat`` of their polygons; NULL for other geometries."""
    area = F.nullif(F.col("_m.area"), F.lit(0.0))
    return (
        features.withColumn("_m", area_moments(F.col("geometry")))
        .withColumns({"centroid_lon": F.col("_m.mx") / area, "centroid_lat": F.col("_m.my") / area})
        .drop("_m")
    )
