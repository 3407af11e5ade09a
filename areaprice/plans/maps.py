"""Whole maps: each function turns tables and features into layer tables and a map centre."""

from __future__ import annotations

import functools
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import centroid_parts
from ..functions.keys import KEY_PATHS
from ..functions.numbers import number_of, quoted
from ..operators.centers import bbox_center, bids_summary, parts_center, union_center
from ..operators.clean import PERIOD, YEARS, clean_prices, filter_period, require_columns, require_rows
from ..operators.joins import join_features, lookup_stats, with_area_key
from ..operators.layers import (
    LAYER_ARITH_MEAN,
    LAYER_GEOM_MEAN,
    LAYER_MEDIAN,
    area_layers,
    bids_layer,
    class_bins,
    median_layers,
    tooltip,
)
from ..operators.stats import area_median, area_stats, metric_domain
from ..scratch import stored
from ..sources.tables import AREA_KEY, BID_ADDRESS, BID_PRICE, PRICE

# Layer names and titles that differ from map to map.
HEAT_LAYERS = {
    "arith_mean": "Среднее арифм. цены сделок",
    "geom_mean": "Среднее геом. цены сделок",
    "median": "Медиана цены сделок",
}
METRIC_LAYERS = {"median": LAYER_MEDIAN, "arith_mean": LAYER_ARITH_MEAN, "geom_mean": LAYER_GEOM_MEAN}
MEDIAN_TITLE = "Медиана цены за кв.м"


class MapLayers(NamedTuple):
    """Content of a map: coloured areas, points with texts (offers or labels) and the centre.

    ``together`` has the rows of all layers where one pass over the features makes them.
    """

    areas: DataFrame
    points: DataFrame | None
    center: DataFrame
    together: DataFrame | None = None

    def rows(self) -> DataFrame:
        """All layers in one table, ready for ``write_layer``."""
        if self.together is not None:
            return self.together
        parts = [part for part in (self.areas, self.points) if part is not None]
        return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


class TwoMaps(NamedTuple):
    """Two maps of the same areas. ``together`` has the rows of both, told apart by ``map``, in one pass."""

    first: MapLayers
    second: MapLayers
    together: DataFrame


def _keyed(features: DataFrame) -> DataFrame:
    """Features that already carry their key, as a column or as the property ``cadnum``."""
    return features if "cadnum" in features.columns else with_area_key(features, ("$.cadnum", *KEY_PATHS))


def _median_map(rows: DataFrame, name: str, center: DataFrame) -> MapLayers:
    """One of the maps in the rows of :func:`median_layers`."""
    own = rows.where(F.col("map") == name).drop("map")
    is_area = F.col("layer") == MEDIAN_TITLE
    areas = own.where(is_area).drop("lat", "lon", "text")
    return MapLayers(areas, own.where(~is_area).select("layer", "cadnum", "lat", "lon", "text"), center, own)


def map_quick(
    features: DataFrame,
    table: DataFrame,
    on: str,
    value_column: str | None = None,
    tooltip_columns: Iterable[str] = (),
    classes: int = 6,
    unique: bool = False,
    dissolve: bool = False,
) -> MapLayers:
    """Any table joined to any features on a key, coloured by classes of one column; no features are an error.

    The features are read for the rows and, once before, for what is needed of them all: the keys that belong to
    the scale, and the centre. ``unique=True`` says that no key occurs twice in the table, which saves another pass.
    ``dissolve=True`` is for features that overlap: what several cover counts once for the centre, see
    :func:`~areaprice.operators.centers.union_center`.
    """
    columns = [F.col(quoted(on)).alias("key"), centroid_parts(F.col("geometry")).alias("parts")]
    known = require_rows(stored(features.select(columns)), "No features")
    joined = join_features(features, table, on, unique=unique)
    areas = joined
    if value_column:
        values = table if value_column in table.columns else features
        on_map = values.join(known.select(F.col("key").alias("_known")).distinct(), F.col(quoted(on)) == F.col("_known"), "left_semi")
        scale = metric_domain(on_map.select(number_of(values, value_column).alias("value")), "value")
        areas = areas.withColumn(value_column, number_of(joined, value_column))
        areas = class_bins(areas, value_column, scale, classes)
    tooltip_columns = list(tooltip_columns)
    if tooltip_columns:
        require_columns(joined, tooltip_columns, "joined table")
        areas = areas.withColumn("tooltip", tooltip({name: name for name in tooltip_columns}))
    # A left join keeps every feature, so the features alone give the centre of the joined map.
    return MapLayers(areas, None, union_center(features) if dissolve else parts_center(known))


def map_deals_bids(deals: DataFrame, bids: DataFrame, features: DataFrame) -> MapLayers:
    """Mean, geometric mean and median of deals per area, and the offers on a scale of their own."""
    metrics = stored(area_stats(clean_prices(deals)))
    # Areas with deals and their statistics in one step: the keys of the metrics are those of the deals.
    areas = area_layers(
        with_area_key(features), metrics, HEAT_LAYERS, opacity=(0.7, 0.2), count_title="Число сделок", how="inner", unique=True
    )
    summary = stored(bids_summary(bids))
    points = bids_layer(bids, "Blues", 0.8, BID_ADDRESS, domain=summary.select("lo", "hi"))
    return MapLayers(areas, points, summary.select("lat", "lon"))


def map_bids(bids: DataFrame, metrics: DataFrame | None, features: DataFrame | None) -> MapLayers:
    """Offers on a bright scale over the three deal metrics, if those and the features are there."""
    summary = stored(bids_summary(bids))
    require_rows(summary.where("n > 0"), "No offers with coordinates and price")
    points = bids_layer(bids, "YlOrRd", 0.9, BID_ADDRESS, BID_PRICE, domain=summary.select("lo", "hi"))
    areas = None
    if metrics is not None and features is not None:
        require_columns(metrics, [AREA_KEY, *METRIC_LAYERS, "count"], "metrics")
        areas = area_layers(_keyed(features), metrics, METRIC_LAYERS, opacity=(0.6, 0.1))
    return MapLayers(areas, points, summary.select("lat", "lon"))


def map_median(metrics: DataFrame, features: DataFrame) -> MapLayers:
    """Median layer alone, from metrics that were read or computed."""
    areas = area_layers(_keyed(features), metrics, {"median": LAYER_MEDIAN})
    return MapLayers(areas, None, bbox_center(features))


def map_median_bids(metrics: DataFrame, bids: DataFrame, features: DataFrame) -> MapLayers:
    """Median layer under black points of offers."""
    below = map_median(metrics, features)
    return below._replace(points=bids_layer(bids, None, 0.9, BID_ADDRESS, BID_PRICE))


def map_two_periods(deals_a: DataFrame, deals_b: DataFrame, features: DataFrame) -> TwoMaps:
    """Two maps, ``a`` and ``b``, of the same areas, those with deals in either period, each on its own scale."""
    both = _medians_by_side(a=deals_a, b=deals_b)
    shown = with_area_key(features.where("geometry is not null"))
    shown = lookup_stats(shown, both, how="inner", unique=True)
    center = bbox_center(shown)
    scales = {side: (f"_{side}", both.select(F.col(f"median_{side}").alias("median"))) for side in "ab"}
    rows = median_layers(shown, scales, MEDIAN_TITLE, long=True)
    return TwoMaps(_median_map(rows, "a", center), _median_map(rows, "b", center), rows)


def _medians_by_side(**sides: DataFrame) -> DataFrame:
    """Medians and counts per area of several tables of deals, in one pass over each: a column per table and figure."""
    tagged = [
        clean_prices(deals, policy="present").select(
            F.struct(F.lit(side).alias("side"), F.col(AREA_KEY).alias("area")).alias("_side_area"), PRICE
        )
        for side, deals in sides.items()
    ]
    found = area_median(functools.reduce(DataFrame.unionByName, tagged), "_side_area", PRICE)
    columns = [
        F.max(F.when(F.col("_side_area.side") == side, F.col(name))).alias(f"{name}_{side}")
        for side in sides
        for name in ("median", "median_round", "count")
    ]
    return stored(found.groupBy(F.col("_side_area.area").alias(AREA_KEY)).agg(*columns))


def map_labeled(
    deals: DataFrame,
    features: DataFrame,
    palette: str = "YlOrRd",
    years: tuple[int, int] | None = None,
    period: str | None = None,
) -> MapLayers:
    """Median layer with short labels, after an optional filter by building year and period."""
    metrics = area_median(clean_prices(filter_period(deals, years, period)))
    metrics = require_rows(stored(metrics), "No deals left after filtering")
    shown = lookup_stats(with_area_key(features.where("geometry is not null")), metrics, how="inner", unique=True)
    rows = median_layers(shown, {"": ("", metrics)}, MEDIAN_TITLE, palette)
    return _median_map(rows, "", bbox_center(shown))


def map_labeled_filtered(deals: DataFrame, features: DataFrame, period: str = PERIOD) -> MapLayers:
    """The labelled map in grey for buildings of 1964 to 1972 and one period."""
    return map_labeled(deals, features, "Greys", YEARS, period)
