"""Map layers as tables: what is drawn where, in which colour and with which text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.colors import MISSING_COLOR, class_color, class_index, ramp_color
from ..functions.geometry import label_point
from ..functions.labels import area_label, bid_popup
from ..functions.numbers import nan_to_null, quoted
from .joins import lookup_stats
from .stats import metric_domain

# Layer names, tooltip titles and opacities (with a value, without one).
LAYER_MEDIAN = "Сделки: медиана цены за кв.м"
LAYER_ARITH_MEAN = "Сделки: среднее арифм. цены за кв.м"
LAYER_GEOM_MEAN = "Сделки: среднее геом. цены за кв.м"
LAYER_BIDS = "Предложения (точки)"
LAYER_LABELS = "Подписи"
TITLE_KEY = "Кадастровый квартал"
TITLE_DEALS = "Сделок"
AREA_OPACITY = (0.65, 0.1)
CLASS_OPACITY = 0.7


def _bounds(domain: DataFrame) -> Column:
    """The one row of a domain as a scalar subquery: computed once, no join."""
    return domain.select(F.struct(*domain.columns)).scalar()


def color_ramp(
    df: DataFrame,
    metric: str,
    domain: DataFrame,
    palette: str = "YlOrRd",
    missing: str = MISSING_COLOR,
    opacity: tuple[float, float] = AREA_OPACITY,
) -> DataFrame:
    """Add ``fill_color`` and ``fill_opacity`` of a metric on the scale of ``domain`` (``lo``, ``hi``)."""
    return _ramp(df.withColumn("_scale", _bounds(domain)), metric, palette, missing, opacity).drop("_scale")


def _ramp(df: DataFrame, metric: str, palette: str, missing: str, opacity: tuple[float, float]) -> DataFrame:
    valued = df.withColumn("_value", nan_to_null(F.col(quoted(metric)).cast("double")))
    colored = ramp_color(valued, "_color", "_value", "_scale.lo", "_scale.hi", palette)
    style = {
        "fill_color": F.coalesce("_color", F.lit(missing)),
        "fill_opacity": F.when(F.col("_value").isNotNull(), opacity[0]).otherwise(opacity[1]),
    }
    return colored.withColumns(style).drop("_value", "_color")


def class_bins(df: DataFrame, metric: str, domain: DataFrame, classes: int = 6) -> DataFrame:
    """Add ``class`` (0 to ``classes - 1``, NULL if missing), ``fill_color`` and ``fill_opacity``."""
    value = nan_to_null(F.col(quoted(metric)).cast("double"))
    index = class_index("_value", "_scale.lo", "_scale.hi", classes)
    return (
        df.withColumns({"_scale": _bounds(domain), "_value": value})
        .withColumn("class", index)
        .withColumns({"fill_color": class_color("class", classes), "fill_opacity": F.lit(CLASS_OPACITY)})
        .drop("_scale", "_value")
    )


def tooltip(fields: Mapping[str, str]) -> Column:
    """Named columns under their display titles, as a map of texts."""
    pairs = [part for name, title in fields.items() for part in (F.lit(title), F.col(quoted(name)).cast("string"))]
    return F.create_map(*pairs)


def area_layers(
    features: DataFrame,
    metrics: DataFrame,
    layers: Mapping[str, str],
    palette: str = "YlOrRd",
    opacity: tuple[float, float] = AREA_OPACITY,
    count_title: str = TITLE_DEALS,
    how: str = "left",
    unique: bool = False,
) -> DataFrame:
    """One coloured row per feature and metric; ``layers`` maps each metric to the name of its layer.

    The scale of a metric spans all areas in ``metrics``, also those without a feature; a metric without any
    value has no layer. All metrics come from one join and all scales from one aggregate. ``metrics`` is read
    twice, so pass a stored table.
    """
    joined = lookup_stats(features, metrics, [*layers, "count"], how=how, unique=unique)
    domain = metrics.agg(
        *[F.struct(F.min(nan_to_null(F.col(m).cast("double"))).alias("lo"),
                   F.max(nan_to_null(F.col(m).cast("double"))).alias("hi")).alias(m) for m in layers]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("layer"),
                F.col(metric).cast("double").alias("value"),
                F.col(f"_scales.{metric}").alias("_scale"),
                tooltip({"cadnum": TITLE_KEY, metric: name, "count": count_title}).alias("tooltip"),
            )
            for metric, name in layers.items()
        ]
    )
    spread = joined.withColumn("_scales", _bounds(domain)).select("cadnum", "geometry", "count", F.inline(rows))
    colored = _ramp(spread.where("_scale.lo is not null"), "value", palette, MISSING_COLOR, opacity)
    return colored.select(
        "layer", "cadnum", "geometry", "value", "count", "fill_color", "fill_opacity", "tooltip"
    )


def median_layers(
    shown: DataFrame,
    sides: Mapping[str, tuple[str, DataFrame]],
    title: str,
    palette: str = "YlOrRd",
    long: bool = False,
) -> DataFrame:
    """Areas coloured by their median and their labels, for one map or several, in one pass over the features.

    ``shown`` has ``cadnum``, ``geometry`` and, for each map in ``sides``, ``median``, ``median_round`` and ``count``
    with the suffix named there; the metrics beside it give the scale. The rows have the name of their ``map``; those of the
    layer ``title`` are areas, those of ``LAYER_LABELS`` are texts at the means of the vertices.
    """
    located = shown.withColumn("_at", label_point(F.col("geometry")))
    rows = []
    for name, (suffix, metrics) in sides.items():
        located = located.withColumn(f"_scale{suffix}", _bounds(metric_domain(metrics, "median")))
        median, whole, n = (f"{column}{suffix}" for column in ("median", "median_round", "count"))
        area = {
            "map": F.lit(name),
            "layer": F.lit(title),
            "geometry": F.col("geometry"),
            "value": F.col(median),
            "median_round": F.col(whole),
            "count": F.col(n),
            "_scale": F.col(f"_scale{suffix}"),
            "tooltip": tooltip({"cadnum": TITLE_KEY, whole: title, n: "Количество"}),
            "lat": F.lit(None).cast("double"),
            "lon": F.lit(None).cast("double"),
            "text": F.lit(None).cast("string"),
        }
        text = area_label(F.col("cadnum"), F.col(whole), F.col(n), long)
        label = {"layer": F.lit(LAYER_LABELS), "lat": F.col("_at.lat"), "lon": F.col("_at.lon"), "text": text}
        kept = {"map", "layer", "lat", "lon", "text"}
        rows.append(F.struct(*[column.alias(key) for key, column in area.items()]))
        rows.append(
            F.struct(*[label.get(key, column if key in kept else F.when(F.lit(False), column)).alias(key) for key, column in area.items()])
        )
    spread = located.select("cadnum", F.inline(F.array(*rows)))
    colored = _ramp(spread, "value", palette, MISSING_COLOR, AREA_OPACITY)
    is_area = F.col("layer") == title
    style = {name: F.when(is_area, F.col(name)) for name in ("fill_color", "fill_opacity")}
    return colored.withColumns(style).select(
        "map", "layer", "cadnum", "geometry", "value", "median_round", "count", *style, "tooltip", "lat", "lon", "text"
    )


def bids_layer(
    bids: DataFrame,
    palette: str | None,
    opacity: float,
    address: str,
    price: str | None = None,
    name: str = LAYER_BIDS,
    domain: DataFrame | None = None,
) -> DataFrame:
    """One point per offer with its popup; coloured by price per square metre, or black without a palette.

    The scale is ``domain``, a row with ``lo`` and ``hi``, or that of the offers, for which they are read once more.
    """
    if palette is None:
        colored = bids.withColumns({"fill_color": F.lit("black"), "fill_opacity": F.lit(opacity)})
    else:
        domain = metric_domain(bids, "price_per_sqm") if domain is None else domain
        colored = color_ramp(bids, "price_per_sqm", domain, palette, opacity=(opacity, opacity))
    popup = bid_popup(F.col(quoted(address)), F.col("price_per_sqm"), F.col(quoted(price)) if price else None)
    return colored.select(
        F.lit(name).alias("layer"),
        "lat",
        "lon",
        F.col("price_per_sqm").alias("value"),
        "fill_color",
        "fill_opacity",
        popup.alias("text"),
    )


def labels_layer(features: DataFrame, long: bool = False, html: bool = False, name: str = LAYER_LABELS) -> DataFrame:
    """One label per feature at the mean of its vertices; needs ``cadnum``, ``median_round``, ``count``."""
    label = area_label(F.col("cadnum"), F.col("median_round"), F.col("count"), long, html)
    return features.withColumn("_at", label_point(F.col("geometry"))).select(
        F.lit(name).alias("layer"), "cadnum", F.col("_at.lat").alias("lat"), F.col("_at.lon").alias("lon"), label.alias("text")
    )
