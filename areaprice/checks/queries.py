"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions.keys import key_suffix
from ..functions.labels import area_label, bid_popup
from ..functions.numbers import lenient_double, quoted
from ..operators import centers, joins, layers, stats
from ..operators.clean import clean_prices, filter_period
from ..plans import maps
from ..scratch import scratch_path, stored
from ..sources import features as feature_source
from ..sources import sinks, updates
from ..sources import tables as sources
from . import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PERIOD = "01.07.1999"
CENTER_POINT = (60.009376, 30.400951)
CLASSES = 6


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(**columns: int) -> list[Column]:
    """Computed doubles rounded, for the last digit of a sum depends on the order of its terms."""
    return [F.round(name, digits).alias(name) for name, digits in columns.items()]


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_prices(tables.deals(spark, sf_dir))


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.clean_bids(tables.raw_bids(spark, sf_dir))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(stats.area_stats(priced(spark, sf_dir)))


def median_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(stats.area_median(priced(spark, sf_dir)))


def value() -> Column:
    """Value of a layer: medians are exact, the means that share a column with them are rounded."""
    medians = layers.LAYER_MEDIAN, maps.HEAT_LAYERS["median"], maps.MEDIAN_TITLE
    exact = F.col("layer").isin(*medians)
    return F.when(exact, F.col("value")).otherwise(F.round("value", 4)).alias("value")


STAT_COLUMNS = ["quarter_cad_number", "median", "count"]
AREA_COLUMNS = ["layer", "cadnum", "count", "fill_color", "fill_opacity"]


# Scans and sources


@query
def read_table(spark, sf_dir):
    table = tables.area_table(spark, sf_dir)
    paths = {kind: f"{scratch_path(spark)}.{kind}" for kind in ("csv", "tsv", "parquet")}
    sinks.write_csv(table, paths["csv"])
    sinks.write_csv(table, paths["tsv"], sep="\t")
    table.write.parquet(paths["parquet"])
    read = {kind: sources.read_table(spark, path) for kind, path in paths.items()}
    parts = [
        part.select(F.lit(kind).alias("format"), "cadnum", *[F.col(c).cast("double").alias(c) for c in ("val", "x0")])
        for kind, part in read.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def read_deals(spark, sf_dir):
    path = sinks.write_csv(tables.deals(spark, sf_dir), scratch_path(spark), sep=";")
    return sources.read_deals(spark, path)


@query
def read_cp1251(spark, sf_dir):
    path = sinks.write_csv(tables.deals(spark, sf_dir), scratch_path(spark), sep=";", encoding="cp1251")
    return sources.read_deals(spark, path, encoding="cp1251")


@query
def read_probed(spark, sf_dir):
    deals = tables.deals(spark, sf_dir)
    old = sinks.write_csv(deals, scratch_path(spark), sep=";", encoding="cp1251")
    new = sinks.write_csv(deals, scratch_path(spark))
    read = {"old": sources.read_probed(spark, old), "new": sources.read_probed(spark, new)}
    parts = [part.withColumn("file", F.lit(name)) for name, part in read.items()]
    return parts[0].unionByName(parts[1])


@query
def read_bids(spark, sf_dir):
    path = sinks.write_csv(tables.raw_bids(spark, sf_dir), scratch_path(spark))
    return sources.read_bids(spark, path).select(F.col("Адрес").alias("address"), "lat", "lon", "price_per_sqm")


@query
def read_metrics(spark, sf_dir):
    path = sinks.write_csv(metrics(spark, sf_dir), scratch_path(spark) + ".csv")
    read = sources.read_metrics(spark, path)
    return read.select("quarter_cad_number", "median", *rounded(arith_mean=4, geom_mean=4), "count")


@query
def metrics_reuse(spark, sf_dir):
    deals = priced(spark, sf_dir)
    path = scratch_path(spark) + ".parquet"
    computed = sources.metrics_or_compute(spark, path, deals)
    computed.write.parquet(path)
    return sources.metrics_or_compute(spark, path, deals).select(STAT_COLUMNS)


@query
def metrics_updated(spark, sf_dir):
    """Statistics of files that come one after the other, each of which is counted once."""
    deals = tables.deals(spark, sf_dir)
    path, store = scratch_path(spark), scratch_path(spark)
    for part in ("floor <= 2", "floor between 3 and 4", "floor > 4"):
        sinks.write_csv(deals.where(part), path, sep=";", mode="append")
        found = updates.updated_metrics(spark, path, store)
    return found.select("quarter_cad_number", "median", *rounded(arith_mean=4, geom_mean=4), "count")


@query
def read_geojson(spark, sf_dir):
    return _read_geojson(spark, sinks.write_features(tables.features(spark, sf_dir), scratch_path(spark)), lines=True)


@query
def read_geojson_collections(spark, sf_dir):
    path = sinks.write_features(tables.features(spark, sf_dir), scratch_path(spark), collections=True, lineSep=" ")
    return _read_geojson(spark, path)


def _read_geojson(spark, path, lines=False):
    read = feature_source.read_features(spark, path, lines=lines, id_column="label", properties=["externalKey", "options"])
    return joins.with_area_key(read).select(
        "id",
        "type",
        "label",
        "externalKey",
        F.get_json_object("options", "$.cad_num").alias("cad_num"),
        "cadnum",
        F.col("geometry.type").alias("kind"),
        geo.vertex_count(F.col("geometry")).alias("n"),
    )


# Sinks


@query
def write_csv(spark, sf_dir):
    path = sinks.write_csv(tables.raw_bids(spark, sf_dir), scratch_path(spark))
    back = sources.read_delimited(spark, path)
    names = {"Адрес": "address", "Широта": "lat", "Долгота": "lon", "Цена, руб": "price", "Цена за кв.м, руб.": "price_raw"}
    kinds = {"lat": "double", "lon": "double", "price": "bigint"}
    return back.select([F.col(quoted(old)).cast(kinds.get(new, "string")).alias(new) for old, new in names.items()])


@query
def write_geojson(spark, sf_dir):
    joined = joins.lookup_stats(joins.with_area_key(tables.features(spark, sf_dir)), median_metrics(spark, sf_dir), unique=True)
    path = sinks.write_features(joined, scratch_path(spark), ["cadnum", "median_round", "count"])
    line = spark.read.text(path)
    fields = {
        "id": "$.id", "kind": "$.geometry.type", "coordinates": "$.geometry.coordinates", "cadnum": "$.properties.cadnum", "label": "$.properties.label",
        "median_round": "$.properties.median_round", "count": "$.properties.count",
    }
    nulls = F.col("value").contains('"median_round":null').alias("null_kept")
    read = line.select(*[F.get_json_object("value", p).alias(name) for name, p in fields.items()], nulls)
    shape = F.struct(F.col("kind").alias("type"), "coordinates")
    spot = geo.label_point(shape)
    written = {"n": geo.vertex_count(shape), "lon": F.round(spot["lon"], 9), "lat": F.round(spot["lat"], 9)}
    return read.withColumns(written).drop("coordinates")


@query
def write_layer(spark, sf_dir):
    areas = layers.area_layers(tables.keyed_features(spark, sf_dir), metrics(spark, sf_dir), maps.METRIC_LAYERS, unique=True)
    path = sinks.write_layer(areas, scratch_path(spark))
    return spark.read.parquet(path).select(*AREA_COLUMNS, value())


# Cleaning and filters


@query
def lenient_number(spark, sf_dir):
    return tables.deals(spark, sf_dir).select(
        "quarter_cad_number", "year_build", lenient_double(F.col("price_per_sqm")).alias("price")
    )


@query
def bids_clean(spark, sf_dir):
    return bids(spark, sf_dir).select(F.col("Адрес").alias("address"), "lat", "lon", "price_per_sqm")


@query
def bid_popups(spark, sf_dir):
    price = F.col("price_per_sqm")
    return bids(spark, sf_dir).select(
        "lat",
        "lon",
        bid_popup(F.col("Адрес"), price).alias("short_text"),
        bid_popup(F.col("Адрес"), price, F.col("`Цена, руб`")).alias("text"),
    )


# Statistics


def _all_stats(deals: DataFrame) -> DataFrame:
    all_stats = stats.with_median_round(stats.area_stats(deals))
    return all_stats.select(
        "quarter_cad_number", *rounded(arith_mean=4, geom_mean=4), "median", "median_round", "count"
    )


@query
def area_stats(spark, sf_dir):
    return _all_stats(priced(spark, sf_dir))


@query
def area_stats_all_prices(spark, sf_dir):
    return _all_stats(clean_prices(tables.deals(spark, sf_dir), policy="present"))


@query
def area_stats_filtered(spark, sf_dir):
    return _all_stats(clean_prices(filter_period(tables.deals(spark, sf_dir), (1964, 1972), PERIOD)))


@query
def area_stats_on_dates(spark, sf_dir):
    deals = tables.deals(spark, sf_dir)
    dated = deals.withColumn("period_start_date", F.to_date("period_start_date", "dd.MM.yyyy"))
    return _all_stats(clean_prices(filter_period(dated, (1964, 1972), PERIOD)))


@query
def area_median(spark, sf_dir):
    return stats.area_median(priced(spark, sf_dir))


@query
def metric_domain(spark, sf_dir):
    return stats.metric_domain(median_metrics(spark, sf_dir), "median")


@query
def area_keys(spark, sf_dir):
    return stats.area_keys(priced(spark, sf_dir))


def _periods(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    deals = tables.deals(spark, sf_dir)
    return deals.where("year_build <= 1969"), deals.where("year_build >= 1970")


@query
def keys_union(spark, sf_dir):
    early, late = (clean_prices(part, policy="present") for part in _periods(spark, sf_dir))
    return stats.keys_union(early, late)


@query
def bids_center(spark, sf_dir):
    return centers.bids_center(bids(spark, sf_dir)).select(rounded(lat=9, lon=9))


# Keys and joins


@query
def feature_key(spark, sf_dir):
    keyed = joins.with_area_key(tables.features(spark, sf_dir))
    return keyed.select("id", "cadnum", key_suffix(F.col("cadnum")).alias("suffix"))


@query
def features_with_deals(spark, sf_dir):
    keyed = joins.with_area_key(tables.features(spark, sf_dir))
    return joins.features_with_keys(keyed, stats.area_keys(priced(spark, sf_dir))).select("id", "cadnum")


def _join_query(how: str) -> Query:
    def run(spark, sf_dir):
        left = tables.keyed_features(spark, sf_dir).select("id", "cadnum", "x0", "y0")
        return joins.join_features(left, tables.area_table(spark, sf_dir), "cadnum", how)

    return run


QUERIES.update({f"join_features_{how}": _join_query(how) for how in joins.HOW})


@query
def join_features_hot_keys(spark, sf_dir):
    """Outer join of deals, most of which have one of a few keys, with a table that has some of these keys twice."""
    deals = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("l_returnflag as flag", "l_orderkey", "l_linenumber")
    flags = spark.read.parquet(f"{sf_dir}/region.parquet").selectExpr(
        "case r_regionkey when 0 then 'A' when 1 then 'R' when 2 then 'X' when 3 then 'A' end as flag", "r_name as name"
    )
    return joins.join_features(deals, flags, "flag", "outer")


# Geometry


@query
def vertex_count(spark, sf_dir):
    return tables.features(spark, sf_dir).select("id", geo.vertex_count(F.col("geometry")).alias("n"))


@query
def label_point(spark, sf_dir):
    located = tables.features(spark, sf_dir).withColumn("at", geo.label_point(F.col("geometry")))
    return located.select("id", F.round("at.lon", 9).alias("lon"), F.round("at.lat", 9).alias("lat"))


@query
def area_centroid(spark, sf_dir):
    return centers.area_centroids(tables.features(spark, sf_dir)).select("id", *rounded(centroid_lon=9, centroid_lat=9))


@query
def bbox_center(spark, sf_dir):
    return centers.bbox_center(tables.features(spark, sf_dir)).select(rounded(lat=9, lon=9))


@query
def union_center(spark, sf_dir):
    return centers.union_center(tables.features(spark, sf_dir), dissolve=False).select(rounded(lat=9, lon=9))


@query
def union_center_dissolved(spark, sf_dir):
    return centers.union_center(tables.features(spark, sf_dir)).select(rounded(lat=9, lon=9))


@query
def distance_from_point(spark, sf_dir):
    position = F.col("`Широта`"), F.col("`Долгота`")
    return tables.raw_bids(spark, sf_dir).select(
        F.col("Адрес").alias("address"), F.round(geo.distance_m(*position, *CENTER_POINT), 4).alias("distance_m")
    )


# Colours, labels and layers


@query
def color_ramp(spark, sf_dir):
    medians = median_metrics(spark, sf_dir)
    domain = stats.metric_domain(medians, "median")
    return layers.color_ramp(medians, "median", domain).select(*STAT_COLUMNS, "fill_color", "fill_opacity")


@query
def class_bins(spark, sf_dir):
    medians = median_metrics(spark, sf_dir)
    joined = joins.lookup_stats(tables.keyed_features(spark, sf_dir), medians, ["median"], unique=True)
    binned = layers.class_bins(joined, "median", stats.metric_domain(medians, "median"), CLASSES)
    return binned.select("cadnum", "median", "class", "fill_color", "fill_opacity")


@query
def area_layer(spark, sf_dir):
    areas = layers.area_layers(
        tables.keyed_features(spark, sf_dir), median_metrics(spark, sf_dir), {"median": layers.LAYER_MEDIAN}
    )
    return areas.select(*AREA_COLUMNS, "value")


@query
def layer_tooltip(spark, sf_dir):
    joined = joins.lookup_stats(tables.keyed_features(spark, sf_dir), median_metrics(spark, sf_dir), unique=True)
    fields = {"cadnum": layers.TITLE_KEY, "median_round": maps.MEDIAN_TITLE, "count": "Количество"}
    texts = joined.select(layers.tooltip(fields).alias("t"))
    return texts.select([F.col("t")[title].alias(name) for name, title in fields.items()])


def _labels(spark: SparkSession, sf_dir: str, long: bool) -> DataFrame:
    joined = joins.lookup_stats(
        joins.with_area_key(tables.features(spark, sf_dir)), median_metrics(spark, sf_dir), unique=True
    )
    parts = F.col("cadnum"), F.col("median_round"), F.col("count"), long
    return joined.select("id", area_label(*parts).alias("text"), area_label(*parts, html=True).alias("html"))


@query
def area_labels(spark, sf_dir):
    return _labels(spark, sf_dir, long=False)


@query
def area_labels_long(spark, sf_dir):
    return _labels(spark, sf_dir, long=True)


# Whole maps, all layers of a map in one table with its centre


def _map_rows(rows: DataFrame, center: DataFrame, *others: str) -> DataFrame:
    empty = {"cadnum": "string", "count": "bigint", "lat": "double", "lon": "double", "text": "string"}
    rows = rows.withColumns({name: F.lit(None).cast(kind) for name, kind in empty.items() if name not in rows.columns})
    for missing, kind in (("fill_color", "string"), ("fill_opacity", "double"), ("value", "double")):
        if missing not in rows.columns:
            rows = rows.withColumn(missing, F.lit(None).cast(kind))
    middle = center.select(F.struct(F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))).scalar()
    return rows.withColumn("center", middle).select(
        *others,
        *AREA_COLUMNS,
        value(),
        *rounded(lat=9, lon=9),
        "text",
        F.col("center.lat").alias("center_lat"),
        F.col("center.lon").alias("center_lon"),
    )


@query
def map_quick(spark, sf_dir):
    table = tables.area_table(spark, sf_dir)
    shapes = tables.keyed_features(spark, sf_dir)
    built = maps.map_quick(shapes, table, "cadnum", "val", ["cadnum", "val"], CLASSES, unique=True)
    center = built.center.select(F.struct("lat", "lon")).scalar()
    return built.areas.withColumn("center", center).select(
        "cadnum",
        "val",
        "class",
        "fill_color",
        "fill_opacity",
        F.col("tooltip")["cadnum"].alias("tip"),
        F.round("center.lat", 9).alias("center_lat"),
        F.round("center.lon", 9).alias("center_lon"),
    )


def _whole(built: maps.MapLayers) -> DataFrame:
    return _map_rows(built.rows(), built.center)


@query
def map_deals_bids(spark, sf_dir):
    return _whole(maps.map_deals_bids(tables.deals(spark, sf_dir), bids(spark, sf_dir), tables.features(spark, sf_dir)))


@query
def map_bids(spark, sf_dir):
    return _whole(maps.map_bids(bids(spark, sf_dir), metrics(spark, sf_dir), tables.keyed_features(spark, sf_dir)))


@query
def map_bids_without_medians(spark, sf_dir):
    no_medians = metrics(spark, sf_dir).withColumn("median", F.lit(None).cast("double"))
    return _whole(maps.map_bids(bids(spark, sf_dir), no_medians, tables.keyed_features(spark, sf_dir)))


@query
def map_median(spark, sf_dir):
    found = stored(sources.metrics_or_compute(spark, scratch_path(spark) + ".csv", priced(spark, sf_dir)))
    return _whole(maps.map_median(found, tables.keyed_features(spark, sf_dir)))


@query
def map_median_bids(spark, sf_dir):
    shapes = tables.keyed_features(spark, sf_dir)
    return _whole(maps.map_median_bids(median_metrics(spark, sf_dir), bids(spark, sf_dir), shapes))


@query
def map_two_periods(spark, sf_dir):
    built = maps.map_two_periods(*_periods(spark, sf_dir), tables.features(spark, sf_dir))
    return _map_rows(built.together, built.first.center, "map")


@query
def map_labeled(spark, sf_dir):
    return _whole(maps.map_labeled(tables.deals(spark, sf_dir), tables.features(spark, sf_dir)))


@query
def map_labeled_filtered(spark, sf_dir):
    return _whole(maps.map_labeled_filtered(tables.deals(spark, sf_dir), tables.features(spark, sf_dir), PERIOD))
