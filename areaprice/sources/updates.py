"""Area metrics that notice new input files and count nothing but these.

A store keeps how often each price occurs in each area. Such counts add up, so a file that has been counted is never
read again, and all statistics, the exact median included, follow from them as from the deals. Below its path are
``counts``, a table for each update, and ``manifest``, which says of each input file which of them it was counted in.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import nan_to_null, quoted
from ..operators.clean import clean_prices
from ..operators.stats import STATS, area_stats
from .tables import AREA_KEY, PRICE, _existing, read_deals

_MANIFEST = "version long, file string, length long, modified timestamp, batch string"
# Tables of counts that are merged into one when there are more.
MERGE_AT = 16


def _clean_deals(spark: SparkSession, files: list[str]) -> DataFrame:
    parts = [clean_prices(read_deals(spark, file)) for file in files]
    return functools.reduce(DataFrame.unionByName, parts)


def input_files(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``length`` and ``modified`` of the files below a path, none of which is opened."""
    listed = _existing(path, lambda: spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path))
    return listed.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))


def _manifest(spark: SparkSession, store: str) -> DataFrame:
    """The rows of the last version of the manifest; none if there is no store yet."""
    try:
        versions = _existing(store, lambda: spark.read.schema(_MANIFEST).parquet(f"{store}/manifest"))
    except FileNotFoundError:
        return spark.createDataFrame([], _MANIFEST)
    last = versions.agg(F.max("version")).first()[0]
    return versions.where(F.col("version") == F.lit(last))


def update_counts(
    spark: SparkSession,
    path: str,
    store: str,
    read: Callable[[SparkSession, list[str]], DataFrame] = _clean_deals,
    key: str = AREA_KEY,
    price: str = PRICE,
) -> DataFrame:
    """Count the files below ``path`` that the store doesn't have yet; all counts: ``key``, ``price`` and ``times``.

    ``read`` makes deals of some files; each file must give the same deals alone as with others. If a file that was
    counted has another length or time, or is gone, its counts can't be taken out of the rest, so all files are
    counted again. A failed update leaves nothing behind that a later one would take for counted: the manifest is written
    last, by one task, one row per file. Two updates of a store at once must be kept apart by the caller.
    """
    present, known = input_files(spark, path), _manifest(spark, store)
    state = ["file", "length", "modified"]
    rows = known.select("version", "batch", *state).collect()  # one per input file, as in the listing of a scan
    listed = present.collect()
    counted = {tuple(row[name] for name in state) for row in rows}
    found = {tuple(row[name] for name in state) for row in listed}
    fresh = sorted(found - counted if counted <= found else found)
    live = [(row["file"], row["length"], row["modified"], row["batch"]) for row in rows] if counted <= found else []
    version = max((row["version"] for row in rows), default=0)
    if fresh:
        batch = uuid.uuid4().hex
        deals = read(spark, [file for file, _, _ in fresh])
        value = nan_to_null(F.col(quoted(price)).cast("double"))
        counts = deals.groupBy(F.col(quoted(key)).alias("key"), value.alias("price")).agg(F.count(F.lit(1)).alias("times"))
        counts.write.parquet(f"{store}/counts/{batch}")
        live += [(*file, batch) for file in fresh]
    batches = sorted({batch for *_, batch in live})
    if len(batches) > MERGE_AT:
        merged = _counts(spark, store, batches, key, price).groupBy(F.col(quoted(key)).alias("key"), F.col(quoted(price)).alias("price"))
        batches = [uuid.uuid4().hex]
        merged.agg(F.sum("times").alias("times")).write.parquet(f"{store}/counts/{batches[0]}")
        live = [(*file, batches[0]) for *file, _ in live]
    if fresh or len(live) != len(rows):
        manifest = spark.createDataFrame([(version + 1, *row) for row in live], _MANIFEST)
        manifest.coalesce(1).write.mode("append").parquet(f"{store}/manifest")
    return _counts(spark, store, batches, key, price)


def _counts(spark: SparkSession, store: str, batches: list[str], key: str, price: str) -> DataFrame:
    if not batches:
        return spark.createDataFrame([], f"{quoted(key)} string, {quoted(price)} double, times bigint")
    return spark.read.parquet(*[f"{store}/counts/{batch}" for batch in batches]).toDF(key, price, "times")


def updated_metrics(
    spark: SparkSession,
    path: str,
    store: str,
    read: Callable[[SparkSession, list[str]], DataFrame] = _clean_deals,
    key: str = AREA_KEY,
    price: str = PRICE,
    stats: Iterable[str] = STATS,
) -> DataFrame:
    """Statistics per area of all files below ``path``, of which only those new to the store are read.

    The same as :func:`~areaprice.operators.stats.area_stats` of all deals; see :func:`update_counts`.
    """
    return area_stats(update_counts(spark, path, store, read, key, price), key, price, stats, times="times")
