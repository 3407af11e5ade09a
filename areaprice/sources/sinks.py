"""Writers of tables, GeoJSON features and map layers. Each task writes its own part file."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import COLLECTION
from ..functions.numbers import quoted
from ..functions.text import cp1251_to_latin1
from .tables import _CP1251_NAMES


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    encoding: str = "UTF-8",
    order_by: Iterable[str] = (),
    **options: object,
) -> str:
    """Write delimited text with a header into a directory of part files.

    With ``order_by`` rows are in that order, NULL first, within the files and from one to the next by name. Rows with
    the same key may go on from one file to the next, so that a frequent key doesn't make one large file.
    """
    if order_by := list(order_by):
        df = _in_order(df, [F.col(quoted(name)) for name in order_by])
    if encoding.lower() in _CP1251_NAMES:
        text = [name for name, kind in df.dtypes if kind == "string"]
        df = df.withColumns({name: cp1251_to_latin1(F.col(quoted(name))) for name in text})
        names = [name.encode("cp1251", "replace").decode("latin-1") for name in df.columns]
        df, encoding = df.toDF(*names), "ISO-8859-1"
    settings = {"header": True, "quote": '"', "escape": '"', "encoding": encoding, **options}
    df.write.mode(mode).options(**settings).csv(path)
    return path


def _in_order(df: DataFrame, keys: list[Column]) -> DataFrame:
    """Rows in order of the keys, of which the ranges of the files divide those with one key too.

    Within a key rows are in order of their hash, and rows that are alike in order of their place in a task, which is
    the same when the task runs again, for the task has them in order of their hashes.
    """
    columns = [F.col(quoted(name)) for name in df.columns]
    hashed = df.select(*columns, F.xxhash64(*columns).alias("_hash")).sortWithinPartitions("_hash")
    placed = hashed.withColumn("_place", F.monotonically_increasing_id())
    return placed.orderBy(*keys, "_hash", "_place").select(columns)


def feature_json(df: DataFrame, columns: Iterable[str] = (), drop: Iterable[str] = ()) -> Column:
    """A feature row as one GeoJSON text, with the named columns merged into its properties.

    A column replaces a property of the same name, a NULL is written as ``null``, other properties keep
    their JSON type, and coordinates are passed through as the text they came in.
    """
    columns = list(columns)
    taken = F.lit(columns + list(drop)).cast("array<string>")
    kept = F.map_filter(
        F.from_json(F.coalesce("properties", F.lit("{}")), "map<string,variant>"),
        lambda name, _: ~F.array_contains(taken, name),
    )
    if columns:
        pairs = [part for name in columns for part in (F.lit(name), F.col(quoted(name)).cast("variant"))]
        kept = F.map_concat(kept, F.create_map(*pairs))
    geometry = F.when(
        F.col("geometry.type").isNotNull() & F.col("geometry.coordinates").isNotNull(),
        F.concat(
            F.lit('{"type":"'),
            F.col("geometry.type"),
            F.when(F.col("geometry.type") == COLLECTION, F.lit('","geometries":')).otherwise(F.lit('","coordinates":')),
            F.col("geometry.coordinates"),
            F.lit("}"),
        ),
    )
    head = F.lit('{"type":"Feature"')
    if "id" in df.columns:
        text = F.col("id").cast("string")
        number = F.when(text.rlike(r"^(0|-?[1-9][0-9]*)$"), text)
        head = F.concat(
            head, F.coalesce(F.concat(F.lit(',"id":'), F.coalesce(number, F.to_json(text.cast("variant")))), F.lit(""))
        )
    return F.concat(
        head,
        F.lit(',"geometry":'),
        F.coalesce(geometry, F.lit("null")),
        F.lit(',"properties":'),
        F.to_json(kept),
        F.lit("}"),
    )


def write_features(
    df: DataFrame,
    path: str,
    columns: Iterable[str] = (),
    drop: Iterable[str] = (),
    mode: str = "overwrite",
    collections: bool = False,
    **options: object,
) -> str:
    """Write GeoJSON into a directory of part files, one feature per line.

    With ``collections=True`` every part file is a document of its own, a FeatureCollection that other programs can
    open; a table in one partition gives one document. ``lineSep=" "`` puts a document on one line.
    """
    text = df.select(feature_json(df, columns, drop).alias("value"))
    if collections:
        text = text.mapInArrow(_as_collection, "value string")
    text.write.mode(mode).options(**options).text(path)
    return path


def _as_collection(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of a task with head, commas and tail. A line is held back until it is known whether it is the last."""
    held, comma = '{"type":"FeatureCollection","features":[', ""
    for batch in batches:
        lines = []
        for line in batch.column(0).to_pylist():
            lines.append(held + comma)
            held, comma = line, ","
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
    yield pa.RecordBatch.from_arrays([pa.array([held, "]}"], pa.string())], ["value"])


def write_layer(layers: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write the rows of map layers as Parquet, one directory per layer."""
    layers.write.mode(mode).partitionBy("layer").parquet(path)
    return path
