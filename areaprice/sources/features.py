"""Reader of GeoJSON features."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import JSON_GEOMETRY_TYPE, as_read
from .scan import feature_texts
from .tables import _existing

# First line of a collection that has its features on the following lines, and of one that has them on the same line.
COLLECTION_HEAD = r'^\{(\s*"type"\s*:\s*"FeatureCollection".*)?$'
COLLECTION_LINE = r'"features"\s*:\s*\[\s*[^\s]'
# An id may be a number or text, and properties may be any object: both are kept as their JSON text.
FEATURE_TYPE = f"struct<id:string,type:string,geometry:{JSON_GEOMETRY_TYPE},properties:string>"


def read_features(
    spark: SparkSession,
    path: str,
    lines: bool = False,
    id_column: str | None = None,
    properties: Iterable[str] | str | T.StructType = (),
) -> DataFrame:
    """One row per GeoJSON feature: ``id``, ``type``, ``geometry``, ``properties`` (JSON text).

    Any layout is read by many tasks, also a FeatureCollection on one line of any length: see
    :func:`~areaprice.sources.scan.feature_texts`, which reads the files up to three times and starts a job. A single
    Feature, features on a line each and text sequences are found by the same scan. With ``lines=True`` each feature
    must be on a line of its own, in newline-delimited features, text sequences or a collection laid out like that;
    then one scan by Spark's own text reader does. What is neither a feature nor a collection is an error.

    ``id_column`` names a property (or ``id``) to become a key column; if no feature has it, ``KeyError``. That is
    checked by a job of its own, which reads up to the first feature that has it. ``properties`` adds further
    properties as columns, see :func:`with_properties`, unchecked.
    """
    if lines:
        text = _existing(path, lambda: spark.read.text(path))
        record = F.regexp_replace(F.col("value"), r"^[\s\x1e\uFEFF]+|[\s,]+$", "")
        is_head = record.rlike(COLLECTION_HEAD)
        one_line = F.raise_error("A whole collection is on one line: read it without lines=True")
        wanted = record.startswith("{") & F.when(is_head & record.rlike(COLLECTION_LINE), one_line).otherwise(~is_head)
        texts = text.where(wanted).select(record.alias("text"), F.lit(True).alias("top"))
    else:
        texts = _existing(path, lambda: feature_texts(spark, path))
    parsed = texts.select(F.from_json("text", FEATURE_TYPE, {"mode": "FAILFAST"}).alias("f"), "top")
    is_other = F.col("top") & ~F.col("f.type").eqNullSafe("Feature")
    other = F.raise_error(F.concat(F.lit("Neither a Feature nor a collection of them: "), F.coalesce("f.type", F.lit("no type"))))
    features = parsed.select(F.when(is_other, other).otherwise(F.col("f")).alias("f")).select("f.*")
    features = features.withColumn("geometry", as_read(F.col("geometry")))
    features = with_properties(features, properties) if properties else features
    return with_id(features, id_column) if id_column else features


def with_id(features: DataFrame, id_column: str) -> DataFrame:
    """Features with a property as an ordinary key column."""
    key = F.col("id") if id_column == "id" else property_text(id_column)
    if features.where(key.isNotNull()).isEmpty():
        raise KeyError(f"Column {id_column!r} not found in the features")
    return features.withColumn(id_column, key)


def with_properties(features: DataFrame, properties: Iterable[str] | str | T.StructType) -> DataFrame:
    """Features with top-level properties as columns, NULL where a feature lacks one.

    Either names, for text columns (objects and arrays as their JSON), or a schema, as a type or in DDL, for typed
    ones. All come from one parse of the properties. A name that the features have already is an error.
    """
    if isinstance(properties, str):
        properties = T.StructType.fromDDL(properties)
    if not isinstance(properties, T.StructType):
        properties = T.StructType([T.StructField(name, T.StringType()) for name in properties])
    if taken := set(properties.names) & set(features.columns):
        raise ValueError(f"The features have columns {sorted(taken)} already")
    parsed = features.withColumn("_properties", F.from_json("properties", properties))
    columns = {name: F.col("_properties")[name] for name in properties.names}
    return parsed.withColumns(columns).drop("_properties")


def property_text(name: str):
    """Value of a top-level property as text; NULL if absent."""
    return F.get_json_object("properties", f"$['{name}']")
