"""Joins of features with tables on an area key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import KEY_PATHS, area_key
from ..functions.numbers import quoted

HOW = ("left", "right", "inner", "outer")
# Rows of one key that a task should join at most, and the keys per side that may have more.
HOT_ROWS, HOT_KEYS = 10_000, 1000


def join_features(
    features: DataFrame,
    table: DataFrame,
    on: str,
    how: str = "left",
    suffixes: tuple[str, str] = ("", "_other"),
    null_keys_match: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Join features with a table on a key that both have; a key found twice repeats the row.

    Other columns that both sides have get the suffixes. NULL keys match nothing unless asked to match each
    other. Keys of different types are an error, not a cast. ``unique=True`` says that no key occurs twice in the
    table; then a left join needs no more than Spark's own.

    The join reads each side once. Spark can't split a hot key of a side that an outer join doesn't preserve, nor NULLs
    that match nothing, so for all but inner joins a sketch of the keys is taken first, see :func:`hot_keys`, by a
    job over the two key columns. The rows of hot keys are split over cells, each of which joins a part of one side
    with a part of the other.
    """
    if how not in HOW:
        raise ValueError(f"Unknown join {how!r}, expected one of {HOW}")
    left_type, right_type = features.schema[on].dataType, table.schema[on].dataType
    if left_type != right_type:
        raise TypeError(f"Key {on!r} is {left_type.simpleString()} in features and {right_type.simpleString()} in table")
    shared = (set(features.columns) & set(table.columns)) - {on}
    left = features.withColumnsRenamed({name: name + suffixes[0] for name in shared})
    right = table.withColumnsRenamed({**{name: name + suffixes[1] for name in shared}, on: "_right_key"})
    if duplicates := (set(left.columns) & set(right.columns)):
        raise ValueError(f"Suffixes {suffixes} leave columns {sorted(duplicates)} on both sides")
    left_key, right_key = F.col(quoted(on)), F.col("_right_key")
    matches = left_key.eqNullSafe(right_key) if null_keys_match else left_key == right_key

    def result(joined: DataFrame) -> DataFrame:
        """All columns in order; those of a side that is not there as NULL."""
        key = F.coalesce(*[k for k, name in ((left_key, on), (right_key, "_right_key")) if name in joined.columns])
        columns = []
        for field in [*left.schema, *right.schema]:
            if field.name == on:
                columns.append(key.alias(on))
            elif field.name != "_right_key":
                present = field.name in joined.columns
                column = F.col(quoted(field.name)) if present else F.lit(None).cast(field.dataType)
                columns.append(column.alias(field.name))
        return joined.select(columns)

    if how == "inner" or unique and how == "left":
        return result(left.join(right, matches, how))
    hot = hot_keys(left.select(left_key.alias("key")), right.select(right_key.alias("key")), null_keys_match)
    if hot is None:
        return result(left.join(right, matches, how))
    left_cells = _in_cells(left, left_key, hot, "left", own="n_left", other="n_right")
    right_cells = _in_cells(right, right_key, hot, "right", own="n_right", other="n_left")
    joined = left_cells.join(right_cells, matches & (F.col("_left_cell") == F.col("_right_cell")), how)
    # A row of a hot key meets its matches in some cells only; where the other side has the key it is never alone.
    alone = F.col("_left_cell").isNull() | F.col("_right_cell").isNull()
    return result(joined.where(~(alone & F.coalesce("_left_matched", "_right_matched"))))


def hot_keys(left: DataFrame, right: DataFrame, null_keys_match: bool = False) -> DataFrame | None:
    """Keys with more than ``HOT_ROWS`` rows on a side: ``key``, ``n_left`` and ``n_right``; None if there are none.

    Both sides have one column, ``key``. Every task sketches its most frequent keys; those of the merged sketches, at
    most ``HOT_KEYS`` a side, are counted exactly. A key below the resolution of the sketch, one in some thousands of
    all rows, may be missed, and then joins like any other. NULL counts as a key, which has no rows on the
    other side unless NULLs match.
    """
    sketch = F.expr(f"approx_top_k(xxhash64(key), {HOT_KEYS}, {10 * HOT_KEYS})").alias("top")
    sketches = left.agg(sketch).unionByName(right.agg(sketch)).collect()  # a row per side
    hashes = sorted({item["item"] for side in sketches for item in side["top"] or () if item["count"] > HOT_ROWS})
    if not hashes:
        return None
    of_hash = F.xxhash64("key").isin(hashes)
    one = [side.where(of_hash).select("key", F.lit(n).alias("n_left"), F.lit(1 - n).alias("n_right")) for side, n in ((left, 1), (right, 0))]
    counts = one[0].unionByName(one[1]).groupBy("key").agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))
    rows = counts.where(F.greatest("n_left", "n_right") > HOT_ROWS).toArrow()  # at most a row per hash
    return left.sparkSession.createDataFrame(rows, counts.schema).withColumn("null_matches", F.lit(null_keys_match)) if len(rows) else None


def _in_cells(side: DataFrame, key: Column, hot: DataFrame, name: str, own: str, other: str) -> DataFrame:
    """Rows with ``_<name>_cell``: one cell for most, for a row of a hot key one for each part of the other side.

    Which part a row is in follows from its place among the rows of its task in order of their hashes: rows that are
    alike are dealt out too, and a task that runs again deals them out as before.
    """
    matched = (F.col(other) > 0) & (F.col("key").isNotNull() | F.col("null_matches"))
    parts = F.ceil(F.col(own) / HOT_ROWS).cast("int")
    copies = F.when(matched, F.greatest(F.ceil(F.col(other) / HOT_ROWS), F.lit(1))).otherwise(1).cast("int")
    known = hot.select("key", F.greatest(parts, F.lit(1)).alias("_parts"), copies.alias("_copies"), matched.alias(f"_{name}_matched"))
    names = [F.col(quoted(column)) for column in side.columns]
    placed = side.sortWithinPartitions(F.xxhash64(*names)).withColumn("_at", F.monotonically_increasing_id())
    joined = placed.join(F.broadcast(known), key.eqNullSafe(F.col("key")), "left")  # HOT_KEYS rows a side at most
    part = F.pmod("_at", F.col("_parts"))
    own_first = name == "left"
    cells = F.transform(F.sequence(F.lit(0), F.col("_copies") - 1), lambda c: part * F.col("_copies") + c if own_first else c * F.col("_parts") + part)
    # Of a key that isn't hot nothing is known, and its one cell is 0.
    cell = F.explode(F.coalesce(F.when(F.col("_parts").isNotNull(), cells), F.array(F.lit(0).cast("long")))).alias(f"_{name}_cell")
    return joined.select(*names, F.coalesce(f"_{name}_matched", F.lit(False)).alias(f"_{name}_matched"), cell)


def with_area_key(features: DataFrame, paths: tuple[str, ...] = KEY_PATHS) -> DataFrame:
    """Features with ``cadnum``, the area key found in their properties."""
    return features.withColumn("cadnum", area_key(F.col("properties"), paths))


def features_with_keys(
    features: DataFrame, keys: DataFrame, key: str = "quarter_cad_number", require_geometry: bool = True
) -> DataFrame:
    """Features whose ``cadnum`` is among the keys, taken as text, and, unless told otherwise, that have a geometry."""
    if require_geometry:
        features = features.where("geometry is not null")
    wanted = keys.select(F.col(quoted(key)).cast("string").alias("_wanted")).distinct()
    return features.join(wanted, F.col("cadnum") == F.col("_wanted"), "left_semi")


def unique_by_key(metrics: DataFrame, key: str = "quarter_cad_number") -> DataFrame:
    """The same rows, without a NULL key; the job fails if a key occurs twice."""
    others = [name for name in metrics.columns if name != key]
    area = F.col(quoted(key))
    twice = F.raise_error(F.concat(F.lit("Duplicate area key "), F.col("_area")))
    counted = metrics.where(area.isNotNull()).groupBy(area.alias("_area"))
    found = counted.agg(F.count(F.lit(1)).alias("_n"), *[F.first(quoted(name)).alias(name) for name in others])
    checked = F.when(F.col("_n") > 1, twice).otherwise(F.col("_area")).alias(key)
    return found.select(checked, *[F.col(quoted(name)) for name in others])


def lookup_stats(
    features: DataFrame,
    metrics: DataFrame,
    columns: Iterable[str] | None = None,
    key: str = "quarter_cad_number",
    how: str = "left",
    unique: bool = False,
) -> DataFrame:
    """Add the statistics of its area to each feature; NULLs where the area has none. Keys are compared as text.

    ``unique=True`` says that no key occurs twice, as after an aggregation; otherwise that is checked.
    ``how="inner"`` also drops features without statistics.
    """
    columns = [name for name in metrics.columns if name != key] if columns is None else list(columns)
    metrics = metrics.select([F.col(quoted(name)) for name in (key, *columns)])
    if not unique:
        metrics = unique_by_key(metrics, key)
    metrics = metrics.select(F.col(quoted(key)).cast("string").alias("_area"), *[F.col(quoted(name)) for name in columns])
    return features.drop(*columns).join(metrics, F.col("cadnum") == F.col("_area"), how).drop("_area")
