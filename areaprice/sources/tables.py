"""Readers of tables: deals, offers and precomputed area metrics."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import lenient_double, missing_to_null, number_of, quoted, without_spaces
from ..functions.text import cp1251_from_latin1, decode_names, latin1_bytes, tells_encoding, utf8_or_cp1251, utf8_or_cp1251_by
from ..operators.clean import drop_incomplete, keep_known, require_columns
from ..operators.stats import area_stats

# Column names of the input files.
AREA_KEY = "quarter_cad_number"
PRICE = "price_per_sqm"
BID_ADDRESS = "Адрес"
BID_LAT = "Широта"
BID_LON = "Долгота"
BID_PRICE = "Цена, руб"
BID_UNIT_PRICE = "Цена за кв.м, руб."
METRIC_COLUMNS = (AREA_KEY, "arith_mean", "geom_mean", "median", "count")
MEDIAN_COLUMNS = (AREA_KEY, "median", "count")

# Quotes inside a quoted field are doubled; the header of every file must name the same columns.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "enforceSchema": False}
# A row with too many or too few fields is an error, which the parser sees only if it splits whole rows.
STRICT_OPTIONS = {"mode": "FAILFAST", "columnPruning": False}
_CP1251_NAMES = {"cp1251", "windows-1251", "1251"}


def read_table(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """Read a ``.csv``, ``.tsv`` or ``.parquet`` table by the suffix of its path.

    Other options go to the Spark reader. Delimited files come as text columns (numbers are made by the
    cleaning functions, so no pass over the data is spent on guessing types) unless ``schema`` or
    ``inferSchema`` is given. A missing path raises ``FileNotFoundError``.
    """
    suffix = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower()
    if suffix == "parquet":
        return _existing(path, lambda: spark.read.options(**options).parquet(path))
    if suffix in ("csv", "tsv"):
        return read_delimited(spark, path, **{"sep": "\t" if suffix == "tsv" else ",", **options})
    raise ValueError(f"Unsupported table format: .{suffix}")


def read_delimited(
    spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8", strict: bool = True, **options: object
) -> DataFrame:
    """Read delimited text with a header.

    ``encoding="auto"`` takes UTF-8 and windows-1251, settled for each file from all of its values, for which the
    files are read once more; ``"auto_value"`` settles it for each value in the one scan. With a ``schema`` the
    columns must have its names, and text in it is decoded like any other.

    A row with more or fewer fields than the header, or with a value that the schema's type can't hold, is an
    error, whatever columns are used later; for that, whole rows are parsed. ``strict=False`` is for clean data:
    only the needed columns are parsed, surplus fields are dropped and missing ones NULL. A quoted field with line
    breaks in it needs ``multiLine=True``, with which a file is one task; without it such a row is an error too.
    """
    schema = options.pop("schema", None)
    decode = _decoder(encoding)
    given = bool(options)
    options = {**CSV_OPTIONS, **(STRICT_OPTIONS if strict else {}), "sep": sep, **options}
    options["encoding"] = "ISO-8859-1" if decode else encoding
    reader = spark.read.options(**options)
    raw = _existing(path, lambda: reader.csv(path))
    names = decode.names(raw.columns) if decode else raw.columns
    if schema is not None:
        schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        if schema.names != names:
            raise ValueError(f"The columns of {path} are {names}, not {schema.names}")
        hidden = T.StructType([T.StructField(old, field.dataType) for old, field in zip(raw.columns, schema, strict=True)])
        raw = spark.read.options(**options).schema(hidden).csv(path)
    text = [name for name, kind in raw.dtypes if kind == "string"]
    if decode and text:
        # Bytes above ASCII stand in values and nowhere else.
        same_bytes = strict and not given and text == raw.columns and "".join([sep, *names]).isascii()
        raw = decode.table(raw, text, spark.read.text(path) if same_bytes else None)
    columns = []
    for name, new in zip(raw.columns, names, strict=True):
        column = F.col(quoted(name))
        columns.append((missing_to_null(column) if name in text else column).alias(new))
    return raw.select(columns)


class _Decoder(NamedTuple):
    """How to put right text that was read as Latin-1: the names of the header, and the columns of a table.

    A table may come with the lines of its files, if they have the bytes of the values and else ASCII.
    """

    names: Callable[[list[str]], list[str]]
    table: Callable[[DataFrame, list[str], DataFrame | None], DataFrame]


def _decoder(encoding: str) -> _Decoder | None:
    def each(decode: Callable[[Column], Column]) -> Callable[[DataFrame, list[str], DataFrame | None], DataFrame]:
        return lambda raw, text, lines: raw.withColumns({name: decode(F.col(quoted(name))) for name in text})

    if encoding.lower() in _CP1251_NAMES:
        return _Decoder(lambda names: [name.encode("latin-1").decode("cp1251", "replace") for name in names], each(cp1251_from_latin1))
    if encoding.lower() == "auto_value":
        return _Decoder(decode_names, each(utf8_or_cp1251))
    if encoding.lower() == "auto":
        return _Decoder(decode_names, _decode_by_file)
    return None


def _decode_by_file(raw: DataFrame, text: list[str], lines: DataFrame | None) -> DataFrame:
    """Text of files that are UTF-8 if all their values are valid, else windows-1251.

    Short windows-1251 values may be valid UTF-8. If no value of a valid file tells that it can't be such text, the file
    could be either, which is an error. Whole lines tell the same as the values of a row, and need no parsing.
    """
    file = F.col("_metadata.file_path")
    if lines is not None:
        rows = lines.select(file.alias("_in_file"), F.col("value").alias("_bytes"))
    else:
        # The values of a row are tested as one: between them ASCII, which is no part of a longer character.
        values = F.concat_ws("\n", *[F.col(quoted(name)) for name in text])
        rows = raw.select(file.alias("_in_file"), latin1_bytes(values).alias("_bytes"))
    valid, tells = F.every(F.is_valid_utf8("_bytes")), F.bool_or(tells_encoding(F.col("_bytes")))
    either = F.raise_error(F.concat(F.col("_in_file"), F.lit(" could be UTF-8 or windows-1251: name its encoding")))
    by_file = rows.groupBy("_in_file").agg(valid.alias("_valid"), tells.alias("_tells"))
    by_file = by_file.select("_in_file", F.when(F.col("_valid") & ~F.col("_tells"), either).otherwise(F.col("_valid")).alias("_utf8"))
    named = raw.select("*", file.alias("_file"))
    # A row per file, which Spark takes for a table as large as the files: it would shuffle all rows by their file.
    known = named.join(F.broadcast(by_file), F.col("_file") == F.col("_in_file"))
    decoded = {name: utf8_or_cp1251_by(F.col(quoted(name)), F.col("_utf8")) for name in text}
    return known.withColumns(decoded).drop("_file", "_in_file", "_utf8")


def _existing(path: str, read):
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from None
        raise


def read_deals(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8", **options: object) -> DataFrame:
    """Read closed sales: key and descriptions as text, numbers leniently typed."""
    return _typed_deals(read_delimited(spark, path, sep, encoding, **options))


def _typed_deals(deals: DataFrame) -> DataFrame:
    # Which deal columns hold numbers.
    kinds = {"year_build": "int", "floor": "int", "area": "double", "deal_price": "double", PRICE: "double"}
    typed = {name: lenient_double(F.col(name)).try_cast(kinds[name]) for name in deals.columns if name in kinds}
    return deals.withColumns(typed)


def read_probed(
    spark: SparkSession,
    path: str,
    required: str = PRICE,
    separators: Iterable[str] = (",", ";"),
    **options: object,
) -> DataFrame:
    """Read deals of unknown dialect: the first separator whose header has the required column.

    Only headers are read to find the separator. Comma or semicolon, UTF-8 or windows-1251 all work; the
    encoding is settled for each file.
    """
    tried = []
    for sep in separators:
        table = read_delimited(spark, path, sep, "auto", **options)
        if required in table.columns:
            return _typed_deals(table)
        tried.append(sep)
    raise ValueError(f"No column {required!r} in {path} with any of the separators {tried}")


def read_bids(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """Read offers and add ``lat``, ``lon`` and ``price_per_sqm``; rows missing one of them are dropped."""
    return clean_bids(read_delimited(spark, path, **options))


def clean_bids(
    bids: DataFrame, lat: str = BID_LAT, lon: str = BID_LON, unit_price: str = BID_UNIT_PRICE
) -> DataFrame:
    """Numeric position and price of offers; the price may have spaces between digits."""
    price: Column = without_spaces(F.col(quoted(unit_price)).cast("string"))
    numbers = {"lat": number_of(bids, lat), "lon": number_of(bids, lon), PRICE: lenient_double(price)}
    return drop_incomplete(bids.withColumns(numbers), ("lat", "lon", PRICE))


def read_metrics(spark: SparkSession, path: str, required: Iterable[str] = METRIC_COLUMNS) -> DataFrame:
    """Read precomputed area metrics, with the key as text and the statistics as numbers."""
    table = require_columns(read_table(spark, path), required, path)
    return _typed_metrics(table)


def _typed_metrics(metrics: DataFrame) -> DataFrame:
    typed = {name: number_of(metrics, name) for name in METRIC_COLUMNS[1:] if name in metrics.columns}
    if "count" in typed:
        typed["count"] = typed["count"].try_cast("bigint")
    return metrics.withColumns({AREA_KEY: F.col(AREA_KEY).cast("string"), **typed})


def metrics_or_compute(
    spark: SparkSession, path: str, deals: DataFrame, keep: Iterable[str] = MEDIAN_COLUMNS
) -> DataFrame:
    """Area metrics from ``path`` if it is there, else computed from cleaned deals; same columns either way."""
    try:
        metrics = read_table(spark, path)
    except FileNotFoundError:
        metrics = area_stats(deals, stats=[name for name in keep if name != AREA_KEY])
    return _typed_metrics(keep_known(metrics, keep))
