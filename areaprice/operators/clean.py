"""Row filters and schema checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import number_of, quoted

# Building years and registration period of the filtered map.
YEARS = (1964, 1972)
PERIOD = "01.07.2025"
PERIOD_FORMAT = "dd.MM.yyyy"


def clean_prices(df: DataFrame, price: str = "price_per_sqm", policy: str = "positive") -> DataFrame:
    """Make the price numeric and keep ``positive`` prices only, or all that are ``present``."""
    if policy not in ("positive", "present"):
        raise ValueError(f"Unknown price policy: {policy}")
    kind, value = df.schema[price].dataType, F.col(quoted(price))
    if isinstance(kind, T.StringType):
        df = df.withColumn(price, number_of(df, price))
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        df = df.where(~F.isnan(value))
    # On a numeric column this is a plain comparison, which file formats with statistics can use.
    kept = df.where(value > 0 if policy == "positive" else value.isNotNull())
    return kept.withColumn(price, value.cast("double"))


def drop_incomplete(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop rows with NULL or NaN in any of the columns."""
    return df.na.drop(subset=[quoted(name) for name in columns])


def filter_period(
    df: DataFrame,
    years: tuple[int, int] | None = None,
    period: str | None = None,
    year_column: str = "year_build",
    period_column: str = "period_start_date",
) -> DataFrame:
    """Keep an inclusive range of building years and one period, given as its text (``dd.MM.yyyy``).

    A text column is compared as text; a date or timestamp column with the day that the text names.
    """
    if years is not None:
        df = df.where(F.col(quoted(year_column)).between(*years))
    if period is not None:
        found, wanted = F.col(quoted(period_column)), F.lit(period)
        if isinstance(df.schema[period_column].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            found, wanted = found.cast("date"), F.to_date(wanted, PERIOD_FORMAT)
        df = df.where(found == wanted)
    return df


def keep_known(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Those of the named columns that the table has."""
    return df.select([quoted(name) for name in columns if name in df.columns])


def require_columns(df: DataFrame, required: Iterable[str], what: str = "table") -> DataFrame:
    """The table itself, or ``ValueError`` naming the columns it lacks. Starts no job."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing columns {missing} in {what}")
    return df


def require_rows(df: DataFrame, message: str = "No rows left") -> DataFrame:
    """The table itself, or ``ValueError`` if it is empty. Starts a job, which stops at the first row."""
    if df.isEmpty():
        raise ValueError(message)
    return df
