"""Column expressions for loosely typed numbers and for rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what counts as a decimal number in a text cell.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Text cells that mean "no value" in a delimited file.
MISSING_MARKERS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def lenient_double(text: Column) -> Column:
    """Text to double; anything that is not a plain decimal number becomes NULL.

    The pattern guard keeps out forms such as ``12d`` that a cast would take.
    """
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def without_spaces(text: Column) -> Column:
    """Drop the spaces used as thousands separators: ``195 556`` to ``195556``."""
    return F.replace(text, F.lit(" "), F.lit(""))


def nan_to_null(number: Column) -> Column:
    """One kind of missing value: NaN becomes NULL."""
    return F.when(~F.isnan(number), number)


def number_of(df: DataFrame, name: str) -> Column:
    """The named column as a double without NaN, whatever type it was read with."""
    column = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, T.StringType):
        return lenient_double(column)
    return nan_to_null(column.cast("double"))


def quoted(name: str) -> str:
    """Column name in back quotes, so that dots and commas in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def missing_to_null(text: Column) -> Column:
    """Text that is one of the missing-value markers becomes NULL."""
    return F.when(~text.isin(*MISSING_MARKERS), text)


def round_half_even(number: Column) -> Column:
    """Nearest whole number as bigint, halves to the even neighbour (2.5 gives 2)."""
    return F.rint(number).try_cast("bigint")


def whole_text(number: Column) -> Column:
    """The rounded whole number as text."""
    return round_half_even(number).cast("string")


def geometric_mean(number: Column) -> Column:
    """Aggregate: geometric mean of the positive values, NULL if there is none."""
    return F.exp(F.avg(F.ln(F.when(number > 0, number))))
