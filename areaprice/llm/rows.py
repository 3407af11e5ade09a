"""What the corpus operators share: word and letter rules, exact ranks over tables of any size, row passing."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import stored

# What separates words, as a character class of regular expressions.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole_text(text: str = "text") -> Column:
    """The text, a missing one as the empty string."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """Words of a text that is not null, in order."""
    return F.filter(F.split(text, f"{SPACE}+", -1), lambda word: word != "")


def whole_row(df: DataFrame, name: str = "row") -> Column:
    """All columns of a table as one struct, so that none can clash with a column that an operator adds."""
    return F.struct(*[F.col(f"`{column.replace('`', '``')}`") for column in df.columns]).alias(name)


def renamed(docs: DataFrame) -> DataFrame:
    """The table with its columns numbered, so that none can clash with a column that an operator adds."""
    return docs.toDF(*[f"_doc{i}" for i in range(len(docs.columns))])


def renamed_row(docs: DataFrame, name: str = "row") -> Column:
    """The struct of :func:`whole_row` from the columns of ``renamed(docs)``."""
    return F.struct(*[F.col(f"_doc{i}").alias(column) for i, column in enumerate(docs.columns)]).alias(name)


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once for each row.

    Catalyst moves filters below the expressions they use, and merges projections, by writing the expressions
    out wherever they are used; for long ones inside loops over an array that multiplies the work. It does
    neither through a generator, here one that makes one row of each.
    """
    return df.select("*", F.inline(F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))))


def row_key(doc_id: Column, text: Column) -> Column:
    """What tells documents apart: the id, null or not, and a hash of the text."""
    text_hash = F.hex(F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))))
    return F.concat_ws(":", id_text(doc_id), text_hash)


def id_text(doc_id: Column) -> Column:
    """The id as text that no null id has, and no text of an id such as ``null``."""
    return F.coalesce(F.concat(F.lit("="), doc_id.cast("string")), F.lit(""))


def rows_with_keys(docs: DataFrame, keys: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents whose :func:`row_key` is in the distinct ``keys`` (one column), with all their columns.

    Of rows that repeat both id and text one is returned.
    """
    wanted = keys.toDF("key")
    rows = docs.select(whole_row(docs), row_key(F.col(id_column), F.col(text_column)).alias("key"))
    return rows.join(wanted, "key").dropDuplicates(["key"]).select("row.*")


def ranked(df: DataFrame, order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """Add the rank from 0 of each row in a total order, without one task that sees all rows.

    The rows are dealt out by ranges of the order, sorted, numbered per range, and stored, so that the ranges
    stay as they are; the range sizes, one row per task, give each range its first rank. Rows that tie in all
    of ``order`` share a range and are numbered in any order.
    """
    table = stored(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = table.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    numbered = table.withColumn("_part", part).join(F.broadcast(starts), "_part")  # as many rows as a stage has tasks
    within = F.col("_at") - F.shiftleft("_part", 33)
    return numbered.withColumn(name, F.col("_start") + within).drop("_part", "_start", "_at")


def split_words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8, by the same rule as :data:`WORD`; white space of bytes is just that set."""
    return (text or "").encode("utf-8", "replace").split()


def text_slices(batch: pa.RecordBatch, text: str = "text", limit: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Parts of a batch with their texts, each part of at most ``limit`` bytes of text or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = sizes.cumsum()
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(ends.searchsorted(before + limit, side="right")))
        part = batch.slice(start, stop - start)
        yield part, part.column(text).to_pylist()
        start = stop


def lowered_slices(text: str | None, separator: str, limit: int = 1 << 20) -> Iterator[str]:
    """The text with A-Z lower-cased, in slices of some ``limit`` characters that end at a separator (a pattern)."""
    low = (text or "").encode("utf-8", "replace").lower().decode()
    between = re.compile(separator)
    start = 0
    while start < len(low):
        end = between.search(low, start + limit)
        stop = end.end() if end else len(low)
        yield low[start:stop]
        start = stop
