"""Exact duplicates: groups by a 128-bit content hash, compared byte by byte."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import stored
from .rows import id_text, lower_ascii, whole_row, whole_text


def _hash128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_groups(docs: DataFrame, keep: str = "largest", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Group of each document among those whose text is the same after lower-casing A-Z.

    Returns ``doc_id, text_sha256, keep_id, group_size, kept``, one row per document. Rows are grouped by a
    128-bit hash of the normalised text, counted before the shuffle, so a text that a third of all rows share
    arrives as one row per task. Inside groups of two rows or more the texts are compared with the text of the
    row that stays; one that differs (a collision) moves to a group of its own text. The comparing join is a
    sort-merge join, whose large partitions Spark splits.

    A null text is the empty text. ``keep`` tells which id stays, ``largest`` or ``smallest``; a null id stays
    only where a group has no other. Rows that repeat both id and text are documents of their own, of which one
    stays. Other columns are ignored; an empty table gives no rows.
    """
    best = {"largest": F.max, "smallest": F.min}[keep]
    text = lower_ascii(whole_text(text_column))
    full = docs.select(F.col(id_column).alias("doc_id"), text.alias("norm")).withColumn("hash", _hash128(F.col("norm")))
    narrow = full.select("doc_id", "hash", F.sha2("norm", 256).alias("text_sha256"))
    documents = stored(narrow.groupBy("hash", "doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("copies")))

    collided = _collisions(full, documents, best)
    known = documents.join(
        collided.withColumnsRenamed({"doc_id": "other_id", "hash": "other_hash", "sha": "other_sha"}),
        (F.col("hash") == F.col("other_hash"))
        & F.col("doc_id").eqNullSafe(F.col("other_id"))
        & (F.col("text_sha256") == F.col("other_sha")),
        "left",
    ).select("hash", "doc_id", "text_sha256", "copies", F.coalesce("other_sha", F.lit("")).alias("part"))
    groups = known.groupBy("hash", "part").agg(best("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    each = known.join(groups, ["hash", "part"]).select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return each.select("doc_id", "text_sha256", "keep_id", "group_size", kept.alias("kept"))


def _collisions(full: DataFrame, documents: DataFrame, best) -> DataFrame:
    """Documents whose bytes differ from those of the row that stays in their hash group: ``hash, doc_id, sha``."""
    repeated = documents.groupBy("hash").agg(best("doc_id").alias("keep_id"), F.sum("copies").alias("n")).where("n > 1")
    members = stored(full.join(repeated.drop("n"), "hash"))  # the texts of copies alone, for both reads below
    stays = members.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    # Of rows with the same id and hash the least text stands for the group: one text per hash is compared with.
    sample = stays.groupBy("hash").agg(F.min("norm").alias("kept_text"))
    differs = members.join(sample, "hash").where(F.col("norm") != F.col("kept_text"))
    return differs.select("hash", "doc_id", F.sha2("norm", 256).alias("sha")).distinct()


def drop_exact(docs: DataFrame, keep: str = "largest", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, one row of each group, with all their columns.

    Rows are those of :func:`exact_groups` with ``kept``. Where rows repeat both the id and the text of the
    document that stays, one of them is returned.
    """
    def key(doc_id: Column, sha: Column) -> Column:
        return F.concat_ws(":", id_text(doc_id), sha)

    groups = exact_groups(docs, keep, id_column, text_column).where("kept")
    kept = groups.select(key(F.col("doc_id"), F.col("text_sha256")).alias("key"))
    sha = F.sha2(lower_ascii(whole_text(text_column)), 256)
    rows = docs.select(whole_row(docs), key(F.col(id_column), sha).alias("key"))
    return rows.join(kept, "key").dropDuplicates(["key"]).select("row.*")
