"""Intermediate results kept as small tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def scratch_root(spark: SparkSession, folder: str | None = None) -> str:
    """``areaprice`` below ``folder``, else below the session's checkpoint folder.

    That is ``spark.checkpoint.dir`` or what ``SparkContext.setCheckpointDir`` was given. A session that has
    neither, a local one included, is an error: a folder of one machine would be missed by the others.
    """
    root = folder or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/areaprice"


def scratch_path(spark: SparkSession, folder: str | None = None) -> str:
    """A new path below :func:`scratch_root`."""
    return f"{scratch_root(spark, folder)}/{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession, folder: str | None = None) -> bool:
    """Delete all intermediate tables, once the results that read them are written; whether there were any."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark, folder))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows of ``df`` written as Parquet and read back.

    Used for tables that later steps read more than once: nothing upstream is computed again, also after the
    loss of an executor, and Spark knows their size in bytes before the next join.
    """
    path = scratch_path(df.sparkSession, folder)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_and_observed(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict[str, Any]]:
    """The stored rows and aggregates over them, which are taken while they are written."""
    seen = Observation()
    table = stored(df.observe(seen, *[measure.alias(name) for name, measure in measures.items()]))
    return table, seen.get
