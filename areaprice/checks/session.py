"""A shared folder for checks that run in a local session."""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def ensure_shared_folder(spark: SparkSession) -> None:
    """Give a local session without a checkpoint folder a temporary one; any other session must name its own."""
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return
    if spark.sparkContext.master.partition("[")[0] == "local":
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="areaprice-"))


def with_shared_folder(function: Query) -> Query:
    """The query, run after :func:`ensure_shared_folder`."""

    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_shared_folder(spark)
        return function(spark, sf_dir)

    return run
