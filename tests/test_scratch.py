from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from areaprice import scratch
from areaprice.checks.session import ensure_shared_folder


def session(checkpoint_dir=None, master="local[4]", **settings):
    context = SimpleNamespace(master=master, checkpoint_dir=checkpoint_dir)
    context.getCheckpointDir = lambda: context.checkpoint_dir
    context.setCheckpointDir = lambda path: setattr(context, "checkpoint_dir", path)
    conf = SimpleNamespace(get=lambda name, default=None: settings.get(name, default))
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_shared_folder_is_the_one_the_session_names():
    named = session(**{"spark.checkpoint.dir": "hdfs://host/shared/"})
    assert scratch.scratch_path(named).startswith("hdfs://host/shared/areaprice/")
    assert scratch.scratch_path(session("s3a://bucket/c")).startswith("s3a://bucket/c/areaprice/")
    assert scratch.scratch_path(session(), "/given").startswith("/given/areaprice/")


@pytest.mark.parametrize("master", ["local[4]", "spark://host:7077", "local-cluster[2,1,1024]", None])
def test_a_session_without_the_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_path(session(master=master))


def test_checks_make_a_folder_for_local_sessions_only():
    local, cluster = session(), session(master="local-cluster[2,1,1024]")
    ensure_shared_folder(local)
    ensure_shared_folder(cluster)
    assert scratch.scratch_path(local)
    with pytest.raises(RuntimeError):
        scratch.scratch_path(cluster)


def test_stored_rows_and_their_aggregates(spark):
    table, seen = scratch.stored_and_observed(spark.range(10), n=F.count(F.lit(1)), top=F.max("id"))
    assert seen == {"n": 10, "top": 9}
    assert table.agg(F.sum("id")).first()[0] == 45
    empty, seen = scratch.stored_and_observed(spark.range(0), n=F.count(F.lit(1)), top=F.max("id"))
    assert seen == {"n": 0, "top": None} and empty.count() == 0


def test_clear_scratch(spark, tmp_path):
    folder = str(tmp_path)
    assert scratch.stored(spark.range(3), folder).count() == 3
    assert scratch.clear_scratch(spark, folder) and not list(tmp_path.glob("areaprice/*"))
    assert not scratch.clear_scratch(spark, folder)
