"""The registered corpus queries against their SQL, and the pipeline."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from areaprice.llm import catalog

SF = "/root/testdata/sf0.01"
NATIVE = ("op4_personal_data", "op5_quality_rules", "op8_exact_dedup")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path).removesuffix('.parquet')} as select * from '{path}'")
    return connection


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in catalog.QUERIES) == [*range(1, 14)]
    assert {*catalog.QUERIES, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, database, name):
    found = contract.queries()[name](spark, SF)
    cursor = database.execute(contract.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(found.columns) == sorted(names)
    expected = sorted(map(repr, cursor.fetchall()))
    assert sorted(repr(tuple(row)) for row in found.select(names).collect()) == expected
    assert len(expected) == 1000 or name == "op11_spelling_variants"


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_stay_in_the_jvm(spark, capsys, name):
    catalog.QUERIES[name](spark, SF).explain("formatted")
    plan = capsys.readouterr().out
    for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert word not in plan


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
        if name != "best_fit_packing":
            assert docs.columns == columns
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > 0
    assert docs.selectExpr("sequence_id", "offset").distinct().count() == sizes[-1]
    mixed = spark.read.parquet(str(tmp_path / "source_mixing"))
    assert mixed.where("n_chars <> length(text)").isEmpty()
    assert corpus_pipeline.run(spark, SF).count() == sizes[-1]


def test_pipeline_of_nothing(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
