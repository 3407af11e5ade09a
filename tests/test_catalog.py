"""Every registered query against its SQL in DuckDB, and its plan against what does not scale."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from areaprice.checks.oracles import ORACLES
from areaprice.checks.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path).removesuffix('.parquet')} as select * from '{path}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 97


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, capsys, name):
    found = contract.queries()[name](spark, SF)
    found.explain("formatted")
    plan = capsys.readouterr().out
    for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert word not in plan
    cursor = database.execute(contract.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(found.columns) == sorted(names)
    expected = sorted(map(repr, cursor.fetchall()))
    assert sorted(repr(tuple(row)) for row in found.select([f"`{name}`" for name in names]).collect()) == expected
    assert expected
