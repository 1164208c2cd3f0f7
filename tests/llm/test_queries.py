"""Every registered query; those with an SQL twin against it."""

import pytest

import __spark_entry__ as contract
from fleetmart.llm import queries

duckdb = pytest.importorskip("duckdb")

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(contract.queries())
    assert set(queries.ORACLES) <= set(contract.oracle_sql()) and set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twin(spark, name):
    sql = duckdb.connect()
    for table in ("documents", "conversations"):
        sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found = sql.execute(queries.ORACLES[name])
    columns = [c[0] for c in found.description]
    df = queries.QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(columns)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=str) == sorted(found.fetchall(), key=str)


@pytest.mark.parametrize("name", ["op7_sharding", "op10_chat_formatting"])
def test_native(spark, name):
    plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD", "CartesianProduct", "NestedLoopJoin"))
