"""Every query against its SQL twin on the smallest test tables."""

import decimal
import math
import re

import pytest

import __spark_entry__ as contract
from fleetmart.workload.oracle import ORACLES
from fleetmart.workload.queries import QUERIES

duckdb = pytest.importorskip("duckdb")

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        raise AssertionError("decimals compare differently across engines")
    return value


def table(names, found):
    order = [names.index(n) for n in sorted(names)]
    return sorted(sorted(names)), sorted((tuple(plain(r[i]) for i in order) for r in found), key=str)


def stays_distributed(df):
    """No Python per row, no nested loops, no window without partitions."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"EvalPython|MapInPandas|CartesianProduct|NestedLoopJoin", plan)
    for line in plan.splitlines():
        if "Window [" in line and "_part" not in line:
            assert not re.search(r"\], \[\], \[", line), line


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, FOLDER)
    stays_distributed(df)
    found = sql.execute(ORACLES[name])
    expected = table([c[0] for c in found.description], found.fetchall())
    assert table(df.columns, [tuple(r) for r in df.collect()]) == expected
    assert expected[1], "a check on no rows proves nothing"


def test_entry(spark):
    assert contract.entry(spark).count() > 0
