import decimal
import random

import pytest
from pyspark.sql import functions as F

from fleetmart.operators.lookup import KINDS, LIMIT_SETTING, fits_broadcast, heavy_keys, hot_keys, lookup, measured_bytes
from tests.conftest import rows

FORCE_SHUFFLE = -1


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a third without, some unknown."""
    dice = random.Random(7)
    keys = ["hot"] * 300 + [None] * 300 + ["ghost"] * 100 + [f"k{dice.randrange(60)}" for _ in range(200)]
    fact = spark.createDataFrame([(n, k) for n, k in enumerate(keys)], "n int, k string").repartition(4)
    dim = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i + 2) for i in range(50)] + [(None, 999)], "name string, id int")
    return keys, fact, dim


@pytest.mark.parametrize("limit", [None, FORCE_SHUFFLE])
@pytest.mark.parametrize("how", KINDS)
def test_both_ways_agree_with_a_dict(skewed, how, limit):
    keys, fact, dim = skewed
    ids = {"hot": 1, **{f"k{i}": i + 2 for i in range(50)}}
    take = {"id": "key_id"} if how in ("left", "inner") else {}
    got = rows(lookup(fact, dim, ("k", "name"), take, how, limit))
    if how == "left":
        expected = [(n, k, ids.get(k)) for n, k in enumerate(keys)]
    elif how == "inner":
        expected = [(n, k, ids[k]) for n, k in enumerate(keys) if k in ids]
    elif how == "left_semi":
        expected = [(n, k) for n, k in enumerate(keys) if k in ids]
    else:
        expected = [(n, k) for n, k in enumerate(keys) if k not in ids]
    assert sorted(got, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("how", KINDS)
def test_unique_fact_with_missing_keys(frame, how):
    fact = frame("n int, k string", (1, "a"), (2, "b"), (3, None), (4, None))
    dim = frame("name string, id int", ("a", 7), ("c", 8))
    got = rows(lookup(fact, dim, ("k", "name"), {"id": "x"} if how in ("left", "inner") else {}, how, FORCE_SHUFFLE, fact_unique=True), "n")
    assert got == {"left": [(1,), (2,), (3,), (4,)], "inner": [(1,)], "left_semi": [(1,)], "left_anti": [(2,), (3,), (4,)]}[how]


def test_unknown_kinds_are_refused(frame):
    fact, dim = frame("k string", ("a",)), frame("name string, id int", ("a", 7))
    with pytest.raises(ValueError, match="full"):
        lookup(fact, dim, ("k", "name"), {}, "full")
    with pytest.raises(ValueError, match="left_semi"):
        lookup(fact, dim, ("k", "name"), {"id": "x"}, "left_semi")


@pytest.mark.parametrize("shuffled", [False, True])
def test_equal_rows_spread(spark, shuffled):
    """A third of the rows are equal in all their columns; 32 partitions, 8 reducers."""
    fact = spark.range(0, 96_000, 1, 32).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    if shuffled:
        fact = fact.repartition(32)
    dim = spark.range(0, 96_000, 2, 4).select(F.col("id").alias("name"), F.lit(1).alias("x"))
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in off}
    for k, value in off.items():
        spark.conf.set(k, value)
    try:
        joined = lookup(fact, dim, ("k", "name"), {}, "left_anti", FORCE_SHUFFLE)
        whole = lookup(fact, dim, ("k", "name"), {"x": "x"}, "left", FORCE_SHUFFLE)
        sizes = [r[1] for r in whole.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 96_000 and max(sizes) < 2 * 96_000 / 8
        assert joined.count() == 32_000 + 32_000
    finally:
        for k, value in before.items():
            spark.conf.set(k, value)


def test_hot_keys_are_few(skewed):
    _, fact, _ = skewed
    assert {r[0] for r in hot_keys(fact, "k").collect()} == {"hot", None}


def test_heavy_keys_of_all_columns_at_once(spark, skewed):
    _, fact, dim = skewed
    wide = fact.withColumns({"m": F.when(F.col("n") % 2 == 0, 7).otherwise(F.col("n") + 100), "one": F.lit("1").cast("decimal(5,2)")})
    found = {c: {r[0] for r in df.collect()} for c, df in heavy_keys(wide, ["k", "m", "one", "n"]).items()}
    assert found == {"k": {"hot"}, "m": {7}, "one": {decimal.Decimal("1.00")}, "n": set()}
    assert {c: df.isEmpty() for c, df in heavy_keys(wide.limit(0), ["k", "m"]).items()} == {"k": True, "m": True}
    plain = rows(lookup(fact, dim, ("k", "name"), {"id": "x"}, "left"))
    assert rows(lookup(fact, dim, ("k", "name"), {"id": "x"}, "left", hot=heavy_keys(fact, ["k"])["k"])) == plain


def test_no_reducer_gets_a_hot_key(spark, skewed):
    """Rows per reducer after the spread, with four reducers and 900 rows."""
    _, fact, dim = skewed
    joined = lookup(fact, dim, ("k", "name"), {"id": "key_id"}, "left", FORCE_SHUFFLE)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = lookup(fact, dim, ("k", "name"), {"id": "key_id"}, "left", FORCE_SHUFFLE)
        plan = again._jdf.queryExecution().executedPlan().toString()
        sizes = [r[1] for r in again.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(_key#" in plan and "_spread#" in plan.split("hashpartitioning(_key#")[1][:40]
    assert len(sizes) == 4 and max(sizes) < 2 * 900 / 4
    assert joined.count() == 900


def test_size_is_checked(spark):
    small = spark.range(10)
    assert measured_bytes(spark.createDataFrame([("x" * 100,)] * 10, "s string")) >= 1000
    assert fits_broadcast(small)
    assert not fits_broadcast(spark.range(1_000_000), limit=1_000_000)
    spark.conf.set(LIMIT_SETTING, "0")
    try:
        assert not fits_broadcast(small)
    finally:
        spark.conf.unset(LIMIT_SETTING)
