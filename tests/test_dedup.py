from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetmart.operators.dedup import keep_first
from tests.conftest import rows


def test_first_wins(frame):
    df = frame("k string, at int, price int", ("o1", 1, 10), ("o1", 2, 20), ("o2", 3, 5))
    assert rows(keep_first(df, ["k"], ["at"])) == [("o1", 1, 10), ("o2", 3, 5)]


def test_null_keys(frame):
    df = frame("k string, at int", (None, 2), (None, 1), ("a", 3), ("a", 4))
    assert rows(keep_first(df, ["k"], ["at"])) == [(None, 1), ("a", 3)]
    assert rows(keep_first(df, ["k"], ["at"], null_keys="distinct")) == [(None, 1), (None, 2), ("a", 3)]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["hot", "hot", "hot", "a", "b", None]), min_size=1, max_size=60))
def test_against_brute_force(spark, keys):
    df = spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "k string, at int").repartition(4)
    expected = {k: keys.index(k) for k in keys}
    assert {r.k: r.at for r in keep_first(df, ["k"], ["at"]).collect()} == expected


def test_hot_keys_are_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 2 AS k", "id AS at")
    plan = keep_first(df, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below
