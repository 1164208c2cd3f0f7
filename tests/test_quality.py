import decimal

import pytest

from fleetmart.contracts import LOCATIONS, ORDER_STATUSES, TARIFFS, ForeignKey
from fleetmart.operators import deletes, quality
from tests.conftest import rows

D = decimal.Decimal


def test_gates(frame):
    df = frame("a int, b int", (1, 2))
    assert quality.require_rows(df, "x") is df
    with pytest.raises(quality.QualityError, match="no rows"):
        quality.require_rows(df.where("a > 1"), "x")
    with pytest.raises(quality.QualityError, match="'c'"):
        quality.require_columns(df, ["a", "c"], "x")
    assert quality.extra_columns(df.withColumnRenamed("a", "name"), ORDER_STATUSES) == ["b"]


def test_row_rules(frame):
    df = frame(
        "address string, lat decimal(9,6), lon decimal(9,6)",
        ("ok", D(90), D(-180)),
        ("far", D(91), D(181)),
        (None, None, None),
    )
    assert rows(quality.not_null_violations(df.selectExpr("1L AS location_id", "*"), LOCATIONS, ["address"])) == [(None, "address is null")]
    assert rows(quality.check_violations(df, LOCATIONS, ["address"])) == [("far", "lat_range"), ("far", "lon_range")]
    assert quality.check_violations(frame("name string", ("x",)), ORDER_STATUSES, ["name"]).isEmpty()


def test_set_rules(frame):
    assert rows(quality.unique_violations(frame("k string", ("a",), ("a",), ("b",), (None,), (None,)), "k")) == [("a", 2)]
    child = frame("n int, d int", (1, 1), (2, 9), (3, None))
    parent = frame("driver_id int", (1,), (2,))
    assert rows(quality.fk_orphans(child, parent, ForeignKey("d", "drivers", "driver_id"))) == [(2, 9)]


def test_enforce(frame):
    df = frame("name string, base_price decimal(10,2), per_km decimal(10,2)", ("a", D(1), D(1)), ("b", D(-1), None))
    tagged = quality.tag(df, {**quality.not_null_rules(TARIFFS, ["name", "per_km"]), **quality.check_rules(TARIFFS)})
    good, bad = quality.enforce(tagged, "tariffs", "quarantine")
    assert rows(good, "name") == [("a",)]
    assert [r[quality.VIOLATIONS] for r in bad.collect()] == ["per_km is null; base_price_sign"]
    with pytest.raises(quality.QualityError, match="per_km is null .1 rows"):
        quality.enforce(tagged, "tariffs")
    with pytest.raises(ValueError):
        quality.enforce(tagged, "tariffs", "ignore")


def test_delete_rules(frame):
    customers = frame("customer_id int", (1,), (2,), (3,))
    orders = frame("order_id int, customer_id int, driver_id int", (1, 1, 5), (2, 1, 6), (3, 2, None))
    gone = frame("customer_id int", (1,), (3,))
    assert rows(deletes.blocked_parents(gone, orders, "customer_id", "customer_id")) == [(1,)]
    with pytest.raises(quality.QualityError):
        deletes.delete_restrict(customers, gone, orders, "customer_id", "customer_id")
    free = frame("customer_id int", (3,))
    assert rows(deletes.delete_restrict(customers, free, orders, "customer_id", "customer_id")) == [(1,), (2,)]
    assert rows(deletes.delete_set_null(orders, frame("driver_id int", (5,), (5,)), "driver_id", "driver_id"), "order_id", "driver_id") == [
        (1, None),
        (2, 6),
        (3, None),
    ]
    assert rows(deletes.delete_cascade(orders, frame("customer_id int", (1,)), "customer_id", "customer_id"), "order_id") == [(3,)]
