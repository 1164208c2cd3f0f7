import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from fleetmart.contracts import CUSTOMERS, ORDER_STATUSES, ORDER_UPDATE_COLUMNS, ORDERS, TARIFFS
from fleetmart.operators.merge import add_defaults, apply_updates, insert_if_absent, upsert
from fleetmart.operators.quality import QualityError
from tests.conftest import rows

D = decimal.Decimal
T0, T1 = datetime.datetime(2026, 1, 1), datetime.datetime(2026, 1, 2)

ORDER_SCHEMA = (
    "order_id bigint, external_order_id string, customer_id bigint, driver_id bigint, pickup_location_id bigint, "
    "dropoff_location_id bigint, tariff_id int, price decimal(10,2), distance_km decimal(7,3), "
    "created_at timestamp_ntz, delivered_at timestamp_ntz, current_status int"
)
BATCH_SCHEMA = "at int, " + ORDER_SCHEMA.split(", ", 1)[1]


def test_stored_row_wins_then_first_of_batch(frame):
    stored = frame("status_id int, name string", (1, "new"), (2, "done"))
    batch = frame("at int, name string", (1, "done"), (3, "lost"), (2, "lost"), (4, "found"))
    assert rows(insert_if_absent(stored, batch, ORDER_STATUSES, ["at"])) == [(1, "new"), (2, "done"), (3, "lost"), (4, "found")]


def test_insert_twice_is_insert_once(frame):
    stored = frame("status_id int, name string", (1, "new"))
    batch = frame("at int, name string", (1, "done"), (2, "new"))
    once = insert_if_absent(stored, batch, ORDER_STATUSES, ["at"])
    assert rows(insert_if_absent(once, batch, ORDER_STATUSES, ["at"])) == rows(once)


def test_missing_keys_never_conflict(frame):
    schema = "customer_id bigint, external_id string, name string, phone string, email string, created_at timestamp_ntz"
    stored = frame(schema, (1, None, "a", None, None, T0))
    batch = frame("at int, " + schema.split(", ", 1)[1], (1, None, "b", None, None, T0), (2, None, "c", None, None, T0))
    got = insert_if_absent(stored, batch, CUSTOMERS, ["at"])
    assert rows(got, "customer_id", "name") == [(1, "a"), (2, "b"), (3, "c")]


def test_only_five_columns_change(frame):
    stored = frame(ORDER_SCHEMA, (4, "o1", 1, 2, 3, 4, 5, D("10.00"), D("1.000"), T0, None, 1), (5, "o2", 1, 2, 3, 4, 5, D("7.00"), D("1.000"), T0, None, 1))
    batch = frame(BATCH_SCHEMA, (1, "o1", 91, 92, 93, 94, 95, D("20.00"), D("2.000"), T1, T1, 6), (2, "o3", 1, None, 3, 4, 5, D("5.00"), D("3.000"), T1, T1, 5))
    assert rows(upsert(stored, batch, ORDERS, ORDER_UPDATE_COLUMNS, ["at"])) == [
        (4, "o1", 1, 92, 3, 4, 5, D("20.00"), D("2.000"), T0, T1, 6),
        (5, "o2", 1, 2, 3, 4, 5, D("7.00"), D("1.000"), T0, None, 1),
        (6, "o3", 1, None, 3, 4, 5, D("5.00"), D("3.000"), T1, T1, 5),
    ]


def test_absent_columns_bring_their_defaults(frame):
    stored = frame(ORDER_SCHEMA, (4, "o1", 1, 2, 3, 4, 5, D("10.00"), D("1.000"), T0, T1, 5))
    batch = frame(BATCH_SCHEMA, (1, "o1", 1, 2, 3, 4, 5, D("10.00"), D("1.000"), T0, T1, 5)).drop("delivered_at", "current_status")
    got = upsert(stored, batch, ORDERS, ORDER_UPDATE_COLUMNS, ["at"])
    assert rows(got, "delivered_at", "current_status") == [(None, 1)]


def test_orders_without_key_survive_an_update(frame):
    stored = frame("order_id int, k string, v int", (1, None, 1), (2, None, 2), (3, "a", 3))
    changes = frame("k string, v int", ("a", 9))
    assert rows(apply_updates(stored, changes, "k", ["v"])) == [(1, None, 1), (2, None, 2), (3, "a", 9)]


def test_defaults_are_for_absent_columns_only(frame):
    assert rows(add_defaults(frame("name string, base_price decimal(10,2)", ("x", None)), TARIFFS), "base_price", "per_km") == [(None, D("0.00"))]
    assert rows(add_defaults(frame("name string", ("x",)), TARIFFS), "base_price") == [(D("300.00"),)]
    assert add_defaults(frame("name string", ("x",)), TARIFFS).where(F.col("created_at").isNull()).isEmpty()


def test_upsert_refuses_a_batch_that_repeats_a_key(frame):
    stored = frame(ORDER_SCHEMA)
    row = ("k", 1, None, 1, 1, 1, D(1), D(1), T0, None, 1)
    with pytest.raises(QualityError, match="external_order_id"):
        upsert(stored, frame(BATCH_SCHEMA, (1, *row), (2, *row)), ORDERS, ORDER_UPDATE_COLUMNS, ["at"])
