import re

import pytest
from pyspark.sql import functions as F

from fleetmart.contracts import ORDER_KEYS
from fleetmart.plans import changes
from fleetmart.plans.generate import with_month
from fleetmart.sources import key_index
from fleetmart.sources.warehouse import init_warehouse
from tests.conftest import rows
from tests.test_storage import order, orders

ALL = [f"{b:03d}" for b in range(key_index.BUCKETS)]


@pytest.fixture
def warehouse(spark, tmp_path, frame):
    made = init_warehouse(spark, str(tmp_path / "gold"))
    with made.together():
        made.replace("orders", orders(frame, *[order(n, f"2026-0{1 + n % 3}-05") for n in range(1, 301)]))
        key_index.build(made)
    return made


def batch(frame, *keys):
    return frame("external_order_id string", *[(k,) for k in keys])


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_buckets_of_the_batch_are_read(warehouse, frame):
    keys = batch(frame, "o7", "o250", "unheard of", None)
    found = key_index.find(warehouse, keys)
    assert rows(found) == [("o250", "2026-02"), ("o7", "2026-02")]
    wanted = {r[0] for r in keys.where("external_order_id IS NOT NULL").select(key_index.bucket("external_order_id")).distinct().collect()}
    assert key_index.folders_read(found) == wanted and len(wanted) <= 3
    plan = physical(found)
    assert not re.search(r"orders/v=", plan), "the fact isn't touched"
    assert re.search(r"PushedFilters: \[.*In\(external_order_id", plan)


def test_long_batches_read_whole_buckets(warehouse, frame, monkeypatch):
    monkeypatch.setattr(key_index, "FEW_KEYS", 5)
    found = key_index.find(warehouse, batch(frame, *[f"o{n}" for n in range(290, 320)]))
    assert len(rows(found)) == 11 and "In(external_order_id" not in physical(found)


def test_files_carry_filters(warehouse, spark):
    """Filtering by value skips row groups by dictionary, range or Bloom filter; the writer was asked for the latter."""
    from fleetmart.sources.warehouse import _blooms

    assert _blooms(ORDER_KEYS)["parquet.bloom.filter.enabled#external_order_id"] == "true"
    assert key_index.covers(warehouse, ALL)


def test_the_index_follows_the_orders(warehouse, frame):
    with warehouse.together():
        new = orders(frame, order(901, "2026-01-09"), order(902, "2026-05-09"))
        warehouse.replace_partitions("orders", new.limit(0), [], 902, added=new)
        key_index.add(warehouse, new)
    assert key_index.is_current(warehouse) and key_index.covers(warehouse, ALL)
    changes.delete_rows(warehouse, "orders", frame("order_id long", (7,), (901,), (12345,)))
    assert key_index.is_current(warehouse) and key_index.covers(warehouse, ALL)
    assert rows(key_index.find(warehouse, batch(frame, "o7", "o8", "o901", "o902"))) == [("o8", "2026-03"), ("o902", "2026-05")]


def test_full_buckets_are_joined(warehouse, frame, monkeypatch):
    monkeypatch.setattr(key_index, "MOST_FOLDERS", 2)
    one = with_month(orders(frame, order(901, "2026-01-09")).drop("created_month"))
    for n in range(901, 904):
        new = one.withColumns({"order_id": F.lit(n).cast("bigint"), "external_order_id": F.lit("o901") if n == 901 else F.lit(f"x{n}")})
        with warehouse.together():
            warehouse.replace_partitions("orders", new.limit(0), [], n, added=new)
            key_index.add(warehouse, new)
    assert key_index.covers(warehouse, ALL)


def test_an_index_of_other_files_is_built_anew(warehouse, frame):
    warehouse.replace("orders", orders(frame, order(1, "2026-04-05"), order(500, "2026-04-06")))
    assert not key_index.is_current(warehouse)
    assert rows(key_index.find(warehouse, batch(frame, "o1", "o2", "o500"))) == [("o1", "2026-04"), ("o500", "2026-04")]
    assert key_index.is_current(warehouse) and key_index.covers(warehouse, ALL)


def test_an_empty_store(spark, tmp_path, frame):
    empty = init_warehouse(spark, str(tmp_path / "empty"))
    assert rows(key_index.find(empty, batch(frame, "o1"))) == []


def test_a_batch_of_all_buckets_is_looked_at_for_keys_only(warehouse, frame, monkeypatch):
    monkeypatch.setattr(key_index, "FEW_KEYS", 600)
    found = key_index.find(warehouse, batch(frame, *[f"o{n}" for n in range(1, 1001)], None))
    assert len(rows(found)) == 300 and key_index.folders_read(found) <= set(ALL)
