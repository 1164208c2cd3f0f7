"""Deliveries of the workload and how a day of them is stored."""

import datetime

import pytest
from pyspark.sql import functions as F

from fleetmart.operators import keys
from fleetmart.plans import generate, pipelines
from fleetmart.plans.export import export_all
from fleetmart.sources.csv_files import write_csv
from fleetmart.sources.warehouse import Warehouse, partition_of
from fleetmart.workload import queries
from fleetmart.workload.views import Views
from tests.conftest import rows
from tests.test_storage import order, orders


@pytest.fixture
def tables(spark, tmp_path):
    """Four orders before 1998, six since 1999, each with two lines, and what they refer to."""
    days = [datetime.datetime(1997 if n < 5 else 1999, 1 + n, 1) for n in range(1, 11)]
    made = {
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string", [(500 * n + 3, n % 3, "F", 10.0 * n, day, "1-URGENT") for n, day in enumerate(days, 1)]),
        "lineitem": ("l_orderkey long, l_suppkey long, l_quantity double, l_shipdate timestamp_ntz", [(500 * n + 3, n % 2, 1.0 + n, day) for n, day in enumerate(days, 1) for _ in range(2)]),
        "customer": ("c_custkey long, c_name string", [(n, f"c{n}") for n in range(3)]),
        "supplier": ("s_suppkey long, s_name string", [(n, f"s{n}") for n in range(4)]),
        "nation": ("n_nationkey long, n_name string, n_regionkey long", [(n, f"NATION_{n}", n % 5) for n in range(25)]),
    }
    for name, (schema, items) in made.items():
        spark.createDataFrame(items, schema).write.parquet(f"{tmp_path}/tables/{name}.parquet")
    return f"{tmp_path}/tables"


def read_by(df):
    return {f.split(".parquet")[0].rsplit("/", 1)[-1] for f in df.inputFiles()}


def test_both_files_of_run_daily_are_cut_from_stored_rows(spark, tables, tmp_path, monkeypatch):
    """The lines are summed up and joined once, not for each file and each pass of its sort."""
    written = {}
    keep = lambda df, path, **more: written.setdefault(path.rsplit("/", 1)[-1], df) and path
    monkeypatch.setattr(queries, "write_csv", keep)
    monkeypatch.setattr(pipelines, "run_full", lambda *_: None)
    monkeypatch.setattr(pipelines, "run_daily", lambda *_: None)
    queries._daily_warehouse(Views(spark, tables))
    early, late = written["orders.csv"], written["orders_1999_01_01.csv"]
    assert (early.count(), late.count()) == (4, 6)
    assert not {"orders", "lineitem"} & (read_by(early) | read_by(late))


def test_a_small_day_is_cut_from_the_tables_once(spark, tables, monkeypatch):
    """indexed_upsert writes its orders and looks for their keys from stored rows."""
    looked_for, find = [], queries.key_index.find
    monkeypatch.setattr(queries.key_index, "find", lambda warehouse, keys: looked_for.append(keys) or find(warehouse, keys))
    got = queries.QUERIES["indexed_upsert"](spark, tables)
    (wanted,) = [keys for keys in looked_for if "o_orderkey" in keys.columns]
    assert not {"orders", "lineitem"} & read_by(wanted)
    assert got.count() == 20 and rows(got.select("keys_found").distinct()) == [(10,)]
    assert rows(got.where("external_order_id LIKE '%order_ext_503'"), "external_order_id", "price") == rows(
        spark.createDataFrame([("new_order_ext_503", 10.0), ("order_ext_503", 11.0)], "k string, p double").select("k", F.col("p").cast("decimal(10,2)"))
    )


def test_a_day_is_stored_in_one_write(spark, tmp_path, monkeypatch):
    """Rewritten months and new orders of others go into the same folder, the new ones numbered once."""
    made = generate.generate_warehouse(spark, str(tmp_path / "made"), orders=80, customers=6, drivers=6, locations=6)
    raw, root = str(tmp_path / "raw"), str(tmp_path / "wh")
    export_all(made, raw)
    before = pipelines.run_full(spark, raw, root).pointer("orders").folders
    stored = spark.read.options(header=True).csv(f"{raw}/orders.csv")
    month = F.substring("created_at", 1, 7)
    first = stored.agg(F.min(month)).first()[0]
    again = stored.where(month == first).withColumn("price", F.lit("7.00"))
    new = stored.withColumn("external_order_id", F.concat(F.lit("new_"), "external_order_id"))
    assert new.select(month).distinct().count() > 1
    write_csv(again.unionByName(new), f"{raw}/orders_2026_03_01.csv")
    written, write = [], Warehouse._write
    monkeypatch.setattr(Warehouse, "_write", lambda self, table, df: written.append(table.name) or write(self, table, df))
    warehouse = pipelines.run_daily(spark, "2026_03_01", raw, root)
    assert written.count("orders") == 1
    after, all_orders = warehouse.pointer("orders").folders, warehouse.read("orders")
    assert {partition_of(f) for f in set(before) - set(after)} == {first}
    assert all_orders.count() == 160 and all_orders.where("price = 7").count() >= again.count()
    assert sorted(r.order_id for r in all_orders.select("order_id").collect()) == list(range(1, 161))


def test_rows_of_other_partitions_are_added_only_if_said(frame, spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "gold"))
    warehouse.create("orders")
    warehouse.replace_partitions("orders", orders(frame, order(1, "2026-01-05"), order(2, "2026-02-05")), ["2026-01", "2026-02"])
    rows_now = orders(frame, order(2, "2026-02-05", 9), order(3, "2026-01-06"))
    with pytest.raises(ValueError, match="outside"):
        warehouse.replace_partitions("orders", rows_now, ["2026-02"])
    now = warehouse.replace_partitions("orders", rows_now, ["2026-02"], add_others=True)
    assert rows(now, "order_id", "price") == rows(orders(frame, order(1, "2026-01-05"), order(2, "2026-02-05", 9), order(3, "2026-01-06")), "order_id", "price")


def test_a_month_is_rewritten_only_for_orders_that_change(spark, tmp_path):
    """Orders delivered as they are stored change nothing, also beside others that do; a value that goes or comes is a change."""
    made = generate.generate_warehouse(spark, str(tmp_path / "made"), orders=80, customers=6, drivers=6, locations=6)
    raw, root = str(tmp_path / "raw"), str(tmp_path / "wh")
    export_all(made, raw)
    stored = pipelines.run_full(spark, raw, root)
    first, old = {t: stored.pointer(t).folders for t in ("orders", "dm_orders_sla", "driver_months")}, rows(stored.read("orders"))
    again = spark.read.options(header=True).csv(f"{raw}/orders.csv")
    write_csv(again, f"{raw}/orders_2026_03_01.csv")
    for _ in range(2):
        same = pipelines.run_daily(spark, "2026_03_01", raw, root)
        assert {t: same.pointer(t).folders for t in first} == first and rows(same.read("orders")) == old

    key, month = "external_order_id", F.substring("created_at", 1, 7)
    months = sorted(r[0] for r in again.select(month).distinct().collect())
    assert len(months) > 1
    done = again.where((month == months[0]) & F.col("delivered_at").isNotNull()).agg(F.min(key)).first()[0]
    for day, value in (("2026_03_02", F.lit(None).cast("string")), ("2026_03_03", F.col("delivered_at"))):
        before = pipelines.Warehouse(spark, f"{root}/gold").pointer("orders").folders
        write_csv(again.withColumn("delivered_at", F.when(F.col(key) == done, value).otherwise(F.col("delivered_at"))), f"{raw}/orders_{day}.csv")
        now = pipelines.run_daily(spark, day, raw, root)
        assert {partition_of(f) for f in set(before) - set(now.pointer("orders").folders)} == {months[0]}
        changed = now.read("orders").where(F.col(key) == done).first()
        assert (changed.delivered_at is None) == (day == "2026_03_02") and now.read("orders").count() == 80
        assert now.read("dm_orders_sla").where(F.col(key) == done).first().order_delivered_at == changed.delivered_at
    assert rows(now.read("orders")) == old


def test_rows_meet_large_dimensions_last(frame, monkeypatch):
    """They are shuffled when the other texts are numbers; the columns stand as ever."""
    seen, look_up = [], keys.lookup
    monkeypatch.setattr(keys, "fits_broadcast", lambda dim: "name" in dim.columns or "address" in dim.columns)
    monkeypatch.setattr(keys, "lookup", lambda fact, dim, on, take, **more: seen.append(on[0]) or look_up(fact, dim, on, take, **more))
    texts = [k[0] for k in keys.ORDER_KEYS]
    given = frame("n int, " + ", ".join(f"{c} string" for c in texts), (1, "a", "a", "a", "b", "a"), (2, "b", "b", "b", None, "?"))
    dims = {dim: frame(f"{natural} string, {number} long", ("a", 1), ("b", 2)) for _, dim, natural, number, _ in keys.ORDER_KEYS}
    got = keys.resolve_order_keys(given, dims)
    assert seen == [*texts[2:], *texts[:2]] and got.columns == ["n", *[k[-1] for k in keys.ORDER_KEYS]]
    assert rows(got) == [(1, 1, 1, 1, 2, 1), (2, 2, 2, 2, None, None)]
