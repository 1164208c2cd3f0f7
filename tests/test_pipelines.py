import datetime
import shutil

import pytest
from pyspark.sql import functions as F

from fleetmart.contracts import MARTS, TABLES
from fleetmart.operators.quality import QualityError
from fleetmart.plans import generate, pipelines
from fleetmart.plans.export import export_all
from fleetmart.sources.csv_files import write_csv
from tests.conftest import rows

NATURAL = {"customers": "external_id", "drivers": "external_id", "locations": "address", "tariffs": "name"}


@pytest.fixture(scope="module")
def generated(spark, tmp_path_factory):
    """A small generated warehouse and its six export files."""
    root = tmp_path_factory.mktemp("generated")
    warehouse = generate.generate_warehouse(spark, f"{root}/gold", orders=600, customers=40, drivers=20, locations=15)
    export_all(warehouse, f"{root}/raw")
    return warehouse, f"{root}/raw"


@pytest.fixture(scope="module")
def loaded(spark, generated, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("loaded"))
    return pipelines.run_full(spark, generated[1], root), root


@pytest.fixture
def copy(spark, loaded, tmp_path):
    """The loaded warehouse once more, to be changed."""
    shutil.copytree(loaded[1], tmp_path / "wh")
    return str(tmp_path / "wh")


def snapshot(warehouse):
    return {n: rows(warehouse.read(n)) for n in TABLES if n != "order_events"}


def test_round_trip(generated, loaded, spark, tmp_path):
    """Export, load, export again: the files say the same."""
    first, _ = generated
    again = loaded[0]
    for name, key in NATURAL.items():
        identity = TABLES[name].identity
        assert rows(first.read(name)) == rows(again.read(name)), f"{identity} follows file order"
    columns = [c for c in TABLES["orders"].columns if c != "order_id"]
    assert rows(first.read("orders"), *columns) == rows(again.read("orders"), *columns)
    assert [r[1] for r in rows(again.read("order_statuses"))] == [n.lower() for n in generate.STATUS_NAMES]


def test_marts_add_up(loaded):
    warehouse = loaded[0]
    orders = warehouse.read("orders")
    drivers, customers, sla = (warehouse.read(m.name) for m in MARTS)
    assert drivers.agg(F.sum("total_revenue")).first()[0] == orders.where("driver_id IS NOT NULL").agg(F.sum("price")).first()[0]
    assert customers.agg(F.sum("total_rides")).first()[0] == orders.count() == 600
    assert customers.count() == 40
    assert sla.count() == orders.where("current_status IS NOT NULL").count()


def test_staging_is_gone(loaded, spark):
    from fleetmart.sources import files

    assert files.children(spark, f"{loaded[1]}/staging") == []


def _delivery(spark, loaded, folder, day, change):
    """A daily file with the stored orders, changed."""
    from fleetmart.plans.export import export_orders

    warehouse = loaded[0]
    dims = {n: warehouse.read(n) for n in (*NATURAL, "order_statuses")}
    write_csv(change(export_orders(warehouse.read("orders"), dims)), f"{folder}/orders_{day}.csv")


def test_daily_run_updates_five_columns_and_adds(spark, loaded, copy, tmp_path):
    def change(df):
        known = df.where("external_order_id IN ('order_ext_1', 'order_ext_2')").withColumns(
            {"price": F.lit("77"), "pickup_address": F.col("dropoff_address"), "driver_external_id": F.lit("nobody")}
        )
        fresh = known.limit(1).withColumn("external_order_id", F.lit("order_new"))
        return known.unionByName(fresh)

    _delivery(spark, loaded, tmp_path, "2026_08_11", change)
    before = {r.external_order_id: r for r in loaded[0].read("orders").collect()}
    warehouse = pipelines.run_daily(spark, "2026_08_11", str(tmp_path), copy)
    after = {r.external_order_id: r for r in warehouse.read("orders").collect()}
    assert len(after) == 601 and after["order_new"].order_id == 601
    for key in ("order_ext_1", "order_ext_2"):
        assert after[key].driver_id is None and str(after[key].price) == "77.00"
        for column in ("order_id", "customer_id", "pickup_location_id", "tariff_id", "created_at"):
            assert after[key][column] == before[key][column]
    others = [k for k in before if k not in ("order_ext_1", "order_ext_2")]
    assert all(after[k] == before[k] for k in others)

    once = snapshot(warehouse)
    twice = snapshot(pipelines.run_daily(spark, datetime.date(2026, 8, 11), str(tmp_path), copy))
    assert twice == once


def test_daily_run_on_a_generated_warehouse(spark, generated, loaded, tmp_path):
    """Its fact was written in one go; re-delivered orders still appear once."""
    shutil.copytree(generated[0].root, tmp_path / "wh" / "gold")
    _delivery(spark, loaded, tmp_path, "2026_08_15", lambda df: df.withColumn("price", F.lit("5")))
    warehouse = pipelines.run_daily(spark, "2026_08_15", str(tmp_path), str(tmp_path / "wh"))
    assert warehouse.read("orders").groupBy("price").count().collect()[0]["count"] == 600
    assert warehouse.read("dm_orders_sla").count() == 600


def test_turnaround_report_is_built_by_month(spark, loaded, copy, tmp_path):
    from fleetmart.sources.warehouse import Warehouse

    before = Warehouse(spark, f"{copy}/gold")
    old = set(before.pointer("dm_orders_sla").folders)
    _delivery(spark, loaded, tmp_path, "2026_08_16", lambda df: df.where("created_at < '2026-03-01'").withColumn("price", F.lit("6")))
    warehouse = pipelines.run_daily(spark, "2026_08_16", str(tmp_path), copy)
    kept = {f.rsplit("=")[-1] for f in old & set(warehouse.pointer("dm_orders_sla").folders)}
    assert kept == {"2026-03"}
    assert rows(warehouse.read("dm_orders_sla"), "order_id", "price") == rows(warehouse.read("orders"), "order_id", "price")
    same = warehouse.pointer("dm_orders_sla").folders
    pipelines.build_sla_mart(warehouse)
    assert warehouse.pointer("dm_orders_sla").folders == same, "nothing changed, nothing rebuilt"
    warehouse.replace("tariffs", warehouse.read("tariffs").withColumn("name", F.concat("name", F.lit("!"))))
    renamed = pipelines.build_sla_mart(warehouse)
    assert renamed.where("tariff_name NOT LIKE '%!'").isEmpty() and renamed.count() == 600


def test_optional_columns_may_be_absent(spark, loaded, copy, tmp_path):
    _delivery(spark, loaded, tmp_path, "2026_08_12", lambda df: df.drop("delivered_at", "current_status"))
    orders = pipelines.run_daily(spark, "2026_08_12", str(tmp_path), copy).read("orders")
    assert rows(orders.select("delivered_at", "current_status").distinct()) == [(None, 1)]


def test_unknown_customer_fails_or_is_set_aside(spark, loaded, copy, tmp_path):
    def change(df):
        return df.withColumn(
            "customer_external_id",
            F.when(F.col("external_order_id") == "order_ext_5", "stranger").otherwise(F.col("customer_external_id")),
        ).withColumn("price", F.lit("1"))

    _delivery(spark, loaded, tmp_path, "2026_08_13", change)
    before = snapshot(loaded[0])
    with pytest.raises(QualityError, match="customer_id is null .1 rows"):
        pipelines.run_daily(spark, "2026_08_13", str(tmp_path), copy)
    from fleetmart.sources.warehouse import Warehouse

    assert snapshot(Warehouse(spark, f"{copy}/gold")) == before, "nothing is loaded of a refused batch"
    warehouse = pipelines.run_daily(spark, "2026_08_13", str(tmp_path), copy, on_violation="quarantine")
    assert warehouse.read("orders").where("price = 1").count() == 599
    rejects = spark.read.option("recursiveFileLookup", True).parquet(f"{copy}/gold/rejects/orders")
    assert [r._violations for r in rejects.collect()] == ["customer_id is null"]


def test_unknown_column_is_refused(spark, loaded, copy, tmp_path):
    _delivery(spark, loaded, tmp_path, "2026_08_14", lambda df: df.withColumn("tip", F.lit(1)))
    with pytest.raises(QualityError, match="tip"):
        pipelines.run_daily(spark, "2026_08_14", str(tmp_path), copy)


def test_missing_day(spark, copy, tmp_path):
    with pytest.raises(FileNotFoundError):
        pipelines.run_daily(spark, "2030_01_01", str(tmp_path), copy)


def test_repeated_vehicle_number_is_refused(spark, generated, tmp_path):
    shutil.copytree(generated[1], tmp_path / "raw")
    path = tmp_path / "raw" / "drivers.csv"
    shutil.rmtree(path)
    path.mkdir()
    (path / "part-0.csv").write_text(
        "external_id,name,phone,vehicle_number,created_at\n"
        "drv_ext_1,a,1,x1,2026-01-01\ndrv_ext_2,b,1, X1 ,2026-01-01\ndrv_ext_1,again,1,x9,2026-01-01\n"
    )
    with pytest.raises(QualityError, match="vehicle_number not unique .2 rows"):
        pipelines.run_full(spark, str(tmp_path / "raw"), str(tmp_path / "wh"))


def test_failed_rebuild_leaves_the_old_rows(spark, loaded, copy, tmp_path):
    from fleetmart.sources.warehouse import Warehouse

    before = snapshot(loaded[0])
    with pytest.raises(FileNotFoundError):
        pipelines.run_full(spark, str(tmp_path / "nowhere"), copy)
    assert snapshot(Warehouse(spark, f"{copy}/gold")) == before


def test_other_time_zones_are_refused(spark, generated, copy, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        for run in (
            lambda: pipelines.run_full(spark, generated[1], copy),
            lambda: pipelines.run_daily(spark, "2026_08_11", generated[1], copy),
            lambda: generate.generate_warehouse(spark, str(tmp_path), orders=1),
        ):
            with pytest.raises(ValueError, match="UTC"):
                run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_runs_need_no_folder_but_their_own(spark, generated, loaded, tmp_path, monkeypatch):
    """As on a cluster without spark.checkpoint.dir: nothing may ask for the session's folder."""
    import fleetmart.session

    def refuse(spark):
        raise ValueError("no shared folder")

    monkeypatch.setattr(fleetmart.session, "shared_folder", refuse)
    root = f"{tmp_path}/wh"
    pipelines.run_full(spark, generated[1], root)
    _delivery(spark, loaded, tmp_path, "2026_08_18", lambda df: df.limit(3))
    pipelines.run_daily(spark, "2026_08_18", str(tmp_path), root)
    warehouse = generate.generate_warehouse(spark, f"{tmp_path}/made", orders=20, customers=5, drivers=5, locations=5, drivers_in_use=1)
    assert rows(warehouse.read("orders").where("driver_id is not null").select("driver_id").distinct()) == [(1,)]
    from fleetmart.sources import files

    assert files.children(spark, f"{root}/staging") == [] == files.children(spark, f"{tmp_path}/made/staging")


def test_new_orders_add_folders_and_are_joined_at_last(spark, loaded, copy, tmp_path, monkeypatch):
    monkeypatch.setattr(pipelines, "MOST_FOLDERS", 3)
    before = set(loaded[0].pointer("orders").folders)
    for n, kept in enumerate((True, True, False), 1):
        _delivery(spark, loaded, tmp_path, f"2026_09_0{n}", lambda df, n=n: df.limit(40).withColumn("external_order_id", F.concat("external_order_id", F.lit(f"_{n}"))))
        warehouse = pipelines.run_daily(spark, f"2026_09_0{n}", str(tmp_path), copy)
        assert warehouse.read("orders").count() == 600 + 40 * n
        assert (before <= set(warehouse.pointer("orders").folders)) == kept
    orders = warehouse.read("orders")
    assert orders.select("order_id").distinct().count() == orders.count() == orders.agg(F.max("order_id")).first()[0]
    assert warehouse.read("dm_orders_sla").count() == 720


def test_quarantine_keeps_unknown_columns_and_replaces_a_rerun(spark, loaded, copy, tmp_path):
    def change(df):
        stranger = F.when(F.col("external_order_id") == "order_ext_7", "stranger").otherwise(F.col("customer_external_id"))
        return df.withColumn("customer_external_id", stranger).withColumn("tip", F.lit("3"))

    _delivery(spark, loaded, tmp_path, "2026_08_19", change)
    for _ in range(2):
        pipelines.run_daily(spark, "2026_08_19", str(tmp_path), copy, on_violation="quarantine")
        assert [r.external_order_id for r in spark.read.parquet(f"{copy}/gold/rejects/orders").collect()] == ["order_ext_7"]
        unknown = spark.read.parquet(f"{copy}/gold/unknown/orders")
        assert unknown.count() == 600 and rows(unknown.select("tip").distinct()) == [("3",)]


def test_reports_read_changed_months_only(spark, loaded, copy, tmp_path):
    from fleetmart.sources.warehouse import Warehouse

    before = Warehouse(spark, f"{copy}/gold")
    old = {t: set(before.pointer(t).folders) for t in ("driver_months", "customer_months")}
    _delivery(spark, loaded, tmp_path, "2026_08_20", lambda df: df.where("created_at < '2026-03-01'").withColumn("price", F.lit("8")))
    warehouse = pipelines.run_daily(spark, "2026_08_20", str(tmp_path), copy)
    for table, folders in old.items():
        assert {f.rsplit("=")[-1] for f in folders & set(warehouse.pointer(table).folders)} == {"2026-03"}
    from fleetmart.plans import marts

    orders = warehouse.read("orders")
    assert rows(warehouse.read("dm_drivers_efficiency")) == rows(marts.drivers_efficiency(orders, warehouse.read("drivers")))
    assert rows(warehouse.read("dm_customer_analytics")) == rows(marts.customer_analytics(orders, warehouse.read("customers")))
