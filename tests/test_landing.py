from pyspark.sql import functions as F

from fleetmart.operators import merge
from fleetmart.plans import generate, pipelines
from fleetmart.plans.cleaners import ORDER_TEXTS, _typed_orders, clean_orders
from fleetmart.plans.export import export_all
from fleetmart.session import materialize
from fleetmart.sources import csv_files
from fleetmart.sources.csv_files import land_csv, write_csv
from tests.conftest import rows


def test_repeated_orders_are_told_apart_in_a_folder_of_the_run(spark, tmp_path):
    """The positions that stay must not be written over the keys they are found by."""
    schema = "external_order_id string, price string, distance_km string, created_at string, " + ", ".join(
        f"{c} string" for c in ("customer_external_id", "driver_external_id", "pickup_address", "dropoff_address", "tariff_name")
    )
    items = [(key, price, "1", "2026-01-01", *["x"] * 5, "f", 0, n) for n, (key, price) in enumerate([("a", "1"), ("b", "2"), ("a", "3"), (" b", "4")])]
    df = spark.createDataFrame(items, f"{schema}, _file string, _block long, _row long")
    df.write.parquet(str(tmp_path / "bronze"))
    kept = clean_orders(spark.read.parquet(str(tmp_path / "bronze")), scratch=str(tmp_path / "scratch"))
    assert [(k, str(p)) for k, p in rows(kept, "external_order_id", "price")] == [("a", "1.00"), ("b", "2.00")]


def test_keys_of_a_delivery_are_looked_up_once(spark, tmp_path, monkeypatch):
    """The key index has found the stored orders among them; they aren't compared with the delivery's keys again."""
    made = generate.generate_warehouse(spark, str(tmp_path / "made"), orders=60, customers=6, drivers=6, locations=6)
    raw = str(tmp_path / "raw")
    export_all(made, raw)
    pipelines.run_full(spark, raw, str(tmp_path / "wh"))
    kinds = []
    looked_up = merge.lookup
    monkeypatch.setattr(merge, "lookup", lambda fact, dim, on, take, how="left", **more: kinds.append(how) or looked_up(fact, dim, on, take, how, **more))
    orders = spark.read.options(header=True).csv(f"{raw}/orders.csv").where("substring(external_order_id, -1) < '5'")
    dearer = orders.withColumn("price", F.lit("7.00"))
    new = dearer.withColumn("external_order_id", F.concat(F.lit("new_"), "external_order_id"))
    write_csv(dearer.unionByName(new), f"{raw}/orders_2026_03_01.csv")
    stored = pipelines.run_daily(spark, "2026_03_01", raw, str(tmp_path / "wh")).read("orders")
    assert kinds == ["left", "left"]
    assert stored.count() == 60 + new.count() and stored.where("price = 7").count() >= 2 * new.count()
    assert stored.select("external_order_id").distinct().count() == stored.count()


def test_only_lines_with_a_carriage_return_are_searched_for_it(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_bytes("﻿a,b\r\n1,x\ry\r\n\"2,\",z\n3,w\r\r\n4,é\r\n".encode())
    found = land_csv(spark, str(path), lambda df: materialize(df, "landed", str(tmp_path / "landed")))
    assert rows(found, "a", "b") == [("1", "x\ry"), ("2,", "z"), ("3", "w"), ("4", "é")]
    lines = csv_files._lines(spark, [str(path)]).select(csv_files._no_return("_line").alias("line"), csv_files._quotes("_line").alias("n"))
    assert rows(lines.where("n > 0"), "line", "n") == [('"2,",z', 2)]
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "StartsWith(value" in plan and "Contains(" in plan


def test_prices_and_times_are_parsed_once(spark):
    """The filter of readable rows stands above the step that parses them."""
    texts = [*ORDER_TEXTS, "price", "distance_km", "created_at", "delivered_at", "current_status"]
    items = [("a", *["x"] * 5, price, "1", at, None, "1") for price, at in ((" 1.005", "2026-01-01"), ("1e30", " 2026-01-01 "), ("x", "2026-01-01"), ("2", "10:00"), ("3", None))]
    typed = _typed_orders(spark.createDataFrame(items, ", ".join(f"{c} string" for c in texts)))
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    kept = plan.split("Filter")[1].split("Project")[0]
    assert "isnotnull(_created_at#" in kept and "isnotnull(_price#" in kept and "try_cast" not in kept
    assert [(p and str(p), str(at), bad) for p, at, bad in rows(typed, "price", "created_at", "_violations")] == [
        (None, "2026-01-01 00:00:00", "price out of range"), ("1.01", "2026-01-01 00:00:00", "")
    ]
