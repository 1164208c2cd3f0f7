"""Steps of a round trip: what a generated warehouse is made, exported and landed with."""

import threading

import pytest
from pyspark.sql import functions as F

from fleetmart.contracts import DIMENSIONS
from fleetmart.operators import lookup
from fleetmart.plans import export, generate
from fleetmart.session import materialize, together
from fleetmart.sources import csv_files
from tests.conftest import rows


def test_separators_are_counted_only_where_the_parser_found_another_number(spark, tmp_path, monkeypatch):
    path = tmp_path / "x.csv"
    path.write_text('a,b\n"1, 2, 3",x\n"say ""1,2""",y\n', encoding="utf-8")
    counted = lambda record, names: F.when(record.isNotNull(), F.raise_error(F.lit("counted")).cast("boolean"))
    monkeypatch.setattr(csv_files, "_too_many", counted)
    found = csv_files.land_csv(spark, str(path), lambda df: materialize(df, "landed", str(tmp_path / "landed")))
    assert rows(found, "a", "b", "_overflow") == [("1, 2, 3", "x", False), ('say "1,2"', "y", False)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_of_any_number_of_fields(spark, tmp_path, end):
    path = tmp_path / "x.csv"
    path.write_bytes(end.join(["a,b,c", "1", '"2,2",x', "3,x,y", '4,"x,x",y,z', "5,x,,", ""]).encode())
    expected = [("1", None, None, False), ("2,2", "x", None, False), ("3", "x", "y", False), ("4", "x,x", "y", True), ("5", "x", None, True)]
    landed = csv_files.land_csv(spark, str(path), lambda df: materialize(df, "landed", str(tmp_path / "landed")))
    assert rows(landed, "a", "b", "c", "_overflow") == expected
    assert rows(csv_files.read_csv(spark, str(path), multi_line=True), "a", "b", "c", "_overflow") == expected


def test_events_are_numbered_by_one_number(spark, tmp_path, monkeypatch):
    """All first events before all last ones, by order within; sorted by a single number."""
    orders, numbered = [], generate.number_rows
    monkeypatch.setattr(generate, "number_rows", lambda df, column, order, **more: orders.append(order) or numbered(df, column, order, **more))
    made = generate.generate_warehouse(spark, str(tmp_path / "made"), orders=300, customers=6, drivers=6, locations=6)
    assert [len(order) for order in orders] == [1]
    log = generate.order_events(made.read("orders")).orderBy("_round", "order_id").drop("_round").collect()
    stored = made.read("order_events").orderBy("event_id")
    assert [tuple(r) for r in stored.select(*log[0].__fields__).collect()] == [tuple(r) for r in log]
    assert [r[0] for r in stored.select("event_id").collect()] == list(range(1, len(log) + 1))


def test_hot_ids_of_an_export_are_found_in_one_pass(spark, tmp_path, monkeypatch):
    made = generate.generate_warehouse(spark, str(tmp_path / "made"), orders=300, customers=6, drivers=6, locations=6)
    dims = {t.name: made.read(t.name) for t in DIMENSIONS}
    near = rows(export.export_orders(made.read("orders"), dims))
    monkeypatch.setattr(lookup, "hot_keys", lambda *_: pytest.fail("a pass for one column alone"))
    spark.conf.set(lookup.LIMIT_SETTING, "0")
    try:
        assert rows(export.export_orders(made.read("orders"), dims)) == near and len(near) == 300
    finally:
        spark.conf.unset(lookup.LIMIT_SETTING)


def test_steps_run_side_by_side(spark):
    """Two steps that wait for each other; the results keep the order of the steps."""
    meet = threading.Barrier(2, timeout=20)
    assert together([lambda: meet.wait() and 0 or "a", lambda: meet.wait() and 0 or "b"]) == ["a", "b"]


def test_tables_of_a_generated_warehouse_are_filled_side_by_side(spark, tmp_path, monkeypatch):
    steps, run = [], generate.together
    monkeypatch.setattr(generate, "together", lambda jobs: steps.append(len(jobs)) or run(jobs))
    made = generate.generate_warehouse(spark, str(tmp_path / "made"), orders=30, customers=6, drivers=6, locations=6)
    assert steps == [6] and made.version() == 2
    assert made.read("orders").count() == 30 and made.read("tariffs").count() == 5
