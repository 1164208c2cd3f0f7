"""Full rebuild and daily increment.

A run is one version of the warehouse. Of two runs at the same time the one
that ends later fails and changes nothing.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.contracts import (
    CUSTOMER_MONTHS,
    CUSTOMER_SPANS,
    DIMENSIONS,
    DM_ORDERS_SLA,
    DRIVER_MONTHS,
    DRIVER_SPANS,
    ORDER_UPDATE_COLUMNS,
    ORDERS,
    RAW_FILES,
    TABLES,
    RawFile,
    Table,
)
from fleetmart.operators import quality
from fleetmart.operators.keys import number_delivered, number_rows, resolve_order_keys
from fleetmart.operators.lookup import lookup
from fleetmart.operators.merge import absent_rows, add_defaults, apply_updates, flag_known
from fleetmart.plans import marts, spans
from fleetmart.plans.cleaners import CLEANERS
from fleetmart.plans.generate import with_month
from fleetmart.session import materialize, require_utc, together
from fleetmart.sources import files, key_index
from fleetmart.sources.csv_files import POSITION, land_csv, read_csv
from fleetmart.sources.layers import Layers
from fleetmart.sources.warehouse import Warehouse, partition_of

FULL = "full"
# Most folders a month may have before it is rewritten as one.
MOST_FOLDERS = 32
DAY_FORMAT = "%Y_%m_%d"


# -- extract -----------------------------------------------------------------


def extract(spark: SparkSession, entity: str, path: str, multi_line: bool | None = None) -> DataFrame:
    """A delivered file behind its gates: there, not empty, columns complete."""
    raw: RawFile = RAW_FILES[entity]
    rows = read_csv(spark, path, multi_line)
    quality.require_columns(rows, raw.required, path)
    return rows if raw.may_be_empty else quality.require_rows(rows, path)


def _land(spark: SparkSession, entity: str, path: str, save: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A delivered file behind its gates, stored. A clean file is read once (and its first row, to see that there is one)."""
    raw: RawFile = RAW_FILES[entity]
    if not raw.may_be_empty:
        quality.require_rows(read_csv(spark, path, multi_line=False), path)

    def gated(rows: DataFrame) -> DataFrame:
        quality.require_columns(rows, raw.required, path)
        return save(rows)

    return land_csv(spark, path, gated)


def _clean(entity: str, bronze: DataFrame, staging: str) -> DataFrame:
    if entity == "orders":
        return CLEANERS[entity](bronze, scratch=f"{staging}/doubtful_keys")
    return CLEANERS[entity](bronze)


# -- load --------------------------------------------------------------------


def _to_contract(warehouse: Warehouse, df: DataFrame, table: Table, on_violation: str, run: str) -> DataFrame:
    """The table's columns only. Others are refused; in quarantine their values
    are put aside with the rows' natural keys."""
    unknown = quality.extra_columns(df, table)
    if unknown and on_violation == "fail":
        raise quality.QualityError(f"{table.name}: unknown columns {unknown}")
    if unknown:
        _put_aside(warehouse, f"unknown/{table.name}", df.select(table.natural_key, *unknown), run)
    return df.drop(*unknown)


def _put_aside(warehouse: Warehouse, what: str, rows: DataFrame, run: str) -> None:
    """One folder per run; the same run again replaces it."""
    rows.write.mode("overwrite").parquet(f"{warehouse.root}/{what}/run={run}")


def _gate(warehouse: Warehouse, table: Table, rows: DataFrame, on_violation: str, run: str) -> DataFrame:
    good, bad = quality.enforce(rows, table.name, on_violation)
    if bad is not None:
        _put_aside(warehouse, f"rejects/{table.name}", bad, run)
    return good


def load_dimension(
    warehouse: Warehouse, table: Table, silver: DataFrame, staging: str, on_violation: str = "fail", run: str = FULL
) -> None:
    """Insert-if-absent on the natural key, with new ids in file order.

    Every delivered row must satisfy the row rules, also one that is then
    skipped because its key is known. Other unique columns are no conflict
    target: a repeated value there is a violation.
    """
    rows = _to_contract(warehouse, add_defaults(silver, table), table, on_violation, run)
    rows = quality.tag(rows, {**quality.not_null_rules(table), **quality.check_rules(table)})
    rows = _gate(warehouse, table, rows, on_violation, run)
    stored = warehouse.read(table.name)
    new = absent_rows(stored, rows, table.natural_key, POSITION)
    other_unique = [c for c in table.unique if c != table.natural_key]
    if other_unique:
        new = materialize(new, "new", f"{staging}/new_{table.name}")
        for column in other_unique:
            new = _flag_clashes(new, stored, column)
        new = _gate(warehouse, table, new, on_violation, f"{run}_unique")
    numbered, last_id = number_rows(
        new, table.identity, POSITION, warehouse.pointer(table.name).last_id, f"{staging}/numbered_{table.name}"
    )
    warehouse.append(table.name, numbered, last_id)


def _flag_clashes(new: DataFrame, stored: DataFrame, column: str) -> DataFrame:
    """Tag rows whose value is taken, by a stored row or an earlier new one."""
    values = new.select(column).unionByName(stored.select(column))
    taken = quality.unique_violations(values, column).withColumn("_taken", F.lit(True))
    flagged = lookup(new, taken, (column, column), {"_taken": "_taken"})
    return quality.tag(flagged, {f"{column} not unique": F.col("_taken")}).drop("_taken")


def load_orders(
    warehouse: Warehouse, silver: DataFrame, staging: str, on_violation: str = "fail", run: str = FULL
) -> None:
    """Keys resolved, then upsert on the external order id.

    Known orders are found by the key index and compared with what is stored; only
    months with an order that a delivery changes are read whole and rewritten. New orders of other months are added to them as
    further folders, until a month has ``MOST_FOLDERS``; then it is rewritten as one.
    """
    dims = {t.name: warehouse.read(t.name) for t in DIMENSIONS}
    resolved = resolve_order_keys(silver, dims)
    resolved = _to_contract(warehouse, add_defaults(resolved, ORDERS), ORDERS, on_violation, run)
    resolved = lookup(
        resolved,
        dims["order_statuses"].withColumn("_known_status", F.lit(True)),
        ("current_status", "status_id"),
        {"_known_status": "_known_status"},
    )
    resolved = quality.tag(
        resolved,
        {
            **quality.not_null_rules(ORDERS),
            **quality.check_rules(ORDERS),
            "current_status unknown": F.col("current_status").isNotNull() & F.col("_known_status").isNull(),
        },
    ).drop("_known_status")
    key, month = ORDERS.natural_key, ORDERS.partition_by
    stored = warehouse.read(ORDERS.name)
    keys = key_index.find(warehouse, silver).withColumnRenamed("stored_month", "_stored_month")
    flagged = flag_known(materialize(keys, "hits", f"{staging}/hits"), resolved, key)
    flagged = materialize(with_month(flagged), "flagged", f"{staging}/flagged")
    batch = _gate(warehouse, ORDERS, flagged, on_violation, run)

    before = warehouse.pointer(ORDERS.name)
    folders = Counter(map(partition_of, before.folders))
    known = [r["_stored_month"] for r in batch.where("_known").select("_stored_month").distinct().collect()]
    changes = materialize(_changes(stored.where(F.col(month).isin(known)), batch.where("_known")), "changes", f"{staging}/changes")
    changed = [r[month] for r in changes.select(month).distinct().collect()]
    touched = sorted({*changed, *(m for m, n in folders.items() if n >= MOST_FOLDERS)})
    numbered, last_id = number_delivered(batch.where("NOT _known"), ORDERS.identity, before.last_id, path=f"{staging}/chunks")
    updated = apply_updates(stored.where(F.col(month).isin(touched)), changes, key, ORDER_UPDATE_COLUMNS)
    rows = updated.unionByName(numbered.select(*updated.columns))
    with warehouse.together():
        warehouse.replace_partitions(ORDERS.name, rows, touched, last_id, add_others=True)
        key_index.add(warehouse, batch.where("NOT _known"))


def _changes(stored: DataFrame, known: DataFrame) -> DataFrame:
    """Delivered values (key and update columns) of the stored orders that have others, with the month these are in.

    Only the columns that an update takes over are read and compared; in all others an order stays as stored.
    """
    key, month = ORDERS.natural_key, ORDERS.partition_by
    said = known.select(key, *[F.col(c).cast(ORDERS.schema[c].dataType) for c in ORDER_UPDATE_COLUMNS])
    was = stored.select(key, month, *[F.col(c).alias(f"_was_{c}") for c in ORDER_UPDATE_COLUMNS])
    both = lookup(was, said, (key, key), {c: c for c in ORDER_UPDATE_COLUMNS}, "inner", fact_unique=True)
    same = [F.col(c).eqNullSafe(F.col(f"_was_{c}")) for c in ORDER_UPDATE_COLUMNS]
    return both.where(~reduce(and_, same)).select(key, month, *ORDER_UPDATE_COLUMNS)


# -- marts -------------------------------------------------------------------


def _totals_by_month(warehouse: Warehouse, table: Table, totals: Callable[..., DataFrame]) -> DataFrame:
    """The stored totals per key and month. Those of folders added to a month since the last build come
    to it as further rows; months that have lost a folder are made anew."""
    if not warehouse.has(table.name):
        warehouse.create(table.name)
    month = table.partition_by
    fact, built = (set(x) for x in (warehouse.pointer("orders").folders, warehouse.pointer(table.name).built_from))
    if fact == built:
        return warehouse.read(table.name)
    anew, folders = _changed(fact, built)
    rows = totals(warehouse.read("orders", folders=folders), month)
    return warehouse.replace_partitions(table.name, rows, anew, built_from=sorted(fact), add_others=True)


def _changed(fact: set[str], built: set[str]) -> tuple[list[str], list[str]]:
    """Months that have lost a folder since the last build, and the folders to read: all of these months, and the new ones."""
    anew = {partition_of(f) for f in built - fact}
    return sorted(anew), sorted(f for f in fact if f not in built or partition_of(f) in anew)


def build_drivers_mart(warehouse: Warehouse) -> DataFrame:
    """Only new folders of the fact are read, and months that lost one; the report adds up a few rows per driver and sixteen years."""
    _totals_by_month(warehouse, DRIVER_MONTHS, marts.driver_totals)
    totals = spans.update(warehouse, DRIVER_MONTHS, DRIVER_SPANS, marts.add_driver_totals)
    return warehouse.replace("dm_drivers_efficiency", marts.drivers_report(totals, warehouse.read("drivers")))


def build_customers_mart(warehouse: Warehouse) -> DataFrame:
    _totals_by_month(warehouse, CUSTOMER_MONTHS, marts.customer_totals)
    totals = spans.update(warehouse, CUSTOMER_MONTHS, CUSTOMER_SPANS, marts.add_customer_totals)
    return warehouse.replace("dm_customer_analytics", marts.customers_report(totals, warehouse.read("customers")))


def build_sla_mart(warehouse: Warehouse) -> DataFrame:
    """Built month by month: rows of orders that are still in the files they
    were in at the last build stay, unless a dimension has changed. Orders added
    to a month come to it as further rows; a month that has lost a file is made anew.

    What the last build read is taken from the report's own pointer, so a build
    that failed or was left out is made up for by the next.
    """
    name, month = DM_ORDERS_SLA.name, DM_ORDERS_SLA.partition_by
    orders, statuses, tariffs = (warehouse.read(t) for t in ("orders", "order_statuses", "tariffs"))
    fact = set(warehouse.pointer("orders").folders)
    dims = {f"{t}/{f}" for t in ("order_statuses", "tariffs") for f in warehouse.pointer(t).folders}
    built = set(warehouse.pointer(name).built_from)
    sources = sorted(fact | dims)
    if dims <= built:
        if built == fact | dims:
            return warehouse.read(name)
        anew, folders = _changed(fact, built - dims)
        rows = marts.orders_sla(warehouse.read("orders", folders=folders), statuses, tariffs, month)
        return warehouse.replace_partitions(name, rows, anew, built_from=sources, add_others=True)
    return warehouse.replace(name, marts.orders_sla(orders, statuses, tariffs, month), built_from=sources)


def build_marts(warehouse: Warehouse) -> None:
    jobs = (build_drivers_mart, build_customers_mart, build_sla_mart)
    with warehouse.together():
        together([lambda job=job: job(warehouse) for job in jobs])


# -- runs --------------------------------------------------------------------


def run_full(spark: SparkSession, raw_dir: str, root: str, on_violation: str = "fail") -> Warehouse:
    """Everything from the raw files: dimensions, fact, marts.

    Tables are built beside the present ones and shown at the end; a run that
    fails leaves the warehouse as it was.
    """
    require_utc(spark)
    warehouse = Warehouse(spark, f"{root}/gold")
    staging = f"{root}/staging/{uuid.uuid4().hex}"
    layers = Layers(spark, staging)

    def to_silver(entity: str) -> DataFrame:
        bronze = _land(spark, entity, f"{raw_dir}/{entity}.csv", lambda rows: layers.save(rows, "bronze", entity))
        return layers.save(_clean(entity, bronze, staging), "silver", entity)

    def dimension(raw: RawFile) -> None:
        load_dimension(warehouse, raw.table, to_silver(raw.entity), staging, on_violation)

    with warehouse.together():
        for name in TABLES:
            warehouse.create(name)
        together(
            [
                lambda: to_silver("orders"),
                *[lambda raw=raw: dimension(raw) for raw in RAW_FILES.values() if raw.entity != "orders"],
            ]
        )
        load_orders(warehouse, layers.load("silver", "orders"), staging, on_violation)
        files.remove(spark, staging)
        build_marts(warehouse)
    return warehouse


def run_daily(
    spark: SparkSession, day: str | date, raw_dir: str, root: str, on_violation: str = "fail"
) -> Warehouse:
    """One day's order file into the warehouse, then the reports.

    ``day`` is a date, or its text as in the file name (``2026_08_11``).
    Running a day again gives the same warehouse. Dimensions are not touched.
    """
    day = day if isinstance(day, str) else day.strftime(DAY_FORMAT)
    require_utc(spark)
    warehouse = Warehouse(spark, f"{root}/gold")
    layers = Layers(spark, root)
    staging = f"{root}/staging/{uuid.uuid4().hex}"
    path = f"{raw_dir}/orders_{day}.csv"
    bronze = _land(spark, "orders", path, lambda rows: layers.save_day(rows, "bronze", "orders", day))
    silver = layers.save_day(_clean("orders", bronze, staging), "silver", "orders", day)
    with warehouse.together():
        load_orders(warehouse, silver, staging, on_violation, day)
        files.remove(spark, staging)
        build_marts(warehouse)
    return warehouse
