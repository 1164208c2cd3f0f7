"""One query per operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.contracts import (
    CUSTOMERS,
    DISTANCE,
    DRIVERS,
    LOCATIONS,
    MONEY,
    ORDER_STATUSES,
    ORDER_UPDATE_COLUMNS,
    ORDERS,
    RAW_FILES,
    TARIFFS,
    ForeignKey,
    Table,
)
from fleetmart.functions import text
from fleetmart.operators import deletes, quality
from fleetmart.operators.dedup import keep_first
from fleetmart.operators.fingerprint import same_rows
from fleetmart.operators.keys import assign_keys, resolve_order_keys
from fleetmart.operators.lookup import LIMIT_SETTING
from fleetmart.operators.merge import add_defaults, insert_if_absent, upsert
from fleetmart.plans import changes, generate, marts, pipelines
from fleetmart.plans.cleaners import CLEANERS, clean_orders
from fleetmart.plans.export import export_all, export_dimension, export_orders
from fleetmart.session import materialize, scratch_path, together
from fleetmart.sources import key_index
from fleetmart.sources.csv_files import POSITION, query, read_csv, write_csv
from fleetmart.sources.layers import Layers
from fleetmart.sources.warehouse import Warehouse, init_warehouse
from fleetmart.workload.views import STAMP, Views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RECENT = "2001-01-01"
FIRST_LOAD_END, DAILY_START = "1999-01-01", "1998-01-01"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double and times without zone, for comparison across engines."""

    def simple(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        return F.col(f.name)

    return df.select(*[simple(f) for f in df.schema])


def register(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(Views(spark, folder)))

    QUERIES[build.__name__] = run
    return build


# -- marts -------------------------------------------------------------------


@register
def driver_efficiency(v: Views) -> DataFrame:
    return marts.drivers_efficiency(v.full_rides, v.drivers)


@register
def customer_analytics(v: Views) -> DataFrame:
    return marts.customer_analytics(v.full_rides, v.customers)


@register
def customer_analytics_recent(v: Views) -> DataFrame:
    """Many customers have no ride since the date; they stay with zeros."""
    recent = v.full_rides.where(F.col("created_at") >= F.lit(RECENT).cast("timestamp_ntz"))
    return marts.customer_analytics(recent, v.customers)


@register
def orders_sla(v: Views) -> DataFrame:
    """Status ``p`` is missing from the dimension, so its orders drop out."""
    return marts.orders_sla(v.full_rides, v.statuses.where("name <> 'p'"), v.tariffs)


@register
def replace_mart(v: Views) -> DataFrame:
    """A mart written twice; readers see the second content only."""
    warehouse = init_warehouse(v.spark, scratch_path(v.spark, "replace_mart"))
    warehouse.replace("dm_drivers_efficiency", marts.drivers_efficiency(v.full_rides, v.drivers))
    done = v.full_rides.where("delivered_at IS NOT NULL")
    return warehouse.replace("dm_drivers_efficiency", marts.drivers_efficiency(done, v.drivers))


@register
def sql_query(v: Views) -> DataFrame:
    return query(
        v.spark,
        "SELECT driver_id, count(*) AS rides FROM {rides} WHERE price > 300000 GROUP BY driver_id",
        rides=v.rides,
    )


# -- cleaning ----------------------------------------------------------------

LINE_ORDER = (
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


@register
def dedup_keep_first(v: Views) -> DataFrame:
    return keep_first(v.table("lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)


def _by_priority(*choices: Column) -> Column:
    level = F.substring("o_orderpriority", 1, 1)
    out = F.when(level == "1", choices[0])
    for n, choice in enumerate(choices[1:], 2):
        out = out.when(level == str(n), choice)
    return out


@register
def coerce_numeric(v: Views) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(12,3)").cast("string")
    raw = _by_priority(
        F.concat(F.lit(" \t"), price, F.lit(" ")),
        F.concat(price, F.lit("d")),
        F.lit("nan"),
        F.concat(F.lit("-"), price, F.lit("5")),
        F.concat(price, F.lit("e1")),
    )
    return v.table("orders").select("o_orderkey", text.to_decimal(raw, T.DecimalType(12, 2)).alias("price"))


@register
def coerce_timestamp(v: Views) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    placed = _by_priority(
        F.concat(day, F.lit(" 10:20:30.250")),
        F.concat(day, F.lit("T10:20:30Z")),
        day,
        F.concat(day, F.lit(" 10:20:30+03:00")),
        F.substring(day, 1, 4),
    )
    other = _by_priority(
        F.lit("10:00"),
        F.concat(F.substring(day, 1, 4), F.lit("-02-30")),
        F.concat(F.lit(" "), day, F.lit(" 00:00:00 ")),
        F.concat(F.substring(day, 9, 2), F.lit("."), F.substring(day, 6, 2), F.lit("."), F.substring(day, 1, 4)),
        F.lit(None).cast("string"),
    )
    return v.table("orders").select(
        "o_orderkey", text.to_time(placed).alias("placed"), text.to_time(other).alias("other")
    )


@register
def strip_case(v: Views) -> DataFrame:
    def pad(c: str) -> Column:
        return F.concat(F.lit("\t  "), F.col(c), F.lit(" \n"))

    return v.table("documents").select(
        "doc_id",
        text.strip_upper(pad("source")).alias("source"),
        text.strip_lower(pad("lang")).alias("lang"),
        text.strip(pad("text")).alias("body"),
    )


@register
def na_tokens(v: Views) -> DataFrame:
    raw = _by_priority(
        F.lit("N/A"), F.lit(" NA "), F.concat(F.lit(""), F.col("o_orderstatus")), F.lit("None"), F.lit("")
    )
    return v.table("orders").select("o_orderkey", text.strip(text.na_to_null(raw)).alias("value"))


@register
def clean_order_lines(v: Views) -> DataFrame:
    """Every line is a delivery of its order; some are padded, some are bad."""
    line = F.col("l_linenumber")
    key = F.concat(F.lit("order_ext_"), F.col("l_orderkey").cast("string"))
    raw = v.table("lineitem").select(
        F.when(line == 7, F.lit(None)).when(line == 6, F.concat(F.lit(" "), key)).otherwise(key).alias("external_order_id"),
        F.concat(F.lit(" "), F.col("l_partkey").cast("string")).alias("customer_external_id"),
        F.col("l_suppkey").cast("string").alias("driver_external_id"),
        F.col("l_linestatus").alias("pickup_address"),
        F.col("l_returnflag").alias("dropoff_address"),
        F.lit("\tstandard").alias("tariff_name"),
        F.when(line == 1, "x").otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string")).alias("price"),
        F.when(line == 2, "far").otherwise(F.col("l_quantity").cast("decimal(7,3)").cast("string")).alias("distance_km"),
        F.when(line == 3, "10:00").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("created_at"),
        F.when(line == 4, "soon").alias("delivered_at"),
        F.when(line == 5, "5.0").otherwise("6").alias("current_status"),
        *[F.col(c).alias(f"_{c}") for c in ("l_linenumber", *LINE_ORDER)],
    )
    position = tuple(f"_{c}" for c in (*LINE_ORDER, "l_linenumber"))
    cleaned = clean_orders(raw, position)
    return cleaned.withColumnRenamed(quality.VIOLATIONS, "violations").drop(*position)


def _padded(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.concat(F.lit(" "), F.col(c).cast("string"), F.lit("\t")) for c in columns})


def _as_text(df: DataFrame, entity: str) -> DataFrame:
    """A dimension as its raw file has it: natural columns, all text."""
    rows = export_dimension(df, entity)
    times = [f.name for f in rows.schema if isinstance(f.dataType, T.TimestampType)]
    rows = rows.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in times})
    return rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])


def _cleaned(v: Views, entity: str, **changed: Column) -> DataFrame:
    raw = _as_text(v.dims[RAW_FILES[entity].table.name], entity)
    raw = raw.withColumns({c: value.cast("string") for c, value in changed.items()})
    return CLEANERS[entity](_padded(raw, raw.columns)).drop(quality.VIOLATIONS)


def _number_in(c: str) -> Column:
    return F.regexp_extract(c, r"\d+$", 0).cast("int")


@register
def clean_customers(v: Views) -> DataFrame:
    """Some times are none."""
    return _cleaned(v, "customers", created_at=F.when(_number_in("external_id") % 3 == 0, "soon").otherwise(F.col("created_at")))


@register
def clean_drivers(v: Views) -> DataFrame:
    return _cleaned(v, "drivers", vehicle_number=F.lower("vehicle_number"))


@register
def clean_locations(v: Views) -> DataFrame:
    """Some numbers are none."""
    bad = v.locations.where("location_id % 3 = 0").select(F.col("address").alias("_bad"))
    raw = _as_text(v.locations, "locations").join(bad, F.col("address") == F.col("_bad"), "left")
    raw = raw.withColumn("lat", F.when(F.col("_bad").isNull(), F.col("lat")).otherwise("north")).drop("_bad")
    return CLEANERS["locations"](_padded(raw, raw.columns)).drop(quality.VIOLATIONS)


@register
def clean_tariffs(v: Views) -> DataFrame:
    """A price and a time are none."""
    price = F.when(F.col("base_price") == "200.00", "2OO").otherwise(F.col("base_price"))
    return _cleaned(v, "tariffs", base_price=price, created_at=F.when(F.col("base_price") == "300.00", "n. d.").otherwise(F.col("created_at")))


@register
def clean_statuses(v: Views) -> DataFrame:
    return _cleaned(v, "statuses", name=F.upper("name"))


# -- quality -----------------------------------------------------------------


@register
def require_not_null(v: Views) -> DataFrame:
    return quality.require_not_null(v.rides, ["driver_id", "delivered_at"]).select("order_id", "driver_id", "delivered_at")


@register
def not_null_violations(v: Views) -> DataFrame:
    """Orders without lines have no distance."""
    return quality.not_null_violations(v.rides, ORDERS, ["order_id"])


@register
def check_violations(v: Views) -> DataFrame:
    shifted = v.rides.withColumns(
        {"price": F.col("price") - 200_000, "distance_km": F.col("distance_km") - 25}
    )
    return quality.check_violations(shifted, ORDERS, ["order_id"])


@register
def unique_violations(v: Views) -> DataFrame:
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    return quality.unique_violations(v.table("lineitem").select(key.alias("external_order_id")), "external_order_id")


@register
def fk_orphans(v: Views) -> DataFrame:
    """References to customers in debt, who are left out of the parent table;
    urgent orders have no customer, which is no orphan."""
    solvent = v.table("customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("customer_id"))
    fk = ForeignKey("customer_id", "customers", "customer_id")
    customer = F.when(F.col("tariff_id") != 1, F.col("customer_id")).alias("customer_id")
    return quality.fk_orphans(v.rides.select("order_id", customer), solvent, fk)


@register
def decimal_rounding(v: Views) -> DataFrame:
    """Excess decimals are rounded half up on the way into a money column."""
    rate = F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_discount").cast("decimal(4,2)")
    return v.table("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum(rate.cast(MONEY)).alias("discount"))


# -- keys and merge ----------------------------------------------------------


@register
def resolve_keys(v: Views) -> DataFrame:
    """Drivers in debt are unknown here: the key stays NULL, the row stays."""
    raw = v.deliveries.select(
        "external_order_id",
        "customer_external_id",
        "driver_external_id",
        "pickup_address",
        "dropoff_address",
        "tariff_name",
    )
    solvent = v.table("supplier").where("s_acctbal >= 0").select(F.col("s_suppkey").alias("driver_id"))
    known = v.drivers.join(solvent, "driver_id", "left_semi")
    return resolve_order_keys(raw, {**v.dims, "drivers": known})


@register
def resolve_keys_far(v: Views) -> DataFrame:
    with _nothing_is_sent(v.spark):
        return resolve_keys(v)


@register
def insert_without_times(v: Views) -> DataFrame:
    """Customers signed up by their orders without a time get that of the insert."""
    batch = v.table("orders").select(
        F.concat(F.lit("cust_ext_"), F.col("o_custkey").cast("string")).alias("external_id"),
        F.lit("by order").alias("name"),
        F.lit(None).cast("string").alias("phone"),
        F.lit(None).cast("string").alias("email"),
        "o_orderkey",
    )
    added = insert_if_absent(v.customers.limit(0), add_defaults(batch, CUSTOMERS), CUSTOMERS, ["o_orderkey"])
    now = F.expr("created_at BETWEEN current_timestamp() - INTERVAL 1 HOUR AND current_timestamp() + INTERVAL 1 HOUR")
    return added.select("customer_id", "external_id", now.alias("recent"))


@register
def unknown_columns(v: Views) -> DataFrame:
    """A customer file with a column too many: refused, or loaded with the column's values put aside."""
    warehouse = init_warehouse(v.spark, scratch_path(v.spark, "unknown"))
    rows = v.customers.withColumns({"_file": F.lit("f"), "_block": F.lit(0), "_row": F.col("customer_id"), "tip": F.col("customer_id") % 3})
    rows = rows.drop("customer_id").withColumn(quality.VIOLATIONS, F.lit(""))
    refused = False
    try:
        pipelines.load_dimension(warehouse, CUSTOMERS, rows, f"{warehouse.root}/staging")
    except quality.QualityError:
        refused = warehouse.read("customers").isEmpty()
    pipelines.load_dimension(warehouse, CUSTOMERS, rows, f"{warehouse.root}/staging", "quarantine")
    aside = v.spark.read.parquet(f"{warehouse.root}/unknown/customers").select("external_id", "tip")
    stored = warehouse.read("customers").select("customer_id", "external_id")
    return stored.join(aside, "external_id").withColumn("refused", F.lit(refused))


@register
def round_trip(v: Views) -> DataFrame:
    """A generated warehouse of the tables' sizes, exported and loaded again: the same rows, by fingerprints."""
    sizes = {n: v.table(t).count() for n, t in (("orders", "orders"), ("customers", "customer"), ("drivers", "supplier"), ("locations", "part"))}
    folder = scratch_path(v.spark, "round_trip")
    made = generate.generate_warehouse(v.spark, f"{folder}/made/gold", **sizes)
    export_all(made, f"{folder}/raw")
    back = pipelines.run_full(v.spark, f"{folder}/raw", f"{folder}/back")

    def compared(name: str) -> tuple[str, int, bool]:
        one, other = (w.read(name).drop(*(["order_id"] if name == "orders" else [])) for w in (made, back))
        if name == "order_statuses":
            one = one.withColumn("name", F.lower("name"))
        return name, other.count(), same_rows(one, other)

    seen = together([lambda name=name: compared(name) for name in (*sizes, "tariffs", "order_statuses")])
    return v.spark.createDataFrame(seen, "name string, n long, same boolean")


@register
def insert_customers(v: Views) -> DataFrame:
    """Customers in credit are stored. Every order signs its customer up again:
    stored rows win, then the first order."""
    credit = v.table("customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("customer_id"))
    stored = v.customers.join(credit, "customer_id", "left_semi")
    batch = v.table("orders").select(
        F.concat(F.lit("cust_ext_"), F.col("o_custkey").cast("string")).alias("external_id"),
        F.concat(F.lit("by order "), F.col("o_orderkey").cast("string")).alias("name"),
        F.lit(None).cast("string").alias("phone"),
        F.lit(None).cast("string").alias("email"),
        F.lit(STAMP).cast("timestamp").alias("created_at"),
        "o_orderkey",
    )
    return insert_if_absent(stored, batch, CUSTOMERS, ["o_orderkey"])


@register
def insert_drivers(v: Views) -> DataFrame:
    credit = v.table("supplier").where("s_acctbal >= 0").select(F.col("s_suppkey").alias("driver_id"))
    stored = v.drivers.join(credit, "driver_id", "left_semi")
    batch = v.lines.select(
        F.concat(F.lit("drv_ext_"), F.col("driver_id").cast("string")).alias("external_id"),
        F.concat(F.lit("by order "), F.col("l_orderkey").cast("string")).alias("name"),
        F.lit(None).cast("string").alias("phone"),
        F.concat(F.lit("NEW "), F.col("driver_id").cast("string")).alias("vehicle_number"),
        F.lit(STAMP).cast("timestamp").alias("created_at"),
        "l_orderkey",
    )
    return insert_if_absent(stored, batch, DRIVERS, ["l_orderkey"])


@register
def insert_locations(v: Views) -> DataFrame:
    """Addresses used by orders, some of them new."""
    stored = v.locations.where("address < 'NATION_2'")
    batch = v.deliveries.select(
        F.col("pickup_address").alias("address"),
        F.lit(None).cast(LOCATIONS.schema["lat"].dataType).alias("lat"),
        F.lit(None).cast(LOCATIONS.schema["lon"].dataType).alias("lon"),
        "o_orderkey",
    )
    return insert_if_absent(stored, batch, LOCATIONS, ["o_orderkey"])


@register
def insert_tariffs(v: Views) -> DataFrame:
    stored = v.tariffs.where("name IN ('HIGH', 'LOW')")
    batch = v.deliveries.select(F.col("tariff_name").alias("name"), F.lit(STAMP).cast("timestamp").alias("created_at"), "o_orderkey")
    return insert_if_absent(stored, add_defaults(batch, TARIFFS), TARIFFS, ["o_orderkey"])


@register
def insert_statuses(v: Views) -> DataFrame:
    stored = v.statuses.where("name = 'f'")
    batch = v.table("orders").select(F.lower("o_orderstatus").alias("name"), "o_orderkey")
    return insert_if_absent(stored, batch, ORDER_STATUSES, ["o_orderkey"])


@register
def number_rows(v: Views) -> DataFrame:
    rows = v.table("orders").select("o_orderkey", "o_orderdate")
    return assign_keys(rows, "order_id", ["o_orderdate", "o_orderkey"], base=1_000)


def _stored_rides(v: Views) -> DataFrame:
    return v.full_rides.where(F.col("created_at") < F.lit(FIRST_LOAD_END).cast("timestamp_ntz"))


def _redelivered(v: Views) -> DataFrame:
    """Orders since a date, with every column but the key changed."""
    return v.full_rides.where(F.col("created_at") >= F.lit(DAILY_START).cast("timestamp_ntz")).select(
        F.col("order_id").alias("_row"),
        "external_order_id",
        (F.col("customer_id") + 1).alias("customer_id"),
        F.lit(None).cast("bigint").alias("driver_id"),
        (F.col("pickup_location_id") + 1).alias("pickup_location_id"),
        (F.col("dropoff_location_id") + 1).alias("dropoff_location_id"),
        (F.col("tariff_id") + 1).alias("tariff_id"),
        (F.col("price") + 1).cast(MONEY).alias("price"),
        (F.col("distance_km") + 1).cast("decimal(7,3)").alias("distance_km"),
        (F.col("created_at") + F.expr("INTERVAL 1 HOUR")).alias("created_at"),
        (F.col("created_at") + F.expr("INTERVAL 2 HOURS")).alias("delivered_at"),
        (F.col("current_status") + 1).alias("current_status"),
    )


@register
def upsert_orders(v: Views) -> DataFrame:
    return upsert(_stored_rides(v), _redelivered(v), ORDERS, ORDER_UPDATE_COLUMNS, ["_row"])


@register
def upsert_missing_columns(v: Views) -> DataFrame:
    """Absent optional columns bring their defaults, also into stored orders."""
    batch = _redelivered(v).drop("delivered_at", "current_status")
    return upsert(_stored_rides(v), batch, ORDERS, ORDER_UPDATE_COLUMNS, ["_row"])


# -- deletes -----------------------------------------------------------------


def _in_debt(v: Views, table: str, key: str, balance: str, name: str) -> DataFrame:
    return v.table(table).where(F.col(balance) < 0).select(F.col(key).alias(name))


@register
def delete_restrict(v: Views) -> DataFrame:
    """Customers left when those in debt that have no order are deleted."""
    doomed = _in_debt(v, "customer", "c_custkey", "c_acctbal", "customer_id")
    free = doomed.join(v.rides.select("customer_id").distinct(), "customer_id", "left_anti")
    kept = deletes.delete_restrict(v.customers, free, v.rides, "customer_id", "customer_id")
    return kept.select("customer_id")


@register
def blocked_parents(v: Views) -> DataFrame:
    """Customers in debt that may not be deleted: they have late orders."""
    doomed = _in_debt(v, "customer", "c_custkey", "c_acctbal", "customer_id")
    late = v.rides.where(F.col("created_at") >= F.lit(RECENT).cast("timestamp_ntz"))
    return deletes.blocked_parents(doomed, late, "customer_id", "customer_id")


@register
def delete_set_null(v: Views) -> DataFrame:
    doomed = _in_debt(v, "supplier", "s_suppkey", "s_acctbal", "driver_id")
    return deletes.delete_set_null(v.rides, doomed, "driver_id", "driver_id").select("order_id", "driver_id", "price")


@register
def delete_cascade(v: Views) -> DataFrame:
    doomed = v.rides.where("delivered_at IS NULL").select("order_id")
    events = _events(v)
    return deletes.delete_cascade(events, doomed, "order_id", "order_id").drop("_round")


#: Warehouses that several queries begin from, by session and folder: the root, and the version to begin from.
_LOADED: dict[tuple[str, str, str], tuple[str, int]] = {}


def _shared(v: Views, what: str, load: Callable[[Views], Warehouse]) -> Warehouse:
    """A warehouse loaded once, as it was after that load."""
    key = (v.spark.sparkContext.applicationId, v.folder, what)
    if key not in _LOADED:
        warehouse = load(v)
        _LOADED[key] = warehouse.root, warehouse.version()
        return warehouse
    root, version = _LOADED[key]
    warehouse = Warehouse(v.spark, root)
    if warehouse.version() != version:
        warehouse.restore(version)
    return warehouse


def _stored(v: Views) -> Warehouse:
    """Rides, their customers, drivers and events as stored tables."""
    return _shared(v, "stored", _store)


def _store(v: Views) -> Warehouse:
    warehouse = init_warehouse(v.spark, scratch_path(v.spark, "stored"))
    known = F.when(F.col("current_status") == F.ascii(F.lit("f")), 2).otherwise(1)
    with warehouse.together():
        for name in ("customers", "drivers"):
            warehouse.replace(name, v.dims[name])
        warehouse.replace("order_statuses", v.spark.createDataFrame([(1, "a"), (2, "b")], ORDER_STATUSES.schema))
        warehouse.replace("orders", generate.with_month(v.full_rides.withColumn("current_status", known)))
    events = warehouse.read("orders").select(
        "order_id", F.col("current_status").alias("status_id"), F.col("created_at").alias("event_time"), F.lit("placed").alias("note")
    )
    changes.append_events(warehouse, events, f"{warehouse.root}/staging")
    return warehouse


@register
def append_events(v: Views) -> DataFrame:
    return _stored(v).read("order_events")


@register
def stored_delete_orders(v: Views) -> DataFrame:
    """Recent orders deleted, and their events with them."""
    warehouse = _stored(v)
    recent = warehouse.read("orders").where(F.col("created_at") >= F.lit(RECENT).cast("timestamp_ntz"))
    changes.delete_rows(warehouse, "orders", recent)
    left = warehouse.read("orders").select("order_id", F.lit("order").alias("what"))
    return left.unionByName(warehouse.read("order_events").select("order_id", F.lit("event").alias("what")))


@register
def stored_delete_drivers(v: Views) -> DataFrame:
    """Drivers in debt deleted; their orders stay without a driver."""
    warehouse = _stored(v)
    changes.delete_rows(warehouse, "drivers", _in_debt(v, "supplier", "s_suppkey", "s_acctbal", "driver_id"))
    return warehouse.read("orders").select("order_id", "driver_id")


@register
def stored_delete_customers(v: Views) -> DataFrame:
    """Customers without orders can be deleted; one with orders can't, and then nothing is."""
    warehouse = _stored(v)
    idle = v.customers.join(v.rides.select("customer_id").distinct(), "customer_id", "left_anti").select("customer_id")
    changes.delete_rows(warehouse, "customers", idle)
    try:
        changes.delete_rows(warehouse, "customers", v.rides.select("customer_id"))
    except quality.QualityError:
        return warehouse.read("customers").select("customer_id")
    raise AssertionError("customers with orders were deleted")


class _Stopped(RuntimeError):
    pass


class _StopsBetweenTables(Warehouse):
    """Ends after the files of so many tables are written."""

    writes = 0

    def _write(self, table: Table, df: DataFrame) -> list[str]:
        if not self.writes:
            raise _Stopped
        self.writes -= 1
        return super()._write(table, df)


@register
def stopped_changes(v: Views) -> DataFrame:
    """A delete and an exchange of two tables, each stopped between two tables: readers see neither."""
    stored = _stored(v)
    writer = _StopsBetweenTables(v.spark, stored.root)
    stopped = 0
    try:
        writer.writes = 1
        changes.delete_rows(writer, "orders", writer.read("orders").where("order_id % 2 = 0"))
    except _Stopped:
        stopped += 1
    try:
        writer.writes = 1
        with writer.together():
            writer.replace("order_events", writer.read("order_events").where("order_id % 3 = 0"))
            writer.replace("customers", writer.read("customers").where("customer_id % 3 = 0"))
    except _Stopped:
        stopped += 1
    reader = Warehouse(v.spark, stored.root)
    seen = [reader.read(t).select(F.col(key).alias("id"), F.lit(t).alias("what")) for t, key in (("orders", "order_id"), ("order_events", "order_id"), ("customers", "customer_id"))]
    return seen[0].unionByName(seen[1]).unionByName(seen[2]).withColumn("stopped", F.lit(stopped))


@register
def append_events_once(v: Views) -> DataFrame:
    """Two days of events, the first delivered three times."""
    warehouse = _stored(v)
    late = F.col("event_time") >= F.lit(FIRST_LOAD_END).cast("timestamp_ntz")
    rows = warehouse.read("order_events").drop("event_id").withColumn("note", F.lit("seen"))
    for day, part in (("early", ~late), ("early", ~late), ("late", late), ("early", ~late)):
        changes.append_events(Warehouse(v.spark, warehouse.root), rows.where(part), f"{warehouse.root}/staging", run=day)
    return warehouse.read("order_events")


@register
def read_through_clean_up(v: Views) -> DataFrame:
    """A reader that began before half of the orders were deleted, and everything not in use with them."""
    warehouse = _store(v)
    with Warehouse(v.spark, warehouse.root).reading() as view:
        changes.delete_rows(warehouse, "orders", warehouse.read("orders").where("order_id % 2 = 0"))
        warehouse.clean_up(0.0)
        then = view.read("orders").select("order_id", "price", F.lit("then").alias("seen"))
        return then.unionByName(warehouse.read("orders").select("order_id", "price", F.lit("now").alias("seen")))


@contextmanager
def _nothing_is_sent(spark: SparkSession) -> Iterator[None]:
    """As with tables of any size: no lookup may broadcast."""
    spark.conf.set(LIMIT_SETTING, "0")
    try:
        yield
    finally:
        spark.conf.unset(LIMIT_SETTING)


@register
def stored_delete_orders_far(v: Views) -> DataFrame:
    with _nothing_is_sent(v.spark):
        return stored_delete_orders(v)


@register
def stored_delete_drivers_far(v: Views) -> DataFrame:
    with _nothing_is_sent(v.spark):
        return stored_delete_drivers(v)


@register
def stored_delete_customers_far(v: Views) -> DataFrame:
    with _nothing_is_sent(v.spark):
        return stored_delete_customers(v)


# -- events, export ----------------------------------------------------------


def _events(v: Views) -> DataFrame:
    """Done and cancelled stand for delivered and open orders."""
    code = F.when(F.col("current_status") == F.ascii(F.lit("f")), 5).when(F.col("current_status") == F.ascii(F.lit("o")), 6)
    return generate.order_events(v.rides.withColumn("current_status", F.coalesce(code, F.lit(3))))


@register
def order_events(v: Views) -> DataFrame:
    return assign_keys(_events(v), "event_id", ["_round", "order_id"]).drop("_round")


@register
def export_order_file(v: Views) -> DataFrame:
    return export_orders(v.full_rides, v.dims)


@register
def export_customers(v: Views) -> DataFrame:
    return export_dimension(v.customers, "customers")


@register
def export_drivers(v: Views) -> DataFrame:
    return export_dimension(v.drivers, "drivers")


@register
def export_locations(v: Views) -> DataFrame:
    return export_dimension(v.locations, "locations")


@register
def export_tariffs(v: Views) -> DataFrame:
    return export_dimension(v.tariffs, "tariffs")


@register
def export_statuses(v: Views) -> DataFrame:
    return export_dimension(v.statuses, "statuses")


# -- generator, over row numbers taken from the tables -----------------------


def _series(v: Views, table: str, key: str, stride: int = 1) -> DataFrame:
    return v.table(table).select((F.col(key).cast("bigint") * stride + 1).alias("i"))


@register
def gen_locations(v: Views) -> DataFrame:
    return generate.generate_locations(_series(v, "part", "p_partkey"))


@register
def gen_customers(v: Views) -> DataFrame:
    return generate.generate_customers(_series(v, "customer", "c_custkey"))


@register
def gen_drivers(v: Views) -> DataFrame:
    return generate.generate_drivers(_series(v, "customer", "c_custkey"))


@register
def gen_orders(v: Views) -> DataFrame:
    return generate.generate_orders(_series(v, "orders", "o_orderkey"))


# Numbers beyond seven digits and the first series of plates, and beyond 2**32.
FAR_NUMBERS, FAR_ORDERS = 70_001, 3_000_017


@register
def gen_customers_far(v: Views) -> DataFrame:
    return generate.generate_customers(_series(v, "customer", "c_custkey", FAR_NUMBERS))


@register
def gen_drivers_far(v: Views) -> DataFrame:
    return generate.generate_drivers(_series(v, "customer", "c_custkey", FAR_NUMBERS))


@register
def gen_orders_far(v: Views) -> DataFrame:
    return generate.generate_orders(_series(v, "orders", "o_orderkey", FAR_ORDERS))


@register
def gen_orders_sla(v: Views) -> DataFrame:
    orders = generate.generate_orders(_series(v, "orders", "o_orderkey"))
    sla = marts.orders_sla(orders, generate.generate_statuses(v.spark), generate.generate_tariffs(v.spark))
    return sla.groupBy("tariff_name", "final_status").agg(
        F.count("order_id").alias("orders"),
        F.sum("total_duration_minutes").alias("minutes"),
        F.sum("price").alias("revenue"),
    )


# -- files, layers, warehouse ------------------------------------------------


def _order_file(v: Views) -> DataFrame:
    return v.deliveries.select(*RAW_FILES["orders"].required, "delivered_at", F.lit("1").alias("current_status"))


def _through_csv(v: Views, rows: DataFrame, entity: str) -> DataFrame:
    path = write_csv(rows, scratch_path(v.spark, f"{entity}_csv"))
    return pipelines.extract(v.spark, entity, path)


@register
def ingest_orders(v: Views) -> DataFrame:
    """Orders through a CSV file with quotes, commas and missing-value tokens."""
    rows = _order_file(v).withColumns(
        {
            "pickup_address": F.concat(F.lit('"A, B" '), F.col("pickup_address")),
            "driver_external_id": F.coalesce("driver_external_id", F.lit("NULL")),
            "tariff_name": F.when(F.col("tariff_name") == "LOW", "n/a").otherwise(F.col("tariff_name")),
        }
    )
    raw = _through_csv(v, rows, "orders")
    return raw.drop(*POSITION, "_overflow")


def _ingested(v: Views, entity: str) -> DataFrame:
    raw = _through_csv(v, _as_text(v.dims[RAW_FILES[entity].table.name], entity), entity)
    return CLEANERS[entity](raw).drop(*POSITION, quality.VIOLATIONS)


@register
def ingest_customers(v: Views) -> DataFrame:
    return _ingested(v, "customers")


@register
def ingest_drivers(v: Views) -> DataFrame:
    return _ingested(v, "drivers")


@register
def ingest_locations(v: Views) -> DataFrame:
    return _ingested(v, "locations")


@register
def ingest_tariffs(v: Views) -> DataFrame:
    return _ingested(v, "tariffs")


@register
def ingest_statuses(v: Views) -> DataFrame:
    return _ingested(v, "statuses")


@register
def csv_texts(v: Views) -> DataFrame:
    """Whole documents, line breaks and quotes included, through CSV."""
    path = write_csv(v.table("documents").select("doc_id", "text"), scratch_path(v.spark, "texts_csv"))
    back = read_csv(v.spark, path)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "_overflow")


@register
def input_gates(v: Views) -> DataFrame:
    """What becomes of a delivered file: its number of rows, or why it is refused."""
    folder = scratch_path(v.spark, "gates")
    rows = _order_file(v)
    write_csv(rows, f"{folder}/complete")
    write_csv(rows.limit(0), f"{folder}/empty")
    write_csv(rows.drop("price"), f"{folder}/incomplete")
    write_csv(rows.withColumnRenamed("external_order_id", "\ufeffexternal_order_id"), f"{folder}/bom")
    write_csv(rows.withColumn("tip", F.lit("1")), f"{folder}/unknown")

    def outcome(case: str) -> str:
        try:
            found = pipelines.extract(v.spark, "orders", f"{folder}/{case}")
        except (FileNotFoundError, quality.QualityError) as e:
            return type(e).__name__
        unknown = sorted(set(found.columns) - {*RAW_FILES["orders"].required, "delivered_at", "current_status", "_overflow", *POSITION})
        return " ".join([str(found.count()), *unknown])

    cases = ("complete", "missing", "empty", "incomplete", "bom", "unknown")
    return v.spark.createDataFrame([(c, outcome(c)) for c in cases], "case string, outcome string")


@register
def csv_malformed(v: Views) -> DataFrame:
    """Whole documents on one line each, some with a field too few or too many."""
    path = scratch_path(v.spark, "malformed_csv")
    line = F.translate("text", "\n\r", "  ")
    quoted = F.concat(F.lit('"'), F.replace(line, F.lit('"'), F.lit('""')), F.lit('"'))
    key, size = F.col("doc_id").cast("string"), F.length(line).cast("string")
    record = (
        F.when(F.col("doc_id") % 3 == 1, key)
        .when(F.col("doc_id") % 3 == 2, F.concat_ws(",", key, quoted, size, F.lit("more")))
        .otherwise(F.concat_ws(",", key, quoted, size))
    )
    # One column of ready records, with a separator and a quote that no text has.
    raw = {"header": True, "sep": "\x01", "quote": "\x02", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    v.table("documents").select(record.alias("doc_id,text,chars")).write.options(**raw).csv(path)
    back = read_csv(v.spark, path)
    return back.select(*[F.col(c).cast("bigint").alias(c) for c in ("doc_id", "chars")], "text", "_overflow")


@register
def daily_columns(v: Views) -> DataFrame:
    """Days whose files differ in columns."""
    layers = Layers(v.spark, scratch_path(v.spark, "columns"))
    rides = v.rides.select("order_id", F.col("created_at").alias("placed_at"))
    late = F.col("placed_at") >= F.lit(FIRST_LOAD_END).cast("timestamp_ntz")
    layers.save_day(rides.where(~late).drop("placed_at"), "bronze", "orders", "1998_12_31")
    layers.save_day(rides.where(late), "bronze", "orders", "1999_01_01")
    days = [layers.load_day("bronze", "orders", day) for day in ("1998_12_31", "1999_01_01")]
    return days[0].unionByName(days[1])


@register
def daily_layers(v: Views) -> DataFrame:
    """Two deliveries stored by day; the second comes again and replaces itself."""
    layers = Layers(v.spark, scratch_path(v.spark, "layers"))
    rides = v.rides.select("order_id", "price", "created_at")
    late = F.col("created_at") >= F.lit(FIRST_LOAD_END).cast("timestamp_ntz")
    layers.save_day(rides.where(~late), "bronze", "orders", "1998_12_31")
    layers.save_day(rides.where(late), "bronze", "orders", "1999_01_01")
    again = rides.where(late).withColumn("price", (F.col("price") + 1).cast(MONEY))
    layers.save_day(again, "bronze", "orders", "1999_01_01")
    return layers.load("bronze", "orders")


@register
def daily_slice(v: Views) -> DataFrame:
    """The first mart over one stored delivery; only its folder is read."""
    layers = Layers(v.spark, scratch_path(v.spark, "slice"))
    late = F.col("created_at") >= F.lit(FIRST_LOAD_END).cast("timestamp_ntz")
    layers.save_day(v.full_rides.where(~late), "silver", "orders", "1998_12_31")
    layers.save_day(v.full_rides.where(late), "silver", "orders", "1999_01_01")
    return marts.drivers_efficiency(layers.load_day("silver", "orders", "1999_01_01"), v.drivers)


@register
def restart_identity(v: Views) -> DataFrame:
    """A table filled, emptied with its identity restarted, and filled again."""
    warehouse = Warehouse(v.spark, scratch_path(v.spark, "restart"))
    for _ in range(2):
        warehouse.create("customers")
        warehouse.append("customers", insert_if_absent(warehouse.read("customers"), v.customers.drop("customer_id"), CUSTOMERS, ["external_id"]))
    return warehouse.read("customers").select("customer_id", "external_id")


def _raw_folder(v: Views, orders: DataFrame) -> str:
    folder = scratch_path(v.spark, "raw")
    files = {e: _as_text(v.dims[raw.table.name], e) for e, raw in RAW_FILES.items() if e != "orders"}
    files["orders"] = orders
    together([lambda entity=entity, rows=rows: write_csv(rows, f"{folder}/{entity}.csv") for entity, rows in files.items()])
    return folder


def _in_key_order(orders: DataFrame) -> DataFrame:
    return orders.orderBy("o_orderkey").drop("o_orderkey", "o_orderdate")


def _numeric_status(orders: DataFrame) -> DataFrame:
    """Ids of the status dimension as it is loaded: f, o, p in this order."""
    return orders.withColumn(
        "current_status",
        F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "2").otherwise("3"),
    ).drop("o_orderstatus")


def _pipeline_orders(v: Views) -> DataFrame:
    return _pipeline_texts(v.deliveries)


def _pipeline_texts(orders: DataFrame) -> DataFrame:
    return _numeric_status(
        orders.select(*RAW_FILES["orders"].required, "delivered_at", "o_orderkey", "o_orderdate", "o_orderstatus")
    )


def _sorted_orders(v: Views, which: str = "true") -> DataFrame:
    """A raw order file's rows by key; they are sorted in the tables' own types, which are smaller, and made texts then."""
    by_key = v.delivered.where(which).orderBy("o_orderkey")
    return _pipeline_texts(v.as_delivered(by_key)).drop("o_orderkey", "o_orderdate")


def _full_warehouse(v: Views) -> Warehouse:
    """All six raw files loaded, and the reports."""
    return _shared(v, "full", lambda v: pipelines.run_full(v.spark, _raw_folder(v, _sorted_orders(v)), scratch_path(v.spark, "full")))


@register
def run_full(v: Views) -> DataFrame:
    return _full_warehouse(v).read("dm_customer_analytics")


@register
def run_full_drivers(v: Views) -> DataFrame:
    return _full_warehouse(v).read("dm_drivers_efficiency")


@register
def run_full_sla(v: Views) -> DataFrame:
    return _full_warehouse(v).read("dm_orders_sla").drop("created_month")


@register
def indexed_upsert(v: Views) -> DataFrame:
    """A small day for a full warehouse: some orders again, dearer, and as many new ones.

    Of the key index only the buckets of the day's keys are read.
    """
    loaded = _full_warehouse(v)
    raw, root = scratch_path(v.spark, "small_day"), loaded.root.removesuffix("/gold")
    again = materialize(_pipeline_orders(v).where("o_orderkey % 500 = 3"), "again")
    dearer = again.withColumn("price", (F.col("price").cast(MONEY) + 1).cast(MONEY).cast("string"))
    new = again.withColumn("external_order_id", F.concat(F.lit("new_"), F.col("external_order_id")))
    write_csv(_in_key_order(dearer.unionByName(new)), f"{raw}/orders_1999_01_02.csv")
    found = key_index.find(loaded, dearer.unionByName(new))
    buckets, known = len(key_index.folders_read(found)), found.count()
    warehouse = pipelines.run_daily(v.spark, "1999_01_02", raw, root)
    orders = warehouse.read("orders").select("external_order_id", "price")
    return orders.withColumns({"buckets_read": F.lit(buckets), "keys_found": F.lit(known)})


def _half_warehouse(v: Views) -> Warehouse:
    """Half of the orders loaded."""
    half = lambda v: _raw_folder(v, _sorted_orders(v, "o_orderkey % 2 = 0"))
    return _shared(v, "half", lambda v: pipelines.run_full(v.spark, half(v), scratch_path(v.spark, "half")))


@register
def append_orders(v: Views) -> DataFrame:
    """Half of the orders loaded, then the others as new ones: stored files stay."""
    loaded, raw = _half_warehouse(v), scratch_path(v.spark, "others")
    before = loaded.pointer("orders").folders
    write_csv(_sorted_orders(v, "o_orderkey % 2 = 1"), f"{raw}/orders_1999_01_01.csv")
    warehouse = pipelines.run_daily(v.spark, "1999_01_01", raw, loaded.root.removesuffix("/gold"))
    stayed = set(before) <= set(warehouse.pointer("orders").folders)
    return warehouse.read("orders").select("order_id", "external_order_id", "price", F.lit(stayed).alias("files_stayed"))


@register
def rejects_twice(v: Views) -> DataFrame:
    """A day with unknown customers, run twice in quarantine."""
    raw = scratch_path(v.spark, "unknown_customers")
    number = F.regexp_extract("customer_external_id", r"\d+$", 0).cast("int")
    unknown = F.when(number % 2 == 1, F.col("customer_external_id")).otherwise("nobody")
    day = _sorted_orders(v).withColumn("customer_external_id", unknown)
    loaded, _ = together([lambda: _half_warehouse(v), lambda: write_csv(day, f"{raw}/orders_1999_01_02.csv")])
    for _ in range(2):
        pipelines.run_daily(v.spark, "1999_01_02", raw, loaded.root.removesuffix("/gold"), on_violation="quarantine")
    rejects = v.spark.read.parquet(f"{loaded.root}/rejects/orders")
    return rejects.select("external_order_id", F.col(quality.VIOLATIONS).alias("violations"))


MOVED_TO = "drv_ext_3"


def _daily_warehouse(v: Views) -> Warehouse:
    """A full load of the early orders, then one day with all later ones and
    some of the stored ones again, dearer, longer, and partly with another driver.
    Both files are cut from the same rows, which are put together once."""
    orders = materialize(_pipeline_orders(v), "deliveries")
    early = F.col("o_orderdate") < F.lit(FIRST_LOAD_END).cast("timestamp_ntz")
    again = F.col("o_orderdate") >= F.lit(DAILY_START).cast("timestamp_ntz")
    raw, root = _raw_folder(v, _in_key_order(orders.where(early))), scratch_path(v.spark, "daily")
    pipelines.run_full(v.spark, raw, root)
    driver = F.when(F.col("o_orderkey") % 4 == 0, MOVED_TO).otherwise(F.col("driver_external_id"))
    changed = orders.where(again).withColumns(
        {
            "price": (F.col("price").cast(MONEY) + 1).cast(MONEY).cast("string"),
            "distance_km": (F.col("distance_km").cast(DISTANCE) + 2).cast(DISTANCE).cast("string"),
            "driver_external_id": driver,
        }
    )
    write_csv(_in_key_order(changed), f"{raw}/orders_1999_01_01.csv")
    return pipelines.run_daily(v.spark, "1999_01_01", raw, root)


@register
def run_daily(v: Views) -> DataFrame:
    return _shared(v, "daily", _daily_warehouse).read("dm_orders_sla").drop("created_month")


@register
def run_daily_drivers(v: Views) -> DataFrame:
    return _shared(v, "daily", _daily_warehouse).read("dm_drivers_efficiency")


@register
def run_daily_customers(v: Views) -> DataFrame:
    return _shared(v, "daily", _daily_warehouse).read("dm_customer_analytics")
