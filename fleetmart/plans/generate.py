"""Synthetic warehouse data of any size, the same on every run.

Each generator takes a series (a DataFrame with a row number ``i``), so that
Spark makes the rows where they are needed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.contracts import DEGREES, DISTANCE, MONEY, ORDER_STATUSES, TARIFFS
from fleetmart.functions import draws
from fleetmart.operators.keys import number_rows
from fleetmart.session import require_utc, together
from fleetmart.sources import files
from fleetmart.sources.warehouse import Warehouse, init_warehouse

# Names, prices, sizes and texts of the data set.
STATUS_NAMES = ["Создан", "Водитель назначен", "Машина подъехала", "В пути", "Завершен", "Отменен"]
TARIFF_ROWS = [
    ("Эконом", "150.00", "12.00", "2026-01-01 00:00:00+00:00"),
    ("Комфорт", "250.00", "18.00", "2026-01-01 00:00:00+00:00"),
    ("Бизнес", "450.00", "30.00", "2026-01-01 00:00:00+00:00"),
    ("Минивэн", "350.00", "22.00", "2026-01-15 12:00:00+00:00"),
    ("Доставка", "100.00", "10.00", "2026-02-01 08:30:00+00:00"),
]
PLATE_LETTERS = ["А", "В", "Е", "К", "М", "Н", "О", "Р", "С", "Т", "У", "Х"]
PLATE_REGION = "66"
NOTE_CREATED = "Заказ зарегистрирован в системе"
NOTE_DONE = "Заказ успешно выполнен"
NOTE_CANCELLED = "Заказ отменен"
DONE, CANCELLED = 5, 6

LOCATIONS, CUSTOMERS, DRIVERS, ORDERS = 5_000, 10_000, 10_000, 100_000
DRIVERS_IN_USE = 2_000
DIMENSION_START, ORDER_START = "2026-01-01 00:00:00Z", "2026-02-01 00:00:00Z"
DAY_SECONDS = 86_400

# Letters and digits of a plate repeat after lcm(12**3, 1000) drivers.
PLATES = 216_000


def series(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1).withColumnRenamed("id", "i")


def _salt(seed: int, column: int) -> int:
    return seed * 64 + column


def _scaled(units: Column, kind: T.DecimalType) -> Column:
    """Integer units of the last decimal place to a decimal."""
    return (units.cast("decimal(18,0)") * F.lit(10 ** -kind.scale).cast(T.DecimalType(kind.scale + 1, kind.scale))).cast(kind)


def _from(start: str, micros: Column) -> Column:
    base = F.unix_micros(F.to_timestamp(F.lit(start)))
    return F.timestamp_micros(base + micros)


def _numbered(prefix: str, i: Column) -> Column:
    return F.concat(F.lit(prefix), i.cast("string"))


def _phone(prefix: str, i: Column) -> Column:
    digits = i.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(7), F.length(digits)), "0"))


def plate(i: Column) -> Column:
    letters = F.array(*[F.lit(x) for x in PLATE_LETTERS])

    def letter(every: int) -> Column:
        return F.element_at(letters, (F.floor(i / every) % 12 + 1).cast("int"))

    digits = F.lpad((i * 7 % 1000).cast("string"), 3, "0")
    known = F.concat(letter(1), digits, letter(12), letter(144), F.lit(PLATE_REGION))
    series = F.floor((i - 1) / PLATES).cast("bigint")
    return F.when(series > 0, F.concat(known, F.lit("-"), series.cast("string"))).otherwise(known)


def generate_statuses(spark: SparkSession) -> DataFrame:
    rows = [(n, name) for n, name in enumerate(STATUS_NAMES, 1)]
    return spark.createDataFrame(rows, ORDER_STATUSES.schema)


def generate_tariffs(spark: SparkSession) -> DataFrame:
    text = spark.createDataFrame(
        [(n, *row) for n, row in enumerate(TARIFF_ROWS, 1)],
        "tariff_id int, name string, base_price string, per_km string, created_at string",
    )
    return text.select(*[F.col(f.name).cast(f.dataType) for f in TARIFFS.schema])


def generate_locations(rows: DataFrame, seed: int = 1) -> DataFrame:
    i = F.col("i")
    return rows.select(
        i.cast("bigint").alias("location_id"),
        _numbered("ул. Генерации, д. ", i).alias("address"),
        _scaled(55_500_000 + draws.rounded(i, _salt(seed, 1), 400_000), DEGREES).alias("lat"),
        _scaled(37_300_000 + draws.rounded(i, _salt(seed, 2), 600_000), DEGREES).alias("lon"),
    )


def generate_customers(rows: DataFrame, seed: int = 1) -> DataFrame:
    i = F.col("i")
    return rows.select(
        i.cast("bigint").alias("customer_id"),
        _numbered("cust_ext_", i).alias("external_id"),
        _numbered("Клиент ", i).alias("name"),
        _phone("+7999", i).alias("phone"),
        F.concat(F.lit("user_"), i.cast("string"), F.lit("@example.com")).alias("email"),
        _from(DIMENSION_START, draws.micros(i, _salt(seed, 3), 45 * DAY_SECONDS)).alias("created_at"),
    )


def generate_drivers(rows: DataFrame, seed: int = 1) -> DataFrame:
    i = F.col("i")
    return rows.select(
        i.cast("bigint").alias("driver_id"),
        _numbered("drv_ext_", i).alias("external_id"),
        _numbered("Водитель ", i).alias("name"),
        _phone("+7911", i).alias("phone"),
        plate(i).alias("vehicle_number"),
        _from(DIMENSION_START, draws.micros(i, _salt(seed, 4), 30 * DAY_SECONDS)).alias("created_at"),
    )


def generate_orders(
    rows: DataFrame,
    seed: int = 1,
    customers: int = CUSTOMERS,
    drivers: int = DRIVERS_IN_USE,
    locations: int = LOCATIONS,
) -> DataFrame:
    """85 % done, 10 % cancelled, the rest open; one in ten without driver."""
    i = F.col("i")
    lot = draws.draw(i, _salt(seed, 5)) * 100
    status = (
        F.when(lot < F.lit(85 * draws.SPAN), F.lit(DONE))
        .when(lot < F.lit(95 * draws.SPAN), F.lit(CANCELLED))
        .otherwise(1 + draws.below(i, _salt(seed, 6), 4))
        .cast("int")
    )
    driver = F.when(~draws.share_below(i, _salt(seed, 7), 10), 1 + draws.below(i, _salt(seed, 8), drivers))
    ride = 600_000_000 + draws.micros(i, _salt(seed, 9), 3_000)
    placed = rows.select(
        i,
        status.alias("current_status"),
        _from(ORDER_START, draws.micros(i, _salt(seed, 10), 45 * DAY_SECONDS)).alias("created_at"),
    )
    return placed.select(
        i.cast("bigint").alias("order_id"),
        _numbered("order_ext_", i).alias("external_order_id"),
        (1 + draws.below(i, _salt(seed, 11), customers)).alias("customer_id"),
        driver.alias("driver_id"),
        (1 + draws.below(i, _salt(seed, 12), locations)).alias("pickup_location_id"),
        (1 + draws.below(i, _salt(seed, 13), locations)).alias("dropoff_location_id"),
        (1 + draws.below(i, _salt(seed, 14), len(TARIFF_ROWS))).cast("int").alias("tariff_id"),
        _scaled(15_000 + draws.rounded(i, _salt(seed, 15), 235_000), MONEY).alias("price"),
        _scaled(1_000 + draws.rounded(i, _salt(seed, 16), 59_000), DISTANCE).alias("distance_km"),
        "created_at",
        F.when(
            F.col("current_status") == DONE, F.timestamp_micros(F.unix_micros("created_at") + ride)
        ).alias("delivered_at"),
        "current_status",
    )


def order_events(orders: DataFrame) -> DataFrame:
    """One event for each order as it is placed, one more once it has ended.

    Both come from a single pass over the orders. ``_round`` sorts the log: all
    first events before all last ones.
    """
    placed = F.struct(
        F.lit(0).alias("_round"),
        F.lit(1).alias("status_id"),
        F.col("created_at").alias("event_time"),
        F.lit(NOTE_CREATED).alias("note"),
    )
    ended = F.struct(
        F.lit(1).alias("_round"),
        F.col("current_status").cast("int").alias("status_id"),
        F.coalesce(F.col("delivered_at"), F.col("created_at") + F.expr("INTERVAL 5 MINUTES")).alias("event_time"),
        F.when(F.col("current_status") == DONE, NOTE_DONE).otherwise(NOTE_CANCELLED).alias("note"),
    )
    has_ended = F.col("current_status").isin(DONE, CANCELLED)
    log = F.when(has_ended, F.array(placed, ended)).otherwise(F.array(placed))
    return orders.select("order_id", F.inline(log)).select("order_id", "status_id", "event_time", "note", "_round")


def generate_warehouse(
    spark: SparkSession,
    root: str,
    orders: int = ORDERS,
    seed: int = 1,
    customers: int = CUSTOMERS,
    drivers: int = DRIVERS,
    locations: int = LOCATIONS,
    drivers_in_use: int = DRIVERS_IN_USE,
) -> Warehouse:
    """Empty the warehouse and fill all base tables; orders go to the first ``drivers_in_use`` drivers."""
    require_utc(spark)
    warehouse = init_warehouse(spark, root)
    staging = f"{warehouse.root}/staging/{uuid.uuid4().hex}"

    def fill_orders() -> None:
        fact = generate_orders(
            series(spark, orders), seed, customers, min(drivers, drivers_in_use), locations
        )
        stored = warehouse.replace("orders", with_month(fact))
        # One number to sort by: rounds apart, by order within.
        place = F.shiftleft(F.col("_round").cast("bigint"), 62) + F.col("order_id")
        events = order_events(stored).select("order_id", "status_id", "event_time", "note", place.alias("_place"))
        log, last_id = number_rows(events, "event_id", ["_place"], path=f"{staging}/events")
        warehouse.replace("order_events", log.drop("_place"), last_id)

    with warehouse.together():
        together(
            [
                fill_orders,
                lambda: warehouse.replace("order_statuses", generate_statuses(spark)),
                lambda: warehouse.replace("tariffs", generate_tariffs(spark)),
                lambda: warehouse.replace("locations", generate_locations(series(spark, locations), seed)),
                lambda: warehouse.replace("customers", generate_customers(series(spark, customers), seed)),
                lambda: warehouse.replace("drivers", generate_drivers(series(spark, drivers), seed)),
            ]
        )
    files.remove(spark, staging)
    return warehouse


def with_month(orders: DataFrame) -> DataFrame:
    """The layout column of the fact: month of creation."""
    return orders.withColumn("created_month", F.date_format("created_at", "yyyy-MM"))
