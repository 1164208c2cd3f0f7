"""The test tables seen as a ride warehouse.

customer → customers, supplier → drivers, nation → locations, order priority →
tariffs, order status → statuses, orders (with their lines) → rides.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.contracts import DEGREES, DISTANCE, MONEY

STAMP = "1995-01-01 00:00:00"


def money(c: str) -> Column:
    return F.col(c).cast(MONEY)


def numbered(prefix: str, c: str) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def phone(prefix: str, c: str) -> Column:
    digits = F.col(c).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(7), F.length(digits)), "0"))


_SCHEMAS: dict[str, T.StructType] = {}


class Views:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        """A test table; its footer is read for the schema only once."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    @cached_property
    def lines(self) -> DataFrame:
        return (
            self.table("lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.min("l_suppkey").alias("driver_id"),
                F.max("l_quantity").alias("quantity"),
                F.max("l_shipdate").alias("shipped"),
            )
        )

    @cached_property
    def rides(self) -> DataFrame:
        """One row per order; an order without lines has no driver and no km."""
        orders = self.table("orders")
        return orders.join(self.lines, orders.o_orderkey == F.col("l_orderkey"), "left").select(
            F.col("o_orderkey").alias("order_id"),
            numbered("order_ext_", "o_orderkey").alias("external_order_id"),
            F.col("o_custkey").alias("customer_id"),
            "driver_id",
            (F.col("o_custkey") % 25).alias("pickup_location_id"),
            (F.col("o_orderkey") % 25).alias("dropoff_location_id"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("tariff_id"),
            money("o_totalprice").alias("price"),
            F.col("quantity").cast(DISTANCE).alias("distance_km"),
            F.col("o_orderdate").alias("created_at"),
            F.when(F.col("o_orderstatus") == "F", F.col("shipped")).alias("delivered_at"),
            F.ascii(F.lower("o_orderstatus")).alias("current_status"),
        )

    @cached_property
    def full_rides(self) -> DataFrame:
        return self.rides.withColumn("distance_km", F.coalesce("distance_km", F.lit(0).cast(DISTANCE)))

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            numbered("cust_ext_", "c_custkey").alias("external_id"),
            F.col("c_name").alias("name"),
            phone("+7999", "c_custkey").alias("phone"),
            F.concat(F.lit("user_"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
            F.lit(STAMP).cast("timestamp").alias("created_at"),
        )

    @cached_property
    def drivers(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("driver_id"),
            numbered("drv_ext_", "s_suppkey").alias("external_id"),
            F.col("s_name").alias("name"),
            phone("+7911", "s_suppkey").alias("phone"),
            numbered("CAR ", "s_suppkey").alias("vehicle_number"),
            F.lit(STAMP).cast("timestamp").alias("created_at"),
        )

    @cached_property
    def locations(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").cast("bigint").alias("location_id"),
            F.col("n_name").alias("address"),
            (F.lit(55) + F.col("n_nationkey") / 8).cast(DEGREES).alias("lat"),
            (F.lit(37) + F.col("n_regionkey") / 4).cast(DEGREES).alias("lon"),
        )

    @cached_property
    def tariffs(self) -> DataFrame:
        found = self.table("orders").select("o_orderpriority").distinct()
        number = F.substring("o_orderpriority", 1, 1).cast("int")
        return found.select(
            number.alias("tariff_id"),
            F.expr("substring(o_orderpriority, 3)").alias("name"),
            (number * 100).cast(MONEY).alias("base_price"),
            (number * 5).cast(MONEY).alias("per_km"),
            F.lit(STAMP).cast("timestamp").alias("created_at"),
        )

    @cached_property
    def statuses(self) -> DataFrame:
        found = self.table("orders").select(F.lower("o_orderstatus").alias("name")).distinct()
        return found.select(F.ascii("name").alias("status_id"), "name")

    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers,
            "drivers": self.drivers,
            "locations": self.locations,
            "tariffs": self.tariffs,
            "order_statuses": self.statuses,
        }

    @cached_property
    def delivered(self) -> DataFrame:
        """All orders with what their lines say, in the tables' own types."""
        orders = self.table("orders")
        return orders.join(self.lines, orders.o_orderkey == F.col("l_orderkey"), "left").drop("l_orderkey")

    @cached_property
    def deliveries(self) -> DataFrame:
        """All orders as a raw order file: names instead of ids, text only."""
        return self.as_delivered(self.delivered)

    @staticmethod
    def as_delivered(orders: DataFrame) -> DataFrame:
        return orders.select(
            "o_orderkey",
            "o_orderdate",
            "o_orderstatus",
            numbered("order_ext_", "o_orderkey").alias("external_order_id"),
            numbered("cust_ext_", "o_custkey").alias("customer_external_id"),
            numbered("drv_ext_", "driver_id").alias("driver_external_id"),
            F.concat(F.lit("NATION_"), (F.col("o_custkey") % 25).cast("string")).alias("pickup_address"),
            F.concat(F.lit("NATION_"), (F.col("o_orderkey") % 25).cast("string")).alias("dropoff_address"),
            F.expr("substring(o_orderpriority, 3)").alias("tariff_name"),
            money("o_totalprice").cast("string").alias("price"),
            F.coalesce(F.col("quantity"), F.lit(0)).cast(DISTANCE).cast("string").alias("distance_km"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
            F.when(F.col("o_orderstatus") == "F", F.date_format("shipped", "yyyy-MM-dd'T'HH:mm:ss")).alias("delivered_at"),
        )
