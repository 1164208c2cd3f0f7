"""The three reports built from the star schema.

The fact is reduced by its own key first and joined afterwards: partial sums
absorb hot drivers and customers on the map side, and the joins then run over
one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.contracts import DISTANCE_SUM, MONEY, MONEY_SUM
from fleetmart.functions.measures import elapsed_days, elapsed_minutes, exact_average, ratio_or_zero
from fleetmart.operators.lookup import lookup


def driver_totals(orders: DataFrame, *by: str) -> DataFrame:
    """Rides, revenue and distance per driver, and per ``by`` if given; orders without a driver don't count."""
    return (
        orders.where(F.col("driver_id").isNotNull())
        .groupBy("driver_id", *by)
        .agg(
            F.count("order_id").alias("rides"),
            F.count("price").alias("priced"),
            F.sum("price").cast(MONEY_SUM).alias("revenue"),
            F.sum("distance_km").cast(DISTANCE_SUM).alias("distance_km"),
        )
    )


def add_driver_totals(parts: DataFrame, *by: str) -> DataFrame:
    """Totals of several months, say, to one row per driver, and per ``by`` if given."""
    return parts.groupBy("driver_id", *by).agg(
        F.sum("rides").alias("rides"),
        F.sum("priced").alias("priced"),
        F.sum("revenue").cast(MONEY_SUM).alias("revenue"),
        F.sum("distance_km").cast(DISTANCE_SUM).alias("distance_km"),
    )


def drivers_report(totals: DataFrame, drivers: DataFrame) -> DataFrame:
    """The report from one row of totals per driver; drivers without an order do not appear."""
    names = drivers.select("driver_id", F.col("name").alias("driver_name"), "vehicle_number")
    return totals.join(names, "driver_id").select(
        "driver_id",
        "driver_name",
        "vehicle_number",
        F.col("rides").alias("total_rides"),
        F.col("revenue").alias("total_revenue"),
        exact_average(F.col("revenue"), F.col("priced")).cast(MONEY).alias("avg_order_value"),
        F.col("distance_km").alias("total_distance_km"),
        ratio_or_zero(F.col("revenue"), F.col("distance_km")).cast(MONEY_SUM).alias("revenue_per_km"),
    )


def drivers_efficiency(orders: DataFrame, drivers: DataFrame) -> DataFrame:
    """Rides, revenue and distance per driver, whatever the order's status."""
    return drivers_report(driver_totals(orders), drivers)


def customer_totals(orders: DataFrame, *by: str) -> DataFrame:
    """Spending and activity per customer, and per ``by`` if given."""
    return (
        orders.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", *by)
        .agg(
            F.count("order_id").alias("rides"),
            F.count("price").alias("priced"),
            F.sum("price").cast(MONEY_SUM).alias("spent"),
            F.sum("distance_km").cast(DISTANCE_SUM).alias("distance_km"),
            F.min("created_at").alias("first_ride_at"),
            F.max("created_at").alias("last_ride_at"),
        )
    )


def add_customer_totals(parts: DataFrame, *by: str) -> DataFrame:
    return parts.groupBy("customer_id", *by).agg(
        F.sum("rides").alias("rides"),
        F.sum("priced").alias("priced"),
        F.sum("spent").cast(MONEY_SUM).alias("spent"),
        F.sum("distance_km").cast(DISTANCE_SUM).alias("distance_km"),
        F.min("first_ride_at").alias("first_ride_at"),
        F.max("last_ride_at").alias("last_ride_at"),
    )


def customers_report(totals: DataFrame, customers: DataFrame) -> DataFrame:
    """The report from one row of totals per customer; customers without a ride stay, with zeros."""
    names = customers.select("customer_id", F.col("name").alias("customer_name"), "email")
    average = exact_average(F.col("spent"), F.when(F.col("priced") > 0, F.col("priced")))
    return names.join(totals, "customer_id", "left").select(
        "customer_id",
        "customer_name",
        "email",
        F.coalesce("rides", F.lit(0).cast("bigint")).alias("total_rides"),
        F.coalesce("spent", F.lit(0)).cast(MONEY_SUM).alias("total_spent"),
        F.coalesce(average, F.lit(0)).cast(MONEY).alias("avg_bill"),
        F.coalesce("distance_km", F.lit(0)).cast(DISTANCE_SUM).alias("total_distance"),
        "first_ride_at",
        "last_ride_at",
        elapsed_days(F.col("first_ride_at"), F.col("last_ride_at")).alias("customer_lifetime_days"),
    )


def customer_analytics(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Spending and activity per customer, including those without a ride."""
    return customers_report(customer_totals(orders), customers)


def orders_sla(orders: DataFrame, statuses: DataFrame, tariffs: DataFrame, *also: str) -> DataFrame:
    """How long each order took. Orders without a known status are left out.

    ``also`` names further columns of the orders to carry along.
    """
    named = lookup(orders, statuses, ("current_status", "status_id"), {"name": "final_status"}, "inner")
    named = lookup(named, tariffs, ("tariff_id", "tariff_id"), {"name": "tariff_name"}, "inner", keys_from=orders)
    return named.select(
        "order_id",
        "external_order_id",
        "tariff_name",
        "final_status",
        F.col("created_at").alias("order_created_at"),
        F.col("delivered_at").alias("order_delivered_at"),
        elapsed_minutes(F.col("created_at"), F.col("delivered_at")).alias("total_duration_minutes"),
        "price",
        "distance_km",
        *also,
    )
