"""Fixed shape of every warehouse table: types, keys, defaults, checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
DISTANCE = T.DecimalType(7, 3)
DEGREES = T.DecimalType(9, 6)
# Sums are as wide as Spark's own sum() of the column, so that a driver or
# customer holding billions of rides still fits.
MONEY_SUM = T.DecimalType(20, 2)
DISTANCE_SUM = T.DecimalType(17, 3)


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_key: str
    on_delete: str = "no action"


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    identity: str | None = None
    natural_key: str | None = None
    unique: tuple[str, ...] = ()
    checks: dict[str, str] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()
    partition_by: str | None = None
    sort_by: str | None = None
    # Columns whose files carry Bloom filters.
    bloom: tuple[str, ...] = ()

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _schema(*fields) -> T.StructType:
    """(name, type) is nullable, (name, type, "required") is not."""
    return T.StructType([T.StructField(f[0], f[1], len(f) == 2) for f in fields])


_TEXT, _ID, _CODE, _TIME = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampType()
_REQ = "required"

CUSTOMERS = Table(
    "customers",
    _schema(
        ("customer_id", _ID, _REQ),
        ("external_id", _TEXT),
        ("name", _TEXT, _REQ),
        ("phone", _TEXT),
        ("email", _TEXT),
        ("created_at", _TIME, _REQ),
    ),
    identity="customer_id",
    natural_key="external_id",
    unique=("external_id",),
    defaults={"created_at": "current_timestamp()"},
)

DRIVERS = Table(
    "drivers",
    _schema(
        ("driver_id", _ID, _REQ),
        ("external_id", _TEXT),
        ("name", _TEXT, _REQ),
        ("phone", _TEXT),
        ("vehicle_number", _TEXT, _REQ),
        ("created_at", _TIME, _REQ),
    ),
    identity="driver_id",
    natural_key="external_id",
    unique=("external_id", "vehicle_number"),
    defaults={"created_at": "current_timestamp()"},
)

LOCATIONS = Table(
    "locations",
    _schema(
        ("location_id", _ID, _REQ),
        ("address", _TEXT, _REQ),
        ("lat", DEGREES),
        ("lon", DEGREES),
    ),
    identity="location_id",
    natural_key="address",
    unique=("address",),
    checks={"lat_range": "lat BETWEEN -90 AND 90", "lon_range": "lon BETWEEN -180 AND 180"},
)

TARIFFS = Table(
    "tariffs",
    _schema(
        ("tariff_id", _CODE, _REQ),
        ("name", _TEXT, _REQ),
        ("base_price", MONEY, _REQ),
        ("per_km", MONEY, _REQ),
        ("created_at", _TIME),
    ),
    identity="tariff_id",
    natural_key="name",
    unique=("name",),
    checks={"base_price_sign": "base_price >= 0", "per_km_sign": "per_km >= 0"},
    defaults={
        "base_price": "CAST(300.00 AS DECIMAL(10,2))",
        "per_km": "CAST(0.00 AS DECIMAL(10,2))",
        "created_at": "current_timestamp()",
    },
)

ORDER_STATUSES = Table(
    "order_statuses",
    _schema(("status_id", _CODE, _REQ), ("name", _TEXT, _REQ)),
    identity="status_id",
    natural_key="name",
    unique=("name",),
)

ORDERS = Table(
    "orders",
    _schema(
        ("order_id", _ID, _REQ),
        ("external_order_id", _TEXT),
        ("customer_id", _ID, _REQ),
        ("driver_id", _ID),
        ("pickup_location_id", _ID, _REQ),
        ("dropoff_location_id", _ID, _REQ),
        ("tariff_id", _CODE, _REQ),
        ("price", MONEY, _REQ),
        ("distance_km", DISTANCE, _REQ),
        ("created_at", _TIME, _REQ),
        ("delivered_at", _TIME),
        ("current_status", _CODE),
    ),
    identity="order_id",
    natural_key="external_order_id",
    unique=("external_order_id",),
    checks={"price_sign": "price >= 0", "distance_km_sign": "distance_km >= 0"},
    defaults={
        "created_at": "current_timestamp()",
        "delivered_at": "CAST(NULL AS TIMESTAMP)",
        "current_status": "1",
    },
    foreign_keys=(
        ForeignKey("customer_id", "customers", "customer_id", "restrict"),
        ForeignKey("driver_id", "drivers", "driver_id", "set null"),
        ForeignKey("pickup_location_id", "locations", "location_id"),
        ForeignKey("dropoff_location_id", "locations", "location_id"),
        ForeignKey("tariff_id", "tariffs", "tariff_id"),
        ForeignKey("current_status", "order_statuses", "status_id"),
    ),
    partition_by="created_month",
    sort_by="created_at",
)

# Columns an already stored order takes over from a new delivery of it.
ORDER_UPDATE_COLUMNS = ("driver_id", "price", "distance_km", "delivered_at", "current_status")

# Which month a stored order is in.
ORDER_KEYS = Table(
    "order_keys",
    _schema(("external_order_id", _TEXT, _REQ), ("stored_month", _TEXT, _REQ)),
    partition_by="bucket",
    sort_by="external_order_id",
    bloom=("external_order_id",),
)

ORDER_EVENTS = Table(
    "order_events",
    _schema(
        ("event_id", _ID, _REQ),
        ("order_id", _ID, _REQ),
        ("status_id", _CODE, _REQ),
        ("event_time", _TIME, _REQ),
        ("note", _TEXT),
    ),
    identity="event_id",
    foreign_keys=(
        ForeignKey("order_id", "orders", "order_id", "cascade"),
        ForeignKey("status_id", "order_statuses", "status_id"),
    ),
)

# What the reports are made of: totals per key and month, which add up.
DRIVER_MONTHS = Table(
    "driver_months",
    _schema(
        ("driver_id", _ID, _REQ),
        ("rides", T.LongType(), _REQ),
        ("priced", T.LongType(), _REQ),
        ("revenue", MONEY_SUM),
        ("distance_km", DISTANCE_SUM),
    ),
    partition_by="created_month",
    sort_by="driver_id",
)

CUSTOMER_MONTHS = Table(
    "customer_months",
    _schema(
        ("customer_id", _ID, _REQ),
        ("rides", T.LongType(), _REQ),
        ("priced", T.LongType(), _REQ),
        ("spent", MONEY_SUM),
        ("distance_km", DISTANCE_SUM),
        ("first_ride_at", _TIME),
        ("last_ride_at", _TIME),
    ),
    partition_by="created_month",
    sort_by="customer_id",
)

# The same over longer spans, each made of the ones below it.
DRIVER_SPANS = Table("driver_spans", DRIVER_MONTHS.schema, partition_by="span", sort_by="driver_id")
CUSTOMER_SPANS = Table("customer_spans", CUSTOMER_MONTHS.schema, partition_by="span", sort_by="customer_id")

DM_DRIVERS_EFFICIENCY = Table(
    "dm_drivers_efficiency",
    _schema(
        ("driver_id", _ID, _REQ),
        ("driver_name", _TEXT, _REQ),
        ("vehicle_number", _TEXT),
        ("total_rides", T.LongType(), _REQ),
        ("total_revenue", MONEY_SUM, _REQ),
        ("avg_order_value", MONEY),
        ("total_distance_km", DISTANCE_SUM),
        ("revenue_per_km", MONEY_SUM),
    ),
    unique=("driver_id",),
)

DM_CUSTOMER_ANALYTICS = Table(
    "dm_customer_analytics",
    _schema(
        ("customer_id", _ID, _REQ),
        ("customer_name", _TEXT, _REQ),
        ("email", _TEXT),
        ("total_rides", T.LongType(), _REQ),
        ("total_spent", MONEY_SUM, _REQ),
        ("avg_bill", MONEY),
        ("total_distance", DISTANCE_SUM),
        ("first_ride_at", _TIME),
        ("last_ride_at", _TIME),
        ("customer_lifetime_days", _CODE),
    ),
    unique=("customer_id",),
)

DM_ORDERS_SLA = Table(
    "dm_orders_sla",
    _schema(
        ("order_id", _ID, _REQ),
        ("external_order_id", _TEXT, _REQ),
        ("tariff_name", _TEXT, _REQ),
        ("final_status", _TEXT, _REQ),
        ("order_created_at", _TIME, _REQ),
        ("order_delivered_at", _TIME),
        ("total_duration_minutes", _CODE),
        ("price", MONEY, _REQ),
        ("distance_km", DISTANCE, _REQ),
    ),
    unique=("order_id",),
    partition_by="created_month",
    sort_by="order_created_at",
)

DIMENSIONS = (CUSTOMERS, DRIVERS, LOCATIONS, TARIFFS, ORDER_STATUSES)
MARTS = (DM_DRIVERS_EFFICIENCY, DM_CUSTOMER_ANALYTICS, DM_ORDERS_SLA)
TABLES = {t.name: t for t in (*DIMENSIONS, ORDERS, ORDER_KEYS, ORDER_EVENTS, DRIVER_MONTHS, CUSTOMER_MONTHS, DRIVER_SPANS, CUSTOMER_SPANS, *MARTS)}


@dataclass(frozen=True)
class RawFile:
    """A delivered CSV file: where it goes and which columns it must have."""

    entity: str
    table: Table
    required: tuple[str, ...]
    may_be_empty: bool = True


RAW_FILES = {
    r.entity: r
    for r in (
        RawFile(
            "orders",
            ORDERS,
            (
                "external_order_id",
                "customer_external_id",
                "driver_external_id",
                "pickup_address",
                "dropoff_address",
                "tariff_name",
                "price",
                "distance_km",
                "created_at",
            ),
            may_be_empty=False,
        ),
        RawFile("customers", CUSTOMERS, ("external_id", "name", "phone", "email", "created_at")),
        RawFile("drivers", DRIVERS, ("external_id", "name", "phone", "vehicle_number", "created_at")),
        RawFile("locations", LOCATIONS, ("address", "lat", "lon")),
        RawFile("tariffs", TARIFFS, ("name", "base_price", "per_km", "created_at")),
        RawFile("statuses", ORDER_STATUSES, ("name",)),
    )
}
