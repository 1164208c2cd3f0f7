"""Bronze to Silver: one cleaner per entity.

All of them keep the row position (needed for first-row-wins and for ids in
file order) and collect violations that the warehouse would refuse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.contracts import DEGREES, DISTANCE, MONEY
from fleetmart.functions import text
from fleetmart.operators.dedup import keep_first
from fleetmart.operators.lookup import fits_broadcast
from fleetmart.operators.quality import require_not_null, tag
from fleetmart.session import materialize
from fleetmart.sources.csv_files import OVERFLOW, POSITION

FEW_BYTES = 4 * 1024 * 1024

ORDER_TEXTS = (
    "external_order_id",
    "customer_external_id",
    "driver_external_id",
    "pickup_address",
    "dropoff_address",
    "tariff_name",
)


def _overflow(df: DataFrame) -> dict[str, Column]:
    return {"too many fields": F.col(OVERFLOW)} if OVERFLOW in df.columns else {}


def _too_big(**kinds) -> dict[str, Column]:
    return {f"{c} out of range": text.too_big(F.col(c), kind) for c, kind in kinds.items()}


def clean_orders(df: DataFrame, position: tuple[str, ...] = POSITION, scratch: str | None = None) -> DataFrame:
    """First delivery of each order, typed and stripped.

    Duplicates go before anything else, so a bad first row takes its later
    copies with it. A second pass is for keys that differ only in outer blanks.
    Rows without a key are dropped at the end anyway, so they go first.

    Few deliveries repeat: the doubtful keys, repeated or padded, are found from
    the key column alone. Only the few columns that decide between their rows are
    shuffled and sorted, down to the positions of the rows that stay, at most one
    a doubtful key; then all columns are read once, and no row is shuffled.
    ``df`` should be a stored table, as its key is read more often. Doubtful keys
    and positions are written to ``scratch``, or else to the session's shared folder.
    """
    key = "external_order_id"
    keyed = require_not_null(df, [key])

    def settled(rows: DataFrame) -> DataFrame:
        return keep_first(_typed_orders(keep_first(rows, [key], position)), [key], position)

    bare = text.strip(F.col(key))
    copies = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    doubtful = copies.where((F.col("_copies") > 1) | (bare != F.col(key)))
    doubtful = materialize(doubtful.select(bare.alias("_doubtful")).distinct(), "doubtful_keys", scratch and f"{scratch}/keys")
    if doubtful.isEmpty():
        return _typed_orders(keyed)
    if not fits_broadcast(doubtful, FEW_BYTES):
        return settled(keyed)
    is_doubtful = bare == F.col("_doubtful")
    unsure = keyed.join(F.broadcast(doubtful), is_doubtful, "left_semi")
    staying = settled(unsure).select(*[F.col(p).alias(f"_at_{p}") for p in position], F.lit(True).alias("_stays"))
    staying = materialize(staying, "positions", scratch and f"{scratch}/positions")
    if not fits_broadcast(staying, None):
        return settled(keyed)
    same = [F.col(p).eqNullSafe(F.col(f"_at_{p}")) for p in position]
    marked = keyed.join(F.broadcast(doubtful), is_doubtful, "left").join(F.broadcast(staying), same, "left")
    return _typed_orders(marked.where("_doubtful is null or _stays").select(*keyed.columns))


def _typed_orders(first: DataFrame) -> DataFrame:
    optional = {"delivered_at": text.to_time, "current_status": text.to_code}
    optional = {c: parse for c, parse in optional.items() if c in first.columns}
    typed = ("price", "distance_km", "created_at", *optional)
    # Parsed once under other names, so that the rules can compare with the raw text. The row's number keeps the filter
    # above this step: below it, it would parse prices and times a second time.
    parsed = first.withColumns(
        {
            "_price": text.to_decimal(F.col("price"), MONEY),
            "_distance_km": text.to_decimal(F.col("distance_km"), DISTANCE),
            "_created_at": text.to_time(F.col("created_at")),
            **{f"_{c}": parse(F.col(c)) for c, parse in optional.items()},
            "_number": F.monotonically_increasing_id(),
        }
    )
    big_price = text.unreadable(F.col("price"), F.col("_price")) & text.is_number(F.col("price"))
    parsed = parsed.withColumn("_big_price", F.coalesce(big_price, F.lit(False)))
    # A price too big for its type is a number all the same: not dropped, but a violation.
    kept = parsed.where((F.col("_number") >= 0) & F.col("_created_at").isNotNull() & (F.col("_price").isNotNull() | F.col("_big_price")))
    rules = {
        **_overflow(first),
        "price out of range": F.col("_big_price"),
        "distance_km out of range": text.unreadable(F.col("distance_km"), F.col("_distance_km"))
        & text.is_number(F.col("distance_km")),
        **{f"{c} unreadable": text.unreadable(F.col(c), F.col(f"_{c}")) for c in optional},
    }
    stripped = {c: text.strip_padded(F.col(c)) for c in ORDER_TEXTS}
    cleaned = tag(kept, rules).withColumns({**stripped, **{c: F.col(f"_{c}") for c in typed}})
    return cleaned.drop(OVERFLOW, "_big_price", "_number", *[f"_{c}" for c in typed])


def clean_customers(df: DataFrame) -> DataFrame:
    return (
        tag(df, _overflow(df))
        .withColumns({c: text.strip(F.col(c)) for c in ("external_id", "name", "phone", "email")})
        .withColumn("created_at", text.to_time(F.col("created_at")))
        .drop(OVERFLOW)
    )


def clean_drivers(df: DataFrame) -> DataFrame:
    return (
        tag(df, _overflow(df))
        .withColumns({c: text.strip(F.col(c)) for c in ("external_id", "name", "phone")})
        .withColumn("vehicle_number", text.strip_upper(F.col("vehicle_number")))
        .withColumn("created_at", text.to_time(F.col("created_at")))
        .drop(OVERFLOW)
    )


def clean_locations(df: DataFrame) -> DataFrame:
    return (
        tag(df, {**_overflow(df), **_too_big(lat=DEGREES, lon=DEGREES)})
        .withColumn("address", text.strip(F.col("address")))
        .withColumns({c: text.to_decimal(F.col(c), DEGREES) for c in ("lat", "lon")})
        .drop(OVERFLOW)
    )


def clean_tariffs(df: DataFrame) -> DataFrame:
    return (
        tag(df, {**_overflow(df), **_too_big(base_price=MONEY, per_km=MONEY)})
        .withColumn("name", text.strip(F.col("name")))
        .withColumns({c: text.to_decimal(F.col(c), MONEY) for c in ("base_price", "per_km")})
        .withColumn("created_at", text.to_time(F.col("created_at")))
        .drop(OVERFLOW)
    )


def clean_statuses(df: DataFrame) -> DataFrame:
    return tag(df, _overflow(df)).withColumn("name", text.strip_lower(F.col("name"))).drop(OVERFLOW)


CLEANERS = {
    "orders": clean_orders,
    "customers": clean_customers,
    "drivers": clean_drivers,
    "locations": clean_locations,
    "tariffs": clean_tariffs,
    "statuses": clean_statuses,
}
