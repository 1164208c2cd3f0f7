"""Natural keys to surrogate keys, and new surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetmart.operators.lookup import fits_broadcast, heavy_keys, lookup
from fleetmart.session import materialize

# raw column, dimension, natural key, surrogate key, column of the fact
ORDER_KEYS = (
    ("customer_external_id", "customers", "external_id", "customer_id", "customer_id"),
    ("driver_external_id", "drivers", "external_id", "driver_id", "driver_id"),
    ("pickup_address", "locations", "address", "location_id", "pickup_location_id"),
    ("dropoff_address", "locations", "address", "location_id", "dropoff_location_id"),
    ("tariff_name", "tariffs", "name", "tariff_id", "tariff_id"),
)


def resolve_order_keys(orders: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Replace the natural keys of delivered orders by surrogate keys.

    A key without a match becomes NULL; the row stays. The hot keys of all
    columns that look into a large dimension are found in one pass. These columns
    come last: rows are shuffled for them when the other texts are numbers.
    """
    resolved = orders
    far = [raw for raw, dim, natural, surrogate, _ in ORDER_KEYS if not fits_broadcast(dims[dim].select(natural, surrogate))]
    hot = heavy_keys(orders, far) if far else {}
    for raw, dim, natural, surrogate, column in sorted(ORDER_KEYS, key=lambda k: k[0] in far):
        resolved = lookup(resolved, dims[dim], (raw, natural), {surrogate: column}, keys_from=orders, hot=hot.get(raw)).drop(raw)
    texts, numbers = {k[0] for k in ORDER_KEYS}, [k[-1] for k in ORDER_KEYS]
    return resolved.select(*[c for c in orders.columns if c not in texts], *numbers)


def number_rows(
    df: DataFrame,
    column: str,
    order: Sequence[str],
    base: int = 0,
    path: str | None = None,
) -> tuple[DataFrame, int]:
    """Number the rows ``base + 1, base + 2, …`` without gaps, by ``order``;
    also returns the last number.

    Rows are range partitioned, sorted within partitions and written once with
    Spark's own row id, which holds the partition and the place in it. The rows
    per partition (one small row each) then give every partition its offset.
    No task or window ever sees more than one partition's rows.
    """
    placed = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
        path,
    )
    part = F.shiftright("_at", 33)
    # One row per partition: the only window here without partitions.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(column, F.lit(base) + F.col("_before") + place + 1)
        .drop("_at", "_part", "_before")
    )
    return numbered, base + placed.count()


def number_delivered(df: DataFrame, column: str, base: int = 0, chunk_bits: int = 14, path: str | None = None) -> tuple[DataFrame, int]:
    """``number_rows`` for a stored table with row positions, one row each, without a copy.

    Rows are ranked within chunks of at most 2**14 rows of one input split; the
    sizes of the chunks (one small row each, from the position columns alone)
    give every chunk its offset. The ids follow from the data, so nothing has
    to be written to fix them, and no chunk is large, whatever the files are.

    In a chunk without gaps a row's rank follows from its position; only rows
    of chunks that miss some are shuffled and sorted.
    """
    keys = ["_file", "_block", "_chunk"]
    rows = df.withColumn("_chunk", F.shiftright("_row", chunk_bits))
    chunks = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"), F.max("_row").alias("_last")
    )
    whole = F.col("_last") - F.col("_first") + 1 == F.col("_n")
    # One row per chunk: a window without partitions is fine here.
    before = W.orderBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    offsets = chunks.select(*keys, "_n", "_first", whole.alias("_whole"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    offsets = materialize(offsets, "chunks", path)
    placed = rows.join(F.broadcast(offsets.drop("_n")), keys)
    rank = F.row_number().over(W.partitionBy(*keys).orderBy("_row"))
    found = offsets.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count_if(~F.col("_whole")).alias("gaps")).first()
    numbered = placed.where("_whole").withColumn("_place", F.col("_row") - F.col("_first") + 1)
    if found["gaps"]:
        numbered = numbered.unionByName(placed.where("NOT _whole").withColumn("_place", rank.cast("bigint")))
    numbered = numbered.withColumn(column, F.lit(base) + F.col("_before") + F.col("_place"))
    return numbered.drop("_chunk", "_first", "_whole", "_before", "_place"), base + found["rows"]


def assign_keys(df: DataFrame, column: str, order: Sequence[str], base: int = 0) -> DataFrame:
    return number_rows(df, column, order, base)[0]
