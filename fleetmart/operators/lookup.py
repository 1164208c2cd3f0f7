"""Equi-joins of a large table with a table that is unique on its key."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
LIMIT_SETTING = "spark.fleetmart.broadcastBytes"
ROW_OVERHEAD = 32
ESTIMATE_MARGIN = 16  # rows in memory against compressed columns on disk
# Values that a sketch of frequent keys keeps count of: at least, and as many as Spark allows.
TRACKED, TRACKED_MOST = 10_000, 1_000_000
KINDS = ("left", "inner", "left_semi", "left_anti")


def _slot(kind: T.DataType) -> int:
    """Bytes of an array's element of fixed size."""
    return 16 + 8 * len(kind.fields) if isinstance(kind, T.StructType) else 8


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the size of ``df`` as broadcast rows; one aggregate."""
    row = F.lit(ROW_OVERHEAD + 8 * len(df.columns))
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            row = row + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            row = row + F.greatest(F.size(f.name), F.lit(0)) * _slot(f.dataType.elementType) + 16
    return df.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0)).alias("size")).first()["size"]


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate: file bytes of the columns read, before
    filters; joins and expansions count as their worst case."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Whether ``df`` is small enough to send to every executor.

    An estimate far below the limit decides without a job; anything else is
    measured. The limit can be set for a session under ``LIMIT_SETTING``.
    """
    if limit is None:
        limit = int(df.sparkSession.conf.get(LIMIT_SETTING, str(BROADCAST_BYTES)))
    return estimated_bytes(df) * ESTIMATE_MARGIN <= limit or measured_bytes(df) <= limit


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that hold more rows than one shuffle partition should.

    A key is hot above 1/P of the rows (P shuffle partitions), so there are
    fewer than P of them, whatever the size of ``df``. NULL counts as a key.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    found = counts.where(F.col("_n") > max(total // parts, 1)).select("_key").take(parts)
    return spark.createDataFrame(found, T.StructType([T.StructField("_key", df.schema[key].dataType)]))


def heavy_keys(df: DataFrame, keys: Sequence[str]) -> dict[str, DataFrame]:
    """The hot keys of several columns, found in one pass.

    Each task keeps a sketch of the most frequent values per column, and the
    sketches are merged: nothing is shuffled by key. Counts are estimates, so a
    key may be named that is just not hot, which costs nothing but a place in a
    small broadcast; one that is hot isn't missed, as far more values are
    tracked than can be hot. NULL is no key here.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(TRACKED_MOST, max(TRACKED, 8 * parts))
    sketches = [F.expr(f"approx_top_k(`{k}`, {min(parts, tracked)}, {tracked})").alias(f"_{n}") for n, k in enumerate(keys)]
    found = df.agg(F.count(F.lit(1)).alias("_total"), *sketches).first()
    least = max(found["_total"] // parts, 1)
    return {
        k: spark.createDataFrame(
            [(x["item"],) for x in found[f"_{n}"] if x["count"] > least and x["item"] is not None],
            T.StructType([T.StructField("_key", df.schema[k].dataType)]),
        )
        for n, k in enumerate(keys)
    }


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: tuple[str, str],
    take: Mapping[str, str],
    how: str = "left",
    limit: int | None = None,
    fact_unique: bool = False,
    keys_from: DataFrame | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add columns of ``dim`` to ``fact``.

    ``on`` is (fact column, dim column), ``take`` maps dim columns to new
    names, ``how`` is one of ``KINDS``; ``left_semi`` and ``left_anti`` take
    nothing. ``dim`` has at most one row per key.

    A dim small enough is broadcast: the fact is not shuffled. Otherwise see
    ``_spread_join``; ``fact_unique`` says that no key occurs twice in the
    fact, and ``keys_from`` names a cheaper source of the fact's keys to look
    for hot ones. ``hot`` are keys known to be hot (``heavy_keys``), for a dim
    that is known to be too large.
    """
    if how not in KINDS or (take and how in ("left_semi", "left_anti")):
        raise ValueError(f"a {how} lookup that takes {list(take)}")
    fact_key, dim_key = on
    dim = dim.select(
        F.col(dim_key).alias("_key"), *[F.col(c).alias(new) for c, new in take.items()]
    ).where(F.col("_key").isNotNull())

    if hot is None and fits_broadcast(dim, limit):
        return fact.join(F.broadcast(dim), F.col(fact_key) == F.col("_key"), how).drop("_key")
    if hot is None and not fact_unique:
        hot = hot_keys(keys_from if keys_from is not None else fact, fact_key)
    return _spread_join(fact, dim, fact_key, list(take.values()), how, hot)


def _numbers(fact: DataFrame) -> Column:
    """A number per row that a repeated task gives the same row again.

    Behind a shuffle the order of a partition's rows may change from one
    attempt to the next, but not which rows it has; without one the place in
    the partition is fixed as well.
    """
    plan = fact._jdf.queryExecution().executedPlan().toString()
    if re.search(r"(?<!Broadcast)Exchange ", plan):
        return F.xxhash64(F.spark_partition_id(), *fact.columns)
    return F.xxhash64(F.monotonically_increasing_id())


def _spread_join(
    fact: DataFrame, dim: DataFrame, key: str, names: list[str], how: str, hot: DataFrame | None
) -> DataFrame:
    """Shuffle join in one pass over the fact, safe against hot keys.

    Hot keys (fewer than P) meet their dim rows by broadcast first. Their rows,
    and rows without a key, then go through the shuffle without a key but with
    a number of their own, so they spread over all reducers and match nothing.
    Rows that are equal in all columns spread too, see ``_numbers``.
    """
    apart = F.col(key).isNull()
    numbers = _numbers(fact)
    near = {}
    if hot is not None:
        of_hot = dim.join(F.broadcast(hot), "_key", "left_semi").withColumn("_found", F.lit(True))
        beside = hot.join(F.broadcast(of_hot), "_key", "left").select(
            F.col("_key").alias("_hot"),
            F.col("_found").alias("_near"),
            *[F.col(n).alias(f"_near_{n}") for n in names],
        )
        columns = fact.columns
        fact = fact.join(F.broadcast(beside), F.col(key) == F.col("_hot"), "left")
        apart = apart | F.col("_hot").isNotNull()
        near = {n: F.col(f"_near_{n}") for n in names}
    else:
        columns = fact.columns
    placed = fact.withColumns(
        {
            "_key": F.when(~apart, F.col(key)),
            "_spread": F.when(apart, 1 + F.pmod(numbers, F.lit(1 << 30))).otherwise(F.lit(0)),
        }
    )
    # Always 0, but not a constant that the optimizer would take out of the key.
    zero = F.pmod(F.xxhash64("_key"), F.lit(1))
    joined = placed.join(
        dim.withColumns({"_spread": zero, "_far": F.lit(True)}), ["_key", "_spread"], "left"
    )
    found = F.coalesce(*([F.col("_near")] if hot is not None else []), F.col("_far"), F.lit(False))
    if how != "left":
        joined = joined.where(~found if how == "left_anti" else found)
    if how in ("left_semi", "left_anti"):
        return joined.select(*columns)
    return joined.select(*columns, *[F.coalesce(near[n], F.col(n)).alias(n) if near else F.col(n) for n in names])
