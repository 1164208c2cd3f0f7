"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size: a start and a stride, drawn from
its name. The shards take turns; each claims the first free slot in its order, until the table is full. So all shards
hold the same number of slots, give or take one, and when a shard comes or goes few other slots change hands. A row's
slot is the hash of its key modulo the size; the table is sent to all tasks (its size is a parameter, at most
``MOST_SLOTS`` rows), and a row's shard is looked up there at once, whatever the number of shards.

Keys are hashed as text; a null key is the empty text, so every row has a shard, and rows with equal keys the same one.
Repeated shard names count once. No shards: an error. Other columns stay. No rows: no rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Number of shards and of slots of the query; a prime, well above a hundred slots for each shard.
SHARDS, SLOTS = 64, 8191
MOST_SLOTS = 2_000_003
#: Hexadecimal digits of the checksum that make the number.
DIGITS = 15


def _number(text: str) -> int:
    return int(md5(text.encode()).hexdigest()[:DIGITS], 16)


def fill(shards: Iterable[str], slots: int = SLOTS) -> list[int]:
    """For each slot, the place of its shard among the sorted names."""
    names = sorted(set(shards))
    if not names:
        raise ValueError("no shards")
    if not len(names) <= slots <= MOST_SLOTS or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"the number of slots must be a prime from {len(names)} to {MOST_SLOTS}")
    place = [_number(f"{n} start") % slots for n in names]
    stride = [_number(f"{n} stride") % (slots - 1) + 1 for n in names]
    owner = [-1] * slots
    for turn in range(slots):
        k = turn % len(names)
        while owner[place[k]] >= 0:
            place[k] = (place[k] + stride[k]) % slots
        owner[place[k]] = k
    return owner


def lookup_table(spark: SparkSession, shards: Iterable[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard): one row per slot, with the shard's name."""
    names = sorted(set(shards))
    owner = F.split(F.lit(",".join(map(str, fill(names, slots)))), ",")
    named = F.element_at(F.array(*map(F.lit, names)), F.col("owner").cast("int") + 1)
    return spark.range(1).select(F.posexplode(owner).alias("slot", "owner")).select("slot", named.alias("shard"))


def slot_of(key: Column | str, slots: int = SLOTS) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, DIGITS)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(slots)).cast("int")


def assign(docs: DataFrame, shards: Iterable[str], slots: int = SLOTS, key: str = "doc_id", shard_column: str = "shard", slot_column: str = "slot") -> DataFrame:
    """``docs`` with the slot and the shard of every row; columns of these names are replaced."""
    table = lookup_table(docs.sparkSession, shards, slots).toDF("_slot_known", "_shard_known")
    kept = [F.col(c) for c in docs.columns if c.lower() not in (shard_column.lower(), slot_column.lower())]
    placed = docs.select(*kept, slot_of(key, slots).alias(slot_column))
    joined = placed.join(F.broadcast(table), F.col(slot_column) == F.col("_slot_known"))
    return joined.select(*placed.columns, F.col("_shard_known").alias(shard_column))


def write(docs: DataFrame, path: str, shards: Iterable[str], slots: int = SLOTS, key: str = "doc_id") -> None:
    """One folder of Parquet files per shard. Rows go to tasks by shard and slot, so a shard is written by many tasks."""
    assign(docs, shards, slots, key).repartition("shard", F.col("slot") % 16).write.mode("overwrite").partitionBy("shard").parquet(path)


def moved(docs: DataFrame, before: Iterable[str], after: Iterable[str], slots: int = SLOTS, key: str = "doc_id") -> DataFrame:
    """(key, from, to) of the rows whose shard changes with the set of shards."""
    spark = docs.sparkSession
    old, new = (lookup_table(spark, names, slots).toDF("_slot", column) for names, column in ((before, "from"), (after, "to")))
    changed = old.join(F.broadcast(new), "_slot").where(F.col("from") != F.col("to"))
    placed = docs.select(key, slot_of(key, slots).alias("_slot"))
    return placed.join(F.broadcast(changed), "_slot").select(key, "from", "to")
