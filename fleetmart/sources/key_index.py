"""Where stored orders are, by their external id.

``order_keys`` has the key and the month of every stored order, dealt to buckets
by a hash of the key; files are sorted by key and carry Bloom filters. A batch
reads the buckets of its own keys only, and if its keys are few, of these only
the row groups that may hold one of them. So a daily delivery costs what the day
costs, not what the history costs.

The index belongs to the version of the warehouse it was written with. It names
the order folders it covers; if these aren't the present ones, it is built anew
from the keys of all orders.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.contracts import ORDER_KEYS, ORDERS
from fleetmart.operators.lookup import lookup
from fleetmart.sources.warehouse import Warehouse, partition_of

BUCKETS = 64
# Batches of at most so many keys are looked for by value in the files' own statistics.
FEW_KEYS = 1000
# Most folders a bucket may have before it is rewritten as one.
MOST_FOLDERS = 16

_KEY, _MONTH, _BUCKET = ORDERS.natural_key, "stored_month", ORDER_KEYS.partition_by
# Longer lists of values reach the files as one range only.
_LIST = 10


def bucket(key: str | Column) -> Column:
    """The bucket of a key: its first 32 bits of MD5."""
    number = F.conv(F.substring(F.md5(F.col(key) if isinstance(key, str) else key), 1, 8), 16, 10).cast("bigint")
    return F.lpad((number % BUCKETS).cast("string"), 3, "0")


def _entries(orders: DataFrame) -> DataFrame:
    keyed = orders.where(F.col(_KEY).isNotNull())
    return keyed.select(_KEY, F.col(ORDERS.partition_by).alias(_MONTH), bucket(_KEY).alias(_BUCKET))


def _covered(warehouse: Warehouse) -> list[str]:
    return sorted(warehouse.pointer(ORDERS.name).folders)


def is_current(warehouse: Warehouse) -> bool:
    return warehouse.has(ORDER_KEYS.name) and warehouse.pointer(ORDER_KEYS.name).built_from == _covered(warehouse)


def build(warehouse: Warehouse) -> None:
    """The index of all stored orders, from their keys and months."""
    if not warehouse.has(ORDER_KEYS.name):
        warehouse.create(ORDER_KEYS.name)
    warehouse.replace(ORDER_KEYS.name, _entries(warehouse.read(ORDERS.name)), built_from=_covered(warehouse))


def find(warehouse: Warehouse, keys: DataFrame) -> DataFrame:
    """(key, stored_month) of the stored orders among ``keys``."""
    if not is_current(warehouse):
        build(warehouse)
    if not warehouse.pointer(ORDER_KEYS.name).folders:
        return warehouse.read(ORDER_KEYS.name).select(_KEY, _MONTH)
    keys = keys.select(_KEY).where(F.col(_KEY).isNotNull())
    placed = keys.select(_KEY, bucket(_KEY).alias(_BUCKET))
    few = placed.limit(FEW_KEYS + 1).collect()
    buckets = {r[1] for r in few}
    # The first keys of a long batch are nearly always in all buckets, so the others needn't be looked at for theirs.
    if len(few) > FEW_KEYS and len(buckets) < BUCKETS:
        buckets = {r[0] for r in placed.select(_BUCKET).distinct().collect()}
    stored = warehouse.read(ORDER_KEYS.name, sorted(buckets)).select(_KEY, _MONTH)
    if len(few) <= FEW_KEYS:
        stored = stored.where(_one_of(sorted({r[0] for r in few})))
    return lookup(stored, keys, (_KEY, _KEY), {}, "left_semi", fact_unique=True)


def _one_of(values: list[str]) -> Column:
    """The key is one of the values, said in short lists under a flat tree of alternatives."""
    parts = [F.col(_KEY).isin(values[k : k + _LIST]) for k in range(0, len(values), _LIST)] or [F.lit(False)]
    while len(parts) > 1:
        parts = [parts[k] | parts[k + 1] if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0]


def add(warehouse: Warehouse, new: DataFrame) -> None:
    """Orders that have just been stored; to be called in the step that stores them, with an index that was current."""
    folders = Counter(map(partition_of, warehouse.pointer(ORDER_KEYS.name).folders))
    full = sorted(b for b, n in folders.items() if n >= MOST_FOLDERS)
    entries = _entries(new)
    is_full = F.col(_BUCKET).isin(full)
    rows = warehouse.read(ORDER_KEYS.name, full).unionByName(entries.where(is_full))
    warehouse.replace_partitions(ORDER_KEYS.name, rows, full, added=entries.where(~is_full), built_from=_covered(warehouse))


def remove(warehouse: Warehouse, gone: DataFrame) -> None:
    """Orders that have just been deleted; only their buckets are rewritten."""
    keys = gone.select(_KEY).where(F.col(_KEY).isNotNull())
    touched = sorted(r[0] for r in keys.select(bucket(_KEY)).distinct().collect())
    left = lookup(warehouse.read(ORDER_KEYS.name, touched), keys, (_KEY, _KEY), {}, "left_anti", fact_unique=True)
    warehouse.replace_partitions(ORDER_KEYS.name, left, touched, built_from=_covered(warehouse))


def folders_read(found: DataFrame) -> set[str]:
    """The buckets that a result of ``find`` reads."""
    return {partition_of(f.rsplit("/", 1)[0]) for f in found.inputFiles() if f"/{_BUCKET}=" in f}


def covers(warehouse: Warehouse, buckets: Iterable[str]) -> bool:
    """Whether every stored order of these buckets is in the index exactly once."""
    wanted = list(buckets)
    stored = _entries(warehouse.read(ORDERS.name)).where(F.col(_BUCKET).isin(wanted))
    return stored.exceptAll(warehouse.read(ORDER_KEYS.name, wanted)).isEmpty() and warehouse.read(ORDER_KEYS.name, wanted).exceptAll(stored).isEmpty()
