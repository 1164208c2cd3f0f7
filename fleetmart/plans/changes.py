"""Changes to a stored warehouse other than loads: events appended, rows deleted by their rules."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.contracts import ORDER_EVENTS, ORDERS, TABLES, ForeignKey, Table
from fleetmart.operators import deletes, quality
from fleetmart.operators.keys import number_rows
from fleetmart.operators.lookup import lookup
from fleetmart.session import materialize
from fleetmart.sources import files, key_index
from fleetmart.sources.warehouse import Warehouse

EVENT_ORDER = ("event_time", "order_id", "status_id", "note")


def append_events(warehouse: Warehouse, events: DataFrame, staging: str, run: str | None = None) -> DataFrame:
    """Events of stored orders, under the next ids, by time.

    Refused as a whole if a required value is missing or a reference points
    nowhere; stored events are not read. Events of a named ``run`` count once,
    however often they are delivered.
    """
    if run is not None and run in warehouse.pointer(ORDER_EVENTS.name).runs:
        return warehouse.read(ORDER_EVENTS.name)
    rows = quality.tag(events.withColumn("event_id", F.lit(0)), quality.not_null_rules(ORDER_EVENTS)).drop("event_id")
    rows = materialize(quality.enforce(rows, ORDER_EVENTS.name)[0], "events", f"{staging}/events")
    for fk in ORDER_EVENTS.foreign_keys:
        if not quality.all_known(rows, warehouse.read(fk.parent), fk):
            raise quality.QualityError(f"{ORDER_EVENTS.name}: {fk.column} refers to no row of {fk.parent}")
    last = warehouse.pointer(ORDER_EVENTS.name).last_id
    numbered, last_id = number_rows(rows, "event_id", EVENT_ORDER, last, f"{staging}/numbered")
    added = warehouse.append(ORDER_EVENTS.name, numbered, last_id, run)
    files.remove(warehouse.spark, staging)
    return added


def delete_rows(warehouse: Warehouse, name: str, doomed: DataFrame) -> None:
    """Rows of a table removed by id, and what refers to them treated as its references say.

    All tables change in one step, or none does. Of a table laid out by month,
    only months with affected rows are rewritten. The reports are not rebuilt.
    """
    staging = f"{warehouse.root}/staging/{uuid.uuid4().hex}"
    try:
        with warehouse.together():
            _delete(warehouse, TABLES[name], doomed, staging)
    finally:
        files.remove(warehouse.spark, staging)


def _references(name: str) -> Sequence[tuple[Table, ForeignKey]]:
    return [(child, fk) for child in TABLES.values() for fk in child.foreign_keys if fk.parent == name]


def _delete(warehouse: Warehouse, table: Table, doomed: DataFrame, staging: str) -> None:
    key = table.identity
    # Every table that refers to this one, and the table itself, looks into the keys: they are found once.
    doomed = materialize(doomed.select(key).where(F.col(key).isNotNull()).distinct(), "doomed", f"{staging}/{uuid.uuid4().hex}")
    children = _references(table.name)
    for child, fk in children:
        if fk.on_delete not in ("set null", "cascade"):
            used = warehouse.read(child.name)
            if not deletes.blocked_parents(doomed, used, fk.parent_key, fk.column).isEmpty():
                raise quality.QualityError(f"{child.name}.{fk.column} still refers to rows to be deleted")
    for child, fk in children:
        hit = lookup(warehouse.read(child.name), doomed, (fk.column, fk.parent_key), {}, "left_semi")
        if fk.on_delete == "cascade":
            _delete(warehouse, child, hit, staging)
        elif fk.on_delete == "set null":
            _rewrite(warehouse, child, hit, lambda rows, fk=fk: deletes.delete_set_null(rows, doomed, fk.column, fk.parent_key))
    own = lookup(warehouse.read(table.name), doomed, (key, key), {}, "left_semi", fact_unique=True)
    _rewrite(warehouse, table, own, lambda rows: lookup(rows, doomed, (key, key), {}, "left_anti", fact_unique=True))


def _rewrite(warehouse: Warehouse, table: Table, hit: DataFrame, change: Callable[[DataFrame], DataFrame]) -> None:
    """The table with ``change`` made where ``hit`` has rows."""
    last = warehouse.pointer(table.name).last_id
    if not table.partition_by:
        if not hit.isEmpty():
            warehouse.replace(table.name, change(warehouse.read(table.name)), last)
        return
    touched = sorted(r[0] for r in hit.select(table.partition_by).distinct().collect())
    if not touched:
        return
    indexed = table is ORDERS and key_index.is_current(warehouse)
    before = warehouse.read(table.name, touched)
    rows = change(before)
    warehouse.replace_partitions(table.name, rows, touched, last)
    if indexed:
        left = warehouse.read(table.name, touched).select(table.identity)
        key_index.remove(warehouse, lookup(before, left, (table.identity, table.identity), {}, "left_anti", fact_unique=True))
