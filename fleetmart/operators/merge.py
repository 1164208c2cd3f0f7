"""Insert-if-absent and partial-column upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.contracts import Table
from fleetmart.operators.dedup import keep_first
from fleetmart.operators.keys import assign_keys
from fleetmart.operators.lookup import lookup
from fleetmart.operators.quality import QualityError, unique_violations
from fleetmart.session import materialize


def add_defaults(df: DataFrame, table: Table) -> DataFrame:
    """Defaults apply where a column is absent, not where it is NULL."""
    for column, expression in table.defaults.items():
        if column not in df.columns:
            df = df.withColumn(column, F.expr(expression))
    return df


def absent_rows(target: DataFrame, batch: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows of the batch that insert-if-absent would add: the first of each
    key, unless the target has the key. Rows without a key are always added."""
    first = keep_first(batch, [key], order, null_keys="distinct")
    return lookup(first, target.select(key), (key, key), {}, "left_anti", fact_unique=True)


def split_upsert(
    target_keys: DataFrame,
    batch: DataFrame,
    key: str,
    batch_keys: DataFrame | None = None,
    path: str | None = None,
) -> DataFrame:
    """Flag each batch row (unique on ``key``) as ``_known`` or not.

    ``target_keys`` has the key and whatever the caller wants to carry over;
    ``batch_keys`` is a cheaper source of the batch's keys, if there is one.
    The target is only read, and once, never shuffled, where the batch is small.
    """
    wanted = (batch if batch_keys is None else batch_keys).select(key)
    hits = lookup(target_keys, wanted, (key, key), {}, "inner", fact_unique=True)
    return flag_known(materialize(hits, "hits", path), batch, key)


def flag_known(hits: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """``split_upsert`` where the target's rows of the batch's keys are found already."""
    carried = [c for c in hits.columns if c != key]
    return lookup(
        batch,
        hits.withColumn("_known", F.lit(True)),
        (key, key),
        {**{c: c for c in carried}, "_known": "_known"},
        "left",
        fact_unique=True,
    ).withColumn("_known", F.coalesce("_known", F.lit(False)))


def apply_updates(target: DataFrame, changes: DataFrame, key: str, update_columns: Sequence[str]) -> DataFrame:
    """Target rows with ``update_columns`` taken from the change of that key.

    All other columns stay as stored, also where the change differs. A NULL in
    a change is written.
    """
    new = changes.select(key, *update_columns).withColumn("_changed", F.lit(True))
    joined = lookup(
        target,
        new,
        (key, key),
        {**{c: f"_new_{c}" for c in update_columns}, "_changed": "_changed"},
        "left",
        fact_unique=True,
    )
    merged = {c: F.when(F.col("_changed"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in update_columns}
    return joined.withColumns(merged).select(*target.columns)


def top_id(target: DataFrame, identity: str) -> int:
    return int(target.agg(F.max(identity).alias("top")).first()["top"] or 0)


def insert_if_absent(target: DataFrame, batch: DataFrame, table: Table, order: Sequence[str]) -> DataFrame:
    """The target with the batch's unknown keys added under new ids."""
    new = absent_rows(target, batch, table.natural_key, order)
    numbered = assign_keys(new, table.identity, order, top_id(target, table.identity))
    return target.unionByName(numbered.select(*target.columns))


def upsert(
    target: DataFrame,
    batch: DataFrame,
    table: Table,
    update_columns: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """The target with known keys updated and unknown ones added.

    A batch that names a key twice is refused: it doesn't say what to store.
    """
    key = table.natural_key
    if not unique_violations(batch, key).isEmpty():
        raise QualityError(f"{table.name}: the batch repeats values of {key}")
    flagged = split_upsert(target.select(key), add_defaults(batch, table), key)
    numbered = assign_keys(flagged.where("NOT _known"), table.identity, order, top_id(target, table.identity))
    updated = apply_updates(target, flagged.where("_known"), key, update_columns)
    return updated.unionByName(numbered.select(*target.columns))
