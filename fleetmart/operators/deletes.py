"""What a delete in a parent table does to its children."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.operators.lookup import lookup
from fleetmart.operators.quality import QualityError


def blocked_parents(doomed: DataFrame, child: DataFrame, parent_key: str, column: str) -> DataFrame:
    """Parents that may not go because a child still refers to them.

    The references are reduced to distinct values before the join, map side
    first, so a parent with very many children is one row by then.
    """
    used = child.select(F.col(column).alias("_used")).where("_used IS NOT NULL").distinct()
    return doomed.join(used, F.col(parent_key) == F.col("_used"), "left_semi")


def delete_restrict(parent: DataFrame, doomed: DataFrame, child: DataFrame, parent_key: str, column: str) -> DataFrame:
    """The parents left after the delete; refused if one is still in use."""
    if not blocked_parents(doomed, child, parent_key, column).isEmpty():
        raise QualityError(f"{column} still refers to rows to be deleted")
    return lookup(parent, doomed, (parent_key, parent_key), {}, "left_anti", fact_unique=True)


def delete_set_null(child: DataFrame, doomed: DataFrame, column: str, parent_key: str) -> DataFrame:
    """Children with references to deleted parents cleared."""
    gone = doomed.select(F.col(parent_key).alias("_gone")).distinct()
    marked = lookup(child, gone.withColumn("_hit", F.lit(True)), (column, "_gone"), {"_hit": "_hit"})
    return marked.withColumn(column, F.when(F.col("_hit").isNull(), F.col(column))).drop("_hit")


def delete_cascade(child: DataFrame, doomed: DataFrame, column: str, parent_key: str) -> DataFrame:
    """Children of deleted parents removed."""
    gone = doomed.select(F.col(parent_key).alias("_gone")).distinct()
    return lookup(child, gone, (column, "_gone"), {}, "left_anti")
