"""Quality gates: each check returns the rows that break a rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.contracts import ForeignKey, Table
from fleetmart.operators.lookup import fits_broadcast, lookup

VIOLATIONS = "_violations"
SEPARATOR = "; "


class QualityError(ValueError):
    """Input breaks a rule of its contract."""


# -- whole-input gates -------------------------------------------------------


def require_rows(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise QualityError(f"{name}: no rows to process")
    return df


def require_columns(df: DataFrame, required: Sequence[str], name: str) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise QualityError(f"{name}: missing columns {missing}")
    return df


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any of the columns."""
    return df.dropna(subset=list(columns))


def extra_columns(df: DataFrame, table: Table) -> list[str]:
    """Columns a table would refuse."""
    return [c for c in df.columns if c not in table.columns and not c.startswith("_")]


# -- row rules ---------------------------------------------------------------


def tag(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add the names of the broken rules of each row to its violations.

    They are kept as one text, empty for a good row: unlike the functions that
    filter arrays, text concatenation is compiled.
    """
    before = [F.when(F.col(VIOLATIONS) != "", F.col(VIOLATIONS))] if VIOLATIONS in df.columns else []
    broken = [F.when(cond, F.lit(name)) for name, cond in rules.items()]
    return df.withColumn(VIOLATIONS, F.concat_ws(SEPARATOR, *before, *broken) if before or broken else F.lit(""))


def broken_rules() -> Column:
    """The violations of a row, one row each."""
    return F.explode(F.split(VIOLATIONS, SEPARATOR))


def not_null_rules(table: Table, columns: Sequence[str] | None = None) -> dict[str, Column]:
    names = [c for c in table.not_null if c != table.identity] if columns is None else columns
    return {f"{c} is null": F.col(c).isNull() for c in names}


def check_rules(table: Table) -> dict[str, Column]:
    """NULL passes a check, as in SQL."""
    return {name: ~F.expr(cond) for name, cond in table.checks.items()}


def violations_of(df: DataFrame, rules: dict[str, Column], key: Sequence[str]) -> DataFrame:
    """One row per row and broken rule: key columns and rule name."""
    tagged = tag(df.drop(VIOLATIONS), rules).where(F.col(VIOLATIONS) != "")
    return tagged.select(*key, broken_rules().alias("rule"))


def not_null_violations(df: DataFrame, table: Table, key: Sequence[str]) -> DataFrame:
    return violations_of(df, not_null_rules(table), key)


def check_violations(df: DataFrame, table: Table, key: Sequence[str]) -> DataFrame:
    return violations_of(df, check_rules(table), key)


# -- set rules ---------------------------------------------------------------


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs never clash."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def fk_orphans(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """Child rows whose reference is set but points nowhere."""
    known = child.where(F.col(fk.column).isNotNull())
    return lookup(known, parent, (fk.column, fk.parent_key), {}, "left_anti")


def all_known(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> bool:
    """Whether every reference that is set points to a parent row.

    A small parent is sent to the child's rows. Otherwise the keys alone of both
    go through one shuffle; partial results take repeated keys together before it.
    """
    used = child.select(F.col(fk.column).alias("_key")).where("_key IS NOT NULL")
    there = parent.select(F.col(fk.parent_key).alias("_key"))
    if fits_broadcast(there):
        return used.join(F.broadcast(there), "_key", "left_anti").isEmpty()
    both = used.withColumn("_there", F.lit(False)).unionByName(there.withColumn("_there", F.lit(True)))
    return both.groupBy("_key").agg(F.max("_there").alias("_there")).where("NOT _there").isEmpty()


# -- what to do with broken rows ---------------------------------------------


def enforce(df: DataFrame, name: str, on_violation: str = "fail") -> tuple[DataFrame, DataFrame | None]:
    """Split off rows with violations.

    ``fail`` refuses the whole input if there is any (the counts per rule go
    into the message); ``quarantine`` returns the good rows and the rejects.
    """
    if on_violation not in ("fail", "quarantine"):
        raise ValueError(f"on_violation is 'fail' or 'quarantine', not {on_violation!r}")
    bad = df.where(F.col(VIOLATIONS) != "")
    good = df.where(F.col(VIOLATIONS) == "").drop(VIOLATIONS)
    if on_violation == "quarantine":
        return good, bad
    counts = bad.select(broken_rules().alias("rule")).groupBy("rule").count().collect()
    if counts:
        found = ", ".join(f"{r['rule']} ({r['count']} rows)" for r in sorted(counts))
        raise QualityError(f"{name}: {found}")
    return good, None
