"""Exact measures used by the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_average(total: Column, n: Column) -> Column:
    """Average rounded once. ``avg()`` of a decimal rounds first to four more
    digits, so ``round(avg(x), 2)`` would round twice."""
    return F.round(total / n, 2)


def ratio_or_zero(total: Column, base: Column) -> Column:
    return F.round(F.when(base > 0, total / base).otherwise(F.lit(0)), 2)


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole periods of 24 hours, not calendar days."""
    return F.extract(F.lit("DAY"), end - start).cast("int")


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Minutes between two times, rounded half away from zero."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.round(micros.cast("decimal(20,0)") / 60_000_000).cast("int")
