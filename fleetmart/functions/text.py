"""Column functions for raw text: trim, numbers, times, missing values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts a CSV reader of the pandas family takes for "missing".
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# The characters Python's str.strip() removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
DATE = r"(?U)^\s*\d{4}-\d{2}-\d{2}"


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(NA_TOKENS), c)


def strip(c: Column) -> Column:
    """Outer white space removed; ``trim`` alone removes blanks only."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def strip_padded(c: Column) -> Column:
    """``strip`` for columns whose texts hardly ever need it: those that begin and end with visible ASCII are not searched."""
    last = F.substring(c, -1, 1)
    return F.when((c >= "!") & (c < "\x7f") & (last >= "!") & (last < "\x7f"), c).otherwise(strip(c))


def strip_upper(c: Column) -> Column:
    return strip(F.upper(c))


def strip_lower(c: Column) -> Column:
    return F.lower(strip(c))


def to_decimal(c: Column, kind: T.DecimalType) -> Column:
    """Text to decimal, rounded half-up; NULL for what is no number or too big."""
    return strip(c).try_cast(kind)


def is_number(c: Column) -> Column:
    return strip(c).rlike(NUMBER)


def too_big(c: Column, kind: T.DecimalType) -> Column:
    """True where the text is a number that the type cannot hold."""
    return F.coalesce(to_decimal(c, kind).isNull() & is_number(c), F.lit(False))


def to_time(c: Column) -> Column:
    """ISO text to timestamp; NULL for anything that does not start with a date.

    The pattern is needed: Spark alone reads ``10:00`` as today and ``2026`` as
    the first of January.
    """
    return F.when(c.rlike(DATE), strip(c)).try_cast("timestamp")


def to_code(c: Column) -> Column:
    """Text to an integer code (``5`` or ``5.0``); NULL for anything else."""
    value = to_decimal(c, T.DecimalType(20, 6))
    return F.when(value == F.floor(value), value).try_cast("int")


def unreadable(raw: Column, parsed: Column) -> Column:
    return raw.isNotNull() & parsed.isNull()
