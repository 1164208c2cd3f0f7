"""Reproducible pseudo-random draws.

``rand(seed)`` depends on how rows fall into partitions. These draws depend
only on the row number and a salt, use plain 64-bit arithmetic (whole-stage
codegen), and any SQL engine can repeat them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = 4294967296  # draws are integers in [0, 2**32)
MIX = 73244475  # odd multiplier of a well-known 32-bit integer hash
STEP = 2654435761  # 2**32 / golden ratio, spreads neighbouring salts


def draw(i: Column, salt: int) -> Column:
    """A 32-bit integer that looks random in ``i`` and ``salt``.

    The low word of ``i`` is mixed in a first round; the high word comes in
    only then, so rows 2**32 apart differ. The salt comes in at both places, so
    no column is another one shifted.
    """
    i = i.cast("bigint")
    before = salt * STEP % SPAN
    between = (before ^ before >> 16) * MIX % SPAN
    h = (i + F.lit(before)) % SPAN
    h = (h.bitwiseXOR(F.shiftright(h, 16)) * MIX) % SPAN
    h = h.bitwiseXOR((F.shiftright(i, 32) * STEP + F.lit(between)) % SPAN)
    h = (h.bitwiseXOR(F.shiftright(h, 16)) * MIX) % SPAN
    return h.bitwiseXOR(F.shiftright(h, 16))


def below(i: Column, salt: int, n: int) -> Column:
    """Integer in [0, n), as ``floor(random() * n)``."""
    return F.shiftright(draw(i, salt) * n, 32)


def rounded(i: Column, salt: int, width: int) -> Column:
    """Integer in [0, width], as ``round(random() * width)``."""
    return F.shiftright(draw(i, salt) * width + SPAN // 2, 32)


def share_below(i: Column, salt: int, percent: int) -> Column:
    """True with the given probability."""
    return draw(i, salt) * 100 < F.lit(percent * SPAN)


def micros(i: Column, salt: int, seconds: int) -> Column:
    """Microseconds in [0, seconds), as ``random() * interval``."""
    scaled = draw(i, salt) * seconds
    return F.shiftright(scaled, 32) * 1_000_000 + F.shiftright(scaled % SPAN * 1_000_000, 32)
