"""Labelled rows for training, a bounded sample where the caller asks for one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Of five parts by the checksum of the id, part 0 is held out of every training.
PARTS = 5


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a row is held out; one without an id never is (nor is it ever trained on)."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % PARTS == 0, F.lit(False))


def sample(rows: DataFrame, label: str, id_column: str, per_label: int) -> DataFrame:
    """(id, label) of about ``per_label`` rows of each label that aren't held out; of all, if there are fewer.

    Chosen are the ids whose hash lies below the label's share, so it is a filter: no rows of a label meet in a task.
    The size differs from ``per_label`` by chance, by a few times its square root. A row counts once for an id and label.
    """
    named = rows.where(F.col(id_column).isNotNull() & F.col(label).isNotNull() & ~held_out(id_column))
    own = named.select(id_column, label).distinct()
    counts = {r[0]: r[1] for r in own.groupBy(label).count().collect()}
    chosen = F.lit(False)
    for value, count in counts.items():
        below = F.pmod(F.xxhash64(id_column), F.lit(1 << 32)) < min(1.0, per_label / count) * (1 << 32)
        chosen = chosen | ((F.col(label) == value) & below)
    return own.where(chosen)
