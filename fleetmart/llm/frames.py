"""Small helpers over data frames."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def flushed(ids: pa.Array, rows: Iterable[tuple[int, tuple]], most: int = 16_000_000) -> Iterator[tuple[pa.Array, list[list]]]:
    """Rows (size, values), one per id, as columns of parts that hold about ``most`` in size: so no batch gets much
    larger than the largest row."""
    start = size = 0
    part: list[tuple] = []
    for weight, values in rows:
        part.append(values)
        size += weight
        if size >= most:
            yield ids.slice(start, len(part)), [list(c) for c in zip(*part)]
            start, size, part = start + len(part), 0, []
    if part:
        yield ids.slice(start, len(part)), [list(c) for c in zip(*part)]
