"""Fill-in-the-middle transformation: texts cut at two places and put together again with the middle last.

The cuts are ranks among the units of a text: code points, or what a pattern matches (words, lines). An indexable skip
list finds where they are. Its lowest lane has a link per unit; of the nodes of a lane about one in ``1 / PROMOTED``
stands in the next, express lane too. Every link carries two widths, the units and the code points it spans. A search
starts on the highest lane, follows links while their units don't pass the rank, and goes down; the code points of the
links it took are the place of the cut, exactly. Which nodes are promoted follows from a fixed draw of their numbers, so
a repeated task builds the same list. A lane of code points has only links of width one and isn't stored.

The form and the two ranks are drawn from the SHA-256 of ``seed:id``, so they depend on the id alone, not on the order
or the partition of the rows. A text that holds a marker stays as it is, else it could not be restored.

Null and empty texts have no units and stay as they are, plain. Rows without an id are drawn as if it were empty.
Repeated rows give equal rows. Other columns are ignored, whatever their names. No rows: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.llm.frames import flushed

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
#: Of a hundred texts, those below the first number are cut; of a hundred that are cut, those below the second have the suffix first.
CUT, SUFFIX_FIRST = 90, 20
#: Shares of the nodes of a lane that stand in the next one, and links of a lane that need no further lane above.
PROMOTED, FEW = 1 / 8, 8

_BLOCK = 1 << 16


def _draws(count: int) -> np.ndarray:
    """The numbers below ``count`` that are promoted; the head always is."""
    mixed = np.arange(count, dtype=np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed + np.uint64(0x9E3779B97F4A7C15) ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    chosen = (mixed >> np.uint64(40)) < np.uint64(PROMOTED * (1 << 24))
    chosen[0] = True
    return np.flatnonzero(chosen)


_PROMOTED = _draws(_BLOCK)


def promoted(count: int) -> np.ndarray:
    """The nodes of a lane of ``count`` links that stand in the next lane; the draw repeats every block."""
    if count <= _BLOCK:
        return _PROMOTED[: np.searchsorted(_PROMOTED, count)]
    starts = np.arange(0, count, _BLOCK)
    nodes = (starts[:, None] + _PROMOTED[None, :]).ravel()
    return nodes[: np.searchsorted(nodes, count)]


class SkipList:
    """The units of a text by rank. ``widths`` are their code points; a number stands for so many of width one."""

    def __init__(self, widths: np.ndarray | int):
        whole = isinstance(widths, int)
        self.size = widths if whole else len(widths)
        units, points = (None, None) if whole else (np.ones(self.size, np.int64), np.asarray(widths, np.int64))
        # (units, code points, node below) of every link, from the lowest lane up.
        self.lanes: list[tuple[np.ndarray | None, np.ndarray | None, np.ndarray | None]] = []
        below, count = None, self.size
        while True:
            self.lanes.append((units, points, below))
            if count <= FEW:
                return
            below = promoted(count)
            if units is None:
                units = np.diff(below, append=count)
                points = units
            else:
                units, points = np.add.reduceat(units, below), np.add.reduceat(points, below)
            count = len(below)

    def find(self, rank: int) -> int:
        """The code points before unit ``rank``; ``rank`` may be the number of units."""
        node = units = points = 0
        for wide, long, below in reversed(self.lanes):
            if wide is None:  # links of width one
                return points + rank - units
            while node < len(wide) and units + wide[node] <= rank:
                units += int(wide[node])
                points += int(long[node])
                node += 1
            if node == len(wide):  # the end of the lane is the end of the text
                return points
            if below is not None:
                node = int(below[node])
        return points


def unit_widths(text: str, unit: regex.Pattern | None) -> np.ndarray | int:
    """The code points of each unit. A unit reaches to where the next match begins, the first one from the start."""
    if unit is None:
        return len(text)
    starts = [m.start() for m in unit.finditer(text) if m.end() > m.start()]
    if not starts:
        return np.array([len(text)] if text else [], np.int64)
    starts[0] = 0
    return np.diff(np.array(starts, np.int64), append=len(text))


def draws(seed: int, name: object) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if name is None else name}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def rearranged(text: str, drawn: list[int], unit: regex.Pattern | None = None) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of the prefix, of the middle, output)"""
    widths = unit_widths(text, unit)
    n = widths if isinstance(widths, int) else len(widths)
    if not text or drawn[2] % 100 >= CUT or any(m in text for m in MARKERS):
        return n, "plain", None, None, text
    units = SkipList(widths)
    first, last = (units.find(k) for k in sorted((drawn[0] % (n + 1), drawn[1] % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    if drawn[3] % 100 < SUFFIX_FIRST:
        return n, "spm", first, last - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, last - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(
    docs: DataFrame, seed: int = 1, unit: str | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Columns: id, n (units), form (plain, psm or spm), prefix_chars, middle_chars, output.

    ``unit`` is the pattern of a unit, matched left to right; None stands for code points.
    """
    schema = T.StructType(
        [
            T.StructField(id_column, docs.schema[id_column].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("form", T.StringType()),
            T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()),
            T.StructField("output", T.StringType()),
        ]
    )
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = None if unit is None else regex.compile(unit)

        def rows(batch: pa.RecordBatch):
            for k, text in enumerate(batch.column(2)):
                out = rearranged(text.as_py() or "", draws(seed, batch.column(1)[k].as_py()), pattern)
                yield len(out[4]), out

        for batch in batches:
            for ids, columns in flushed(batch.column(0), rows(batch)):
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(columns, kinds))], schema.names)

    return docs.select(id_column, F.col(id_column).cast("string").alias("_name"), text_column).mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that was cut, from the output and its form alone. No part of a cut text holds a marker."""
    parts = F.split(output, "|".join(MARKERS), -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
