"""Totals over a tree of months: quarters, years, four and sixteen years.

Counts, sums, least and greatest values of a span are those of its parts put
together, but a part can't be taken out again (a least value can't be undone).
So every span keeps its own rows. A month that changes makes one path of the
tree anew, each span from its few parts, and a report puts together the topmost
spans, one for every sixteen years: it costs the same whatever the history.
What only comes to a month goes up the same path as further rows, which add up
with those that are there: it costs what has come, not what the months hold.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.contracts import Table
from fleetmart.sources.warehouse import Warehouse, partition_of

# Letter of a span and the years it covers; quarters lie below.
YEARS = (("y", 1), ("f", 4), ("s", 16))
TOP = YEARS[-1][0]
# What isn't a month (rows without a time) is a span of the top by itself.
OTHER = f"{TOP}other"
# Most folders a span may have before it is made anew as one.
MOST_FOLDERS = 32


def above(part: str) -> str | None:
    """The span that a month or a span is a part of: 2026-05, q2026-2, y2026, f2024, s2016."""
    if month := re.fullmatch(r"(\d+)-(\d\d)", part):
        return f"q{month[1]}-{(int(month[2]) + 2) // 3}"
    if quarter := re.fullmatch(r"q(\d+)-\d", part):
        return f"y{int(quarter[1])}"
    if part.startswith(TOP):
        return None
    for (letter, _), (wider, years) in zip(YEARS, YEARS[1:]):
        if part.startswith(letter):
            return f"{wider}{int(part[1:]) // years * years}"
    return OTHER


def update(warehouse: Warehouse, months: Table, spans: Table, add: Callable[..., DataFrame]) -> DataFrame:
    """The totals of all months, after bringing the spans of changed months up to date.

    ``add`` puts rows of totals together, per key and further columns. Which
    months have changed follows from the folders that the spans were built from.
    Spans with a part that has lost a folder, or with too many folders of their
    own, are made anew; to the others come the totals of their parts' new folders.
    """
    if not warehouse.has(spans.name):
        warehouse.create(spans.name)
    now, built = (set(x) for x in (warehouse.pointer(months.name).folders, warehouse.pointer(spans.name).built_from))
    source, gone, new = months, built - now, now - built
    while touched := {above(partition_of(f)) for f in gone | new} - {None}:
        before = warehouse.pointer(spans.name).folders
        many = {s for s, n in Counter(map(partition_of, before)).items() if n >= MOST_FOLDERS}
        anew = touched & ({above(partition_of(f)) for f in gone} | many)
        present = [(f, above(partition_of(f))) for f in warehouse.pointer(source.name).folders]
        folders = [f for f, span in present if span in anew or (f in new and span in touched)]
        parts = {p: above(p) for p in map(partition_of, folders)}
        rows = warehouse.read(source.name, folders=folders)
        # A few parts per span: the map is as long as the path is wide.
        names = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair]) if parts else F.lit(None).cast("map<string,string>")
        rows = rows.withColumn("_span", names[F.col(source.partition_by)]).drop(source.partition_by).withColumnRenamed("_span", spans.partition_by)
        warehouse.replace_partitions(spans.name, add(rows, spans.partition_by), sorted(anew), built_from=sorted(now), add_others=True)
        after = warehouse.pointer(spans.name).folders
        source, gone, new = spans, set(before) - set(after), set(after) - set(before)
    return add(warehouse.read(spans.name, tops(warehouse, spans)))


def tops(warehouse: Warehouse, spans: Table) -> list[str]:
    return sorted({s for s in map(partition_of, warehouse.pointer(spans.name).folders) if above(s) is None})
