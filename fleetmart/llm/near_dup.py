"""SimHash near-duplicates: fingerprints of word shingles, linked at a few differing bits.

Links are found in a segment-popcount embedding. The 64 bits make 32 segments of two; a fingerprint becomes its 32 bit
counts (0 to 2). The Manhattan distance of two such points is a lower bound of the Hamming distance, so all links lie
within Manhattan distance ``bits``. The range join is a grid over projections: with the segments dealt to g groups, a
distance of at most ``bits`` touches at most ``bits`` groups, so two such points agree in at least g - ``bits`` of
them. A cell is a choice of g - ``bits`` groups with its counts; points meet in a cell, are held against the Manhattan
bound there, and then against the bits themselves. A count of two bits is written in unary (00, 01, 11), so that the
Manhattan distance is the number of differing bits of two such words. More points take more groups, that is smaller
cells; every choice finds the same links.

Copies of one fingerprint are one point. A cell beyond ``CELL`` points is cut into blocks and its pairs of blocks go
to tasks of their own. A task says which points of its cell hang together (a row per point at most, not the pairs).

Null and empty texts have fingerprint zero, linked like any other. A row without an id is linked but lends no id:
component_id is null if no row of the group has one. Repeated rows are links like any other and stay in the result.
Other columns are ignored, whatever their names. No rows: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.llm.components import components
from fleetmart.llm.frames import fresh
from fleetmart.session import materialize

SHINGLE, BITS, SEED = 4, 4, 42

#: Most points of a cell that one task takes at a time; most large cells that are sent to all tasks.
CELL, LARGE_CELLS = 1024, 200_000
#: Points of uniform fingerprints expected in a cell, at most, when the number of groups is chosen.
POINTS_PER_CELL = 16
#: Rows taken together by a task, and shingles counted together.
ROWS, SLAB = 1 << 16, 1 << 15

_LOW = 0x5555555555555555


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bits set in over half the hashes of the text's word shingles, as a signed number."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # ASCII letters and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    last = min(shingle, len(words)) - 1
    begin, end = starts[: len(words) - last].tolist(), (ends[last:] - 1).tolist()
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(begin), SLAB):
        hashes = [xxh64_intdigest(line[a:b], SEED) for a, b in zip(begin[at : at + SLAB], end[at : at + SLAB], strict=True)]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(begin), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text", carried: tuple[str, ...] = ()) -> DataFrame:
    """(id, fp) of every row, and the ``carried`` columns."""
    schema = T.StructType([docs.schema[id_column], T.StructField("fp", T.LongType()), *[docs.schema[c] for c in carried]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64()), *batch.columns[2:]], schema.names)

    return docs.select(id_column, text_column, *carried).mapInArrow(run, schema)


def groups_for(points: int, bits: int) -> int:
    """How many groups of segments keep the cells of uniform fingerprints small."""
    for groups in range(bits + 2, bits + 7):
        # Two random pairs of bits have the same count with probability 3/8.
        if points * (3 / 8) ** (32 * (groups - bits) / groups) <= POINTS_PER_CELL:
            break
    return groups


def projections(groups: int, bits: int) -> list[int]:
    """Masks over the unary counts: all choices of groups - bits groups of segments."""
    own = [sum(3 << 2 * s for s in range(32) if s * groups // 32 == g) for g in range(groups)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(sum(chosen)) for chosen in combinations(own, groups - bits)]


def _roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For ``count`` points with links a-b, the first point of each one's component."""
    root = np.arange(count)
    while len(a):
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        while (root[root] != root).any():
            root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def _near(x: np.ndarray, y: np.ndarray, ux: np.ndarray, uy: np.ndarray, bits: int) -> np.ndarray:
    """Manhattan distance of the counts first, then the bits."""
    close = np.bitwise_count(ux ^ uy) <= bits
    close[close] = np.bitwise_count(x[close] ^ y[close]) <= bits
    return close


def _unary(x: np.ndarray) -> np.ndarray:
    low, half = np.uint64(_LOW), x >> np.uint64(1)
    return ((x | half) & low) | ((x & half & low) << np.uint64(1))


def link_cells(cell: np.ndarray, side: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold the near points of each cell together; rows of a cell are neighbours.

    side: 0 for points met by all of their cell; 1 and 2 meet only each other.
    """
    x = fp.view(np.uint64)
    u = _unary(x)
    bounds = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1], [True])))
    sizes = np.diff(bounds)
    large = np.repeat(sizes > 64, sizes)
    found_a, found_b = [], []
    # Small cells all at once: each point with the next, the one after, …
    small = np.flatnonzero(~large)
    for step in range(1, 64):
        if len(small) <= step:
            break
        a, b = small[:-step], small[step:]
        same = cell[a] == cell[b]
        if not same.any():
            break
        a, b = a[same], b[same]
        apart = (side[a] != side[b]) | (side[a] == 0)
        a, b = a[apart], b[apart]
        close = _near(x[a], x[b], u[a], u[b], bits)
        found_a.append(a[close])
        found_b.append(b[close])
    # Large ones point by point, against those not yet reached only.
    for first, size in zip(bounds[:-1][sizes > 64], sizes[sizes > 64], strict=True):
        rest = np.arange(first, first + size)
        while len(rest):
            front, rest = [rest[0]], rest[1:]
            while front and len(rest):
                p = front.pop()
                close = _near(x[rest], np.broadcast_to(x[p], rest.shape), u[rest], np.broadcast_to(u[p], rest.shape), bits)
                if side[p]:
                    close &= side[rest] != side[p]
                reached, rest = rest[close], rest[~close]
                found_a.append(np.full(len(reached), p))
                found_b.append(reached)
                front.extend(reached)
    if not found_a:
        return fp[:0], fp[:0]
    root = _roots(len(fp), np.concatenate(found_a), np.concatenate(found_b))
    linked = np.flatnonzero(root != np.arange(len(fp)))
    return fp[root[linked]], fp[linked]


def links(points: DataFrame, bits: int = BITS, cell_size: int = CELL, groups: int | None = None) -> DataFrame:
    """Pairs (a, b) of different fingerprints ``fp`` that connect all that are within ``bits`` bits of each other.

    Each pair is a link, and every link's ends are connected by pairs; not every link is a pair.
    """
    masks = projections(groups or groups_for(points.count(), bits), bits)
    half = F.shiftrightunsigned("fp", 1)
    unary = F.col("fp").bitwiseOR(half).bitwiseAND(F.lit(_LOW)).bitwiseOR(
        F.shiftleft(F.col("fp").bitwiseAND(half).bitwiseAND(F.lit(_LOW)), 1)
    )
    cells = points.select("fp", unary.alias("u")).select(
        "fp", F.explode(F.array(*[F.xxhash64(F.lit(k), F.col("u").bitwiseAND(F.lit(m))) for k, m in enumerate(masks)])).alias("cell")
    )
    large = materialize(
        cells.groupBy("cell").count().where(F.col("count") > cell_size).select("cell", F.ceil(F.col("count") / cell_size).cast("int").alias("blocks")),
        "large_cells",
    )
    few = large.count() <= LARGE_CELLS
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    blocked = cells.join(F.broadcast(large) if few else large, "cell", "left").withColumn("block", F.when(F.col("blocks") > 1, block))
    # A point of block b meets block k in the pair (least, greatest); alone in its cell it has no block.
    meets = F.when(F.col("block").isNull(), F.array(F.lit(None).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = blocked.select("cell", "fp", "block", F.explode(meets).alias("other"))
    pair = F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other"))
    side = F.when(F.col("block").isNull() | (F.col("block") == F.col("other")), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    rows = met.select(F.when(F.col("block").isNull(), F.col("cell")).otherwise(pair).alias("cell"), side.cast("int").alias("side"), "fp")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(cell, side, fp):
            a, b = link_cells(cell, side, fp, bits)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema.names)

        held: list[list[np.ndarray]] = []
        waiting = 0
        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            waiting += batch.num_rows
            if waiting < ROWS:
                continue
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            cut = int(np.searchsorted(columns[0], columns[0][-1]))  # the last cell may go on
            if cut:
                yield emit(*[c[:cut] for c in columns])
            held, waiting = [[c[cut:] for c in columns]], len(columns[0]) - cut
        if waiting:
            yield emit(*[np.concatenate(c) for c in zip(*held, strict=True)])

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, schema).distinct()


def _rooted(points: DataFrame, bits: int) -> DataFrame:
    """``points`` with the ``root`` of each fingerprint's component; one without a link is its own root."""
    reached = components(links(points, bits)).toDF("fp", "root")
    return points.join(reached, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, fp, component_id) of every row: its fingerprint and the smallest id reachable over links."""
    prints = materialize(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    points = materialize(prints.groupBy("fp").agg(F.min(id_column).alias("first")), "points")
    rooted = _rooted(points, bits)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(rooted.join(least, "root").select("fp", "component_id"), "named")
    return prints.join(named, "fp").select(id_column, "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each group: one with the smallest id, or without an id if none of the group's rows has one.

    Decided by row: rows that repeat an id in different groups are different texts, and one of each group stays. Of rows
    with the same id in one group, or of several without an id, the one with the least hash of the text stays.
    """
    row, mark = fresh(docs, "row"), fresh(docs, "mark")
    numbered = materialize(docs.withColumns({row: F.monotonically_increasing_id(), mark: F.xxhash64(text_column)}), "numbered")
    prints = materialize(fingerprints(numbered, shingle, id_column, text_column, (mark, row)), "fingerprints")
    first = F.struct(F.isnull(id_column).alias("nameless"), F.col(id_column).alias("id"), F.col(mark).alias("mark"), F.col(row).alias("row"))
    points = materialize(prints.groupBy("fp").agg(F.min(first).alias("first")), "points")
    stays = _rooted(points, bits).groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return numbered.join(stays, row, "left_semi").select(*docs.columns)
