"""Approximate nearest neighbours by inner product, from randomly rotated one-bit codes.

A vector is kept as the centroid of its cell and what remains, of which only the signs of its randomly rotated direction
are used: one bit a place. Packed bits estimate the inner product of a query with that direction; a scalar of the vector
(how well its bits point its way) corrects the estimate, and the same scalar bounds the error, except in about one case
of forty (``WIDTH`` standard deviations). A vector is reranked, by its exact inner product in double precision, unless
its upper bound lies below a score that enough vectors are known to reach.

The steps: equal vectors become one value with its ``k + 1`` smallest ids (no query's k nearest holds others). Values
are dealt to cells, of which large ones have several parts, and packed into blocks. Each query first searches the cells
whose centroids suit it best, which gives a score to reach; then every other cell that could hold a better vector (no
vector of a cell lies farther from its centroid than the cell's radius). So all rows are candidates, and all that
is left to chance is the error bound. Blocks of queries meet blocks of vectors by a join on cell and part; a task
holds one block of each.

Bounded samples: centroids are fitted on about ``SAMPLE`` values (fewer if they are long), taken by the hash of their content. All else covers
all rows. Ids are integers.

Of vectors null, zero, holding null or non-finite components, of another length than most, or without an id, none takes
part. Repeated rows count once. An id with several vectors is several rows, as candidate and as query; a query leaves
out its own row only. Ties go to the smaller id. Fewer than k candidates: all of them. Other columns are ignored,
whatever their names. No rows: no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetmart.operators.lookup import lookup
from fleetmart.session import materialize

#: Standard deviations of an estimate that its error bound spans.
WIDTH = 2.0
#: Values that centroids are fitted on, at most (about), in number and bytes, and the most cells; a cell is to have
#: PER_CELL values or more.
SAMPLE, SAMPLE_BYTES, CELLS, PER_CELL, ROUNDS = 16_384, 1 << 25, 256, 1024, 10
#: Cells that a query searches first.
FIRST = 4
#: Rows of a block of vectors and of queries, blocks of a part, and pairs that are looked at together.
VECTORS, QUERIES, PART, PAIRS = 8192, 2048, 16, 1 << 20

_RESULT = "_q long, _c long, _id long, _score double"


@dataclass(frozen=True)
class Codes:
    """What vectors are coded by. Rows of ``rotation`` are orthonormal; it turns a vector into as many bits as it has columns."""

    centroids: np.ndarray
    rotation: np.ndarray

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """The nearest centroid of each vector."""
        distance = (self.centroids**2).sum(axis=1)[None, :] - 2 * vectors @ self.centroids.T
        return distance.argmin(axis=1)

    def encode(self, vectors: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed bits, lengths of what remains beside the centroid, and how much of its direction the bits have."""
        rest = vectors - self.centroids[cells]
        length = np.sqrt((rest**2).sum(axis=1))
        turned = (rest / np.where(length > 0, length, 1)[:, None]) @ self.rotation
        share = np.abs(turned).sum(axis=1) / np.sqrt(self.rotation.shape[1])
        return np.packbits(turned > 0, axis=1), length, np.where(length > 0, share, 1.0)

    def signs(self, packed: np.ndarray) -> np.ndarray:
        bits = self.rotation.shape[1]
        return (2.0 * np.unpackbits(packed, axis=1, count=bits) - 1) / np.sqrt(bits)

    def estimate(
        self, queries: np.ndarray, cell: int, packed: np.ndarray, length: np.ndarray, share: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products (query, vector), and their error bounds as factors of query and vector."""
        bits = self.rotation.shape[1]
        scale = length / share
        estimate = (queries @ self.rotation) @ self.signs(packed).T * scale + (queries @ self.centroids[cell])[:, None]
        spread = WIDTH * scale * np.sqrt(np.maximum(0, 1 - share**2) / max(1, bits - 1))
        return estimate, spread


def fit(sample: np.ndarray, cells: int, bits: int, seed: int = 0) -> Codes:
    """Centroids by Lloyd's iteration, and a random rotation."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.permutation(len(sample))[:cells]].copy()
    for _ in range(ROUNDS):
        own = ((centroids**2).sum(axis=1)[None, :] - 2 * sample @ centroids.T).argmin(axis=1)
        count = np.bincount(own, minlength=len(centroids))
        total = np.zeros_like(centroids)
        np.add.at(total, own, sample)
        centroids = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centroids)
    return Codes(centroids, np.linalg.qr(rng.standard_normal((bits, bits)))[0][: sample.shape[1]])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _usable(rows: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, int]:
    """(_id, _content, _vector) of the rows that take part, each once, and the length of their vectors."""
    some = F.size("_vector") > 0
    sound = ~F.exists("_vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    nonzero = F.exists("_vector", lambda x: x != 0)
    picked = rows.select(F.col(id_column).cast("long").alias("_id"), F.col(vector_column).cast("array<double>").alias("_vector"))
    picked = picked.where(F.col("_id").isNotNull() & F.col("_vector").isNotNull() & some & sound & nonzero)
    lengths = picked.groupBy(F.size("_vector").alias("_length")).count().orderBy(F.desc("count"), "_length").take(1)
    width = lengths[0]["_length"] if lengths else 0
    # Negative zeros are zeros; beyond that a double's text is its own.
    key = F.md5(F.array_join(F.transform("_vector", lambda x: x + F.lit(0.0)), ","))
    keyed = picked.where(F.size("_vector") == width).withColumn("_content", key)
    return keyed.groupBy("_id", "_content").agg(F.any_value("_vector").alias("_vector")), width


def _values(rows: DataFrame, most: int) -> DataFrame:
    """(_n, _content, _vector, _ids): a row per vector, numbered, with its smallest ids."""
    nth = F.row_number().over(W.partitionBy("_content").orderBy("_id"))
    first = rows.withColumn("_nth", nth).where(F.col("_nth") <= most)
    grouped = first.groupBy("_content").agg(F.any_value("_vector").alias("_vector"), F.sort_array(F.collect_list("_id")).alias("_ids"))
    return materialize(grouped.withColumn("_n", F.monotonically_increasing_id()), "values")


def _coded(values: DataFrame, codes: Codes) -> DataFrame:
    """Every value with its cell, bits, length and share."""
    known, width = values.sparkSession.sparkContext.broadcast(codes), codes.centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(1), width)
            cells = known.value.cells(vectors)
            packed, length, share = known.value.encode(vectors, cells)
            columns = [*batch.columns, pa.array(cells, pa.int32()), pa.array([p.tobytes() for p in packed], pa.binary()), pa.array(length), pa.array(share)]
            yield pa.RecordBatch.from_arrays(columns, ["_n", "_vector", "_ids", "_cell", "_bits", "_length", "_share"])

    kinds = "_n long, _vector array<double>, _ids array<long>, _cell int, _bits binary, _length double, _share double"
    return values.select("_n", "_vector", "_ids").mapInArrow(run, kinds)


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """Rows of one cell and part packed together, up to ``most``: their columns as Arrow streams in ``_rows``."""
    dealt = rows.repartition("_cell", "_part").sortWithinPartitions("_cell", "_part")
    places = [rows.columns.index(c) for c in ("_cell", "_part")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, own = 0, None

        def block() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, whole.schema) as writer:
                writer.write_batch(whole)
            columns = [pa.array([own[0]], pa.int32()), pa.array([own[1]], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["_cell", "_part", "_rows"])

        for batch in batches:
            cell, part = (batch.column(k).to_numpy() for k in places)
            edges = np.flatnonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1])) + 1
            for start, end in zip([0, *edges], [*edges, batch.num_rows]):
                if held and (int(cell[start]), int(part[start])) != own:
                    yield block()
                    held, size = [], 0
                if end > start:
                    own = int(cell[start]), int(part[start])
                while start < end:
                    taken = min(end - start, most - size)
                    held.append(batch.slice(start, taken))
                    start, size = start + taken, size + taken
                    if size == most:
                        yield block()
                        held, size = [], 0
        if held:
            yield block()

    return dealt.mapInArrow(run, "_cell int, _part int, _rows binary")


def _opened(block: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(block).read_next_batch()


def _best(codes: Codes, cell: int, queries: np.ndarray, reach: np.ndarray, block: pa.RecordBatch, vectors: np.ndarray, most: int):
    """(query, vector, exact score) of a block's vectors that reach the query's score, each query's best ``most`` and their ties."""
    packed = np.frombuffer(b"".join(block.column("_bits").to_pylist()), np.uint8).reshape(len(vectors), -1)
    length, share = block.column("_length").to_numpy(), block.column("_share").to_numpy()
    estimate, spread = codes.estimate(queries, cell, packed, length, share)
    size = np.sqrt((queries**2).sum(axis=1))

    def exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
        step = max(1, PAIRS // vectors.shape[1])
        return np.concatenate([np.zeros(0), *((queries[q[k : k + step]] * vectors[v[k : k + step]]).sum(axis=1) for k in range(0, len(q), step))])

    if len(vectors) > most:  # the best by estimate raise the score to reach
        top = np.argpartition(estimate, -most, axis=1)[:, -most:]
        known = exact(np.repeat(np.arange(len(queries)), most), top.ravel()).reshape(-1, most)
        reach = np.fmax(reach, known.min(axis=1))
    # Not "at least": what can't be compared is reranked too.
    q, v = np.nonzero(~(estimate + size[:, None] * spread[None, :] < reach[:, None]))
    score = exact(q, v)
    good = ~(score < reach[q])
    q, v, score = q[good], v[good], score[good]
    order = np.lexsort((-score, q))
    q, v, score = q[order], v[order], score[order]
    start = np.searchsorted(q, q)  # the first place of each query
    limit = np.minimum(start + most - 1, np.searchsorted(q, q, side="right") - 1)
    kept = ~(score < score[limit]) if len(q) else np.zeros(0, bool)
    return q[kept], v[kept], score[kept]


def _search(blocks: DataFrame, asked: DataFrame, codes: Codes, most: int) -> DataFrame:
    """Scores of the queries of ``asked`` (_cell, _part, _n, _vector, _reach) with the vectors of these cells and parts that
    reach theirs; each query's best ``most``."""
    known, width = blocks.sparkSession.sparkContext.broadcast(codes), codes.centroids.shape[1]
    pairs = blocks.join(_blocks(asked, QUERIES).withColumnRenamed("_rows", "_queries"), ["_cell", "_part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                cell, rows, wanted = batch.column(0)[k].as_py(), _opened(batch.column(1)[k].as_py()), _opened(batch.column(2)[k].as_py())
                vectors, ids = _matrix(rows.column("_vector"), width), rows.column("_ids")
                numbers, names = rows.column("_n").to_numpy(), wanted.column("_n").to_numpy()
                queries, reach = _matrix(wanted.column("_vector"), width), wanted.column("_reach").to_numpy()
                step = max(1, PAIRS // rows.num_rows)
                for at in range(0, len(queries), step):
                    q, v, score = _best(known.value, cell, queries[at : at + step], reach[at : at + step], rows, vectors, most)
                    each = ids.value_lengths().to_numpy()[v]
                    columns = [np.repeat(names[at + q], each), np.repeat(numbers[v], each), ids.take(pa.array(v)).flatten(), np.repeat(score, each)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_q", "_c", "_id", "_score"])

    found = pairs.select("_cell", "_rows", "_queries").mapInArrow(run, _RESULT)
    return _leading(found, most)


def _leading(found: DataFrame, most: int) -> DataFrame:
    nth = F.row_number().over(W.partitionBy("_q").orderBy(F.desc("_score"), "_id", "_c"))
    return found.withColumn("_nth", nth).where(F.col("_nth") <= most).drop("_nth")


def _targets(asked: DataFrame, codes: Codes, radius: np.ndarray, parts: np.ndarray, first: bool) -> DataFrame:
    """The cells each query of ``asked`` (_n, _vector, _reach) is to search, part by part: the ``FIRST`` best ones, or of
    the others those with a vector that could reach its score."""
    known, width = asked.sparkSession.sparkContext.broadcast((codes.centroids, radius, parts)), codes.centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, far, split = known.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                queries = _matrix(batch.column(1), width)
                score = np.where(split > 0, queries @ centroids.T, -np.inf)
                best = np.argsort(-score, axis=1, kind="stable")[:, :FIRST]
                chosen = np.zeros(score.shape, bool)
                np.put_along_axis(chosen, best, True, axis=1)
                if not first:
                    size = np.sqrt((queries**2).sum(axis=1))
                    highest = score + size[:, None] * far[None, :] * (1 + 1e-9)
                    chosen = ~chosen & ~(highest < batch.column(2).to_numpy()[:, None])
                q, cell = np.nonzero(chosen & (split > 0))
                each = split[cell]
                part = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                rows = batch.take(pa.array(np.repeat(q, each)))
                columns = [pa.array(np.repeat(cell, each), pa.int32()), pa.array(part, pa.int32()), *rows.columns]
                yield pa.RecordBatch.from_arrays(columns, ["_cell", "_part", "_n", "_vector", "_reach"])

    return asked.select("_n", "_vector", "_reach").mapInArrow(run, "_cell int, _part int, _n long, _vector array<double>, _reach double")


def nearest(
    rows: DataFrame, asked: Callable[[Column], Column], k: int = 20, bits: int | None = None,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest rows of every row whose id is ``asked`` for: query_id, rank (from 1), id, score.

    ``bits`` of a code: the next multiple of 64 from twice a vector's length on, unless given (not below its length).
    """
    spark, most = rows.sparkSession, k + 1
    out = f"query_id long, rank int, {id_column} long, score double"
    usable, width = _usable(rows, id_column, vector_column)
    if not width:
        return spark.createDataFrame([], out)
    values = _values(usable, most)
    total = values.count()
    share = F.pmod(F.xxhash64("_content"), F.lit(1 << 32)) < int(min(1.0, SAMPLE / total, SAMPLE_BYTES / (8 * width * total)) * (1 << 32))
    # In the order of their keys, so that the fit is the same however the rows lie.
    sample = np.array([r["_vector"] for r in values.where(share).orderBy("_content").select("_vector").collect()]).reshape(-1, width)
    if not len(sample):
        sample = np.zeros((1, width))
    codes = fit(sample, max(1, min(CELLS, total // PER_CELL)), bits or -(-2 * width // 64) * 64)

    coded = materialize(_coded(values, codes), "coded")
    cells = coded.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.max("_length").alias("far")).collect()
    radius, parts = np.zeros(len(codes.centroids)), np.zeros(len(codes.centroids), np.int64)
    for r in cells:
        radius[r["_cell"]], parts[r["_cell"]] = r["far"], -(-r["n"] // (VECTORS * PART))
    split = F.element_at(F.lit(parts.tolist()), F.col("_cell") + 1)
    blocks = materialize(_blocks(coded.withColumn("_part", F.pmod(F.xxhash64("_n"), split).cast("int")), VECTORS), "blocks")

    named = usable.where(asked(F.col("_id"))).select("_id", "_content")
    queries = materialize(lookup(named, values.select("_content", "_n"), ("_content", "_content"), {"_n": "_q"}, "inner"), "queries")
    wanted = lookup(values.select("_n", "_vector"), queries.select("_q").distinct(), ("_n", "_q"), {}, "left_semi", fact_unique=True)

    near = _targets(wanted.withColumn("_reach", F.lit(float("-inf"))), codes, radius, parts, True)
    near = materialize(_search(blocks, near, codes, most), "near")
    # A score is one to reach if as many rows as are wanted have it; else all that is known is that any will do.
    scores = near.groupBy("_q").agg(F.count(F.lit(1)).alias("_n_near"), F.min("_score").alias("_least"))
    reach = F.when(F.col("_n_near") >= most, F.col("_least")).otherwise(F.lit(float("-inf")))
    known = lookup(wanted, scores.select("_q", reach.alias("_reach")), ("_n", "_q"), {"_reach": "_reach"}, "left", fact_unique=True)
    known = known.withColumn("_reach", F.coalesce("_reach", F.lit(float("-inf"))))
    far = _search(blocks, _targets(known, codes, radius, parts, False), codes, most)

    ranked = F.sort_array(F.collect_list(F.struct((-F.col("_score")).alias("s"), "_id", "_c", "_score")))
    lists = _leading(near.unionByName(far), most).groupBy("_q").agg(ranked.alias("_found"))
    lists = materialize(lists, "lists")
    own = lookup(queries, lists, ("_q", "_q"), {"_found": "_found"}, "inner")
    others = F.slice(F.filter("_found", lambda x: ~((x["_id"] == F.col("_id")) & (x["_c"] == F.col("_q")))), 1, k)
    placed = own.select(F.col("_id").alias("query_id"), F.posexplode(others).alias("_at", "_found"))
    return placed.select("query_id", (F.col("_at") + 1).alias("rank"), F.col("_found._id").alias(id_column), F.col("_found._score").alias("score"))
