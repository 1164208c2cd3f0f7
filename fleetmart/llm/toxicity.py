"""Toxicity by a linear classifier of character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the character n-grams of its lower-cased words (with a space before and after), hashed into
buckets, each present or not. A bucket's ratio is the logarithm of how much more often it is present in toxic texts of
the training sample than in others, smoothed by one. Buckets whose ratio says little are left out; a logistic
regression is fitted on the others' ratios. The score is its probability.

The sample is bounded in ids (about ``PER_LABEL`` of each label, by the hash of the id); a text that repeats under its id
and label counts once. The driver takes the sample's buckets if they are at most ``SENT_BYTES``; otherwise they stay
where they are and each round of the fit sums its gradient in tasks. If the sample lacks a label, every score is 0. Null and empty texts have no feature and get the score of the bias. Labels other
than 0 and 1, rows without an id and null labels teach nothing; a row with both labels teaches both. Repeated rows are
scored alike. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.llm.labelled import held_out, sample
from fleetmart.session import materialize

#: Lengths of the n-grams and number of buckets.
SHORTEST, LONGEST_GRAM, BUCKETS = 2, 5, 1 << 18
#: Training rows of each label, about: a bounded sample, by the hash of the id.
PER_LABEL = 20_000
#: Least training texts that have a bucket, and its least absolute ratio; most buckets kept.
LEAST_TEXTS, LEAST_RATIO, MOST_KEPT = 4, 1.0, 40_000
#: Weight of the squared length of the coefficients; the fit ends where the slope is this share of the first one, and
#: fails if that takes more passes over the sample than this.
RIDGE, TOLERANCE, MOST_LOOKS = 0.1, 1e-4, 5000
#: Most bytes of the sample's buckets that the driver takes.
SENT_BYTES = 128 << 20

#: Characters taken together.
SLAB = 1 << 20

_STEP, _MIX = np.uint32(0x01000193), np.uint32(0x9E3779B1)


@lru_cache(maxsize=1)
def _present() -> np.ndarray:
    return np.zeros(BUCKETS, dtype=bool)


def features(text: str | None) -> np.ndarray:
    """The buckets present in a text, in order."""
    codes = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le"), dtype="<u4")
    codes = np.where(codes < 32, np.uint32(32), codes)
    present = _present()
    for at in range(0, len(codes), SLAB):
        part = codes[at : at + SLAB + LONGEST_GRAM - 1]
        spaces = np.concatenate(([0], np.cumsum(part == 32, dtype=np.int32)))
        value = part
        for n in range(2, LONGEST_GRAM + 1):
            if n > len(part):
                break
            value = value[:-1] * _STEP + part[n - 1 :]
            if n >= SHORTEST:
                # Only n-grams within a word and the spaces beside it.
                inside = spaces[n - 1 : -1] == spaces[1 : len(spaces) - n + 1] if n > 2 else part[1:] != part[:-1]
                present[((value ^ (value >> np.uint32(15))) * _MIX >> np.uint32(32 - 18))[inside]] = True
    found = np.flatnonzero(present)
    present[found] = False
    return found


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # by bucket: coefficient times ratio
    bias: float

    def score(self, text: str | None) -> float:
        z = self.bias + float(self.weights[features(text)].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def _losses(z: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """The sum of the losses, and how far off each probability is."""
    return float(np.logaddexp(0, np.where(y > 0, -z, z)).sum()), 1 / (1 + np.exp(-np.clip(z, -50, 50))) - y


def _direction(slope: np.ndarray, steps: list[np.ndarray], turns: list[np.ndarray]) -> np.ndarray:
    """Where to go from here: the slope, bent by the last steps and what they did to it."""
    way, shares = slope.copy(), []
    for step, turn in zip(reversed(steps), reversed(turns)):
        shares.append((step @ way) / (step @ turn))
        way -= shares[-1] * turn
    if steps:
        way *= (steps[-1] @ turns[-1]) / (turns[-1] @ turns[-1])
    for step, turn, share in zip(steps, turns, reversed(shares)):
        way += (share - (turn @ way) / (step @ turn)) * step
    return -way


def descend(values: np.ndarray, n: int, at: Callable) -> tuple[np.ndarray, float]:
    """Quasi-Newton steps until the slope is ``TOLERANCE`` of the first; ``at`` says for weights by column and a bias the
    summed loss, offs, and offs by column."""

    def look(x: np.ndarray) -> tuple[float, np.ndarray]:
        total, off, by_column = at(x[:-1] * values, x[-1])
        return total / n + RIDGE / n * (x[:-1] @ x[:-1]) / 2, np.append(by_column / n * values + RIDGE / n * x[:-1], off / n)

    x = np.zeros(len(values) + 1)
    loss, slope = look(x)
    enough, steps, turns, looks = TOLERANCE * np.linalg.norm(slope), [], [], 1
    while np.linalg.norm(slope) > enough:
        way = _direction(slope, steps, turns)
        length = 1.0 if steps else min(1.0, 1 / np.linalg.norm(slope))
        while True:
            if looks == MOST_LOOKS:
                raise RuntimeError(f"the fit has not converged in {MOST_LOOKS} passes over the sample")
            new = x + length * way
            new_loss, new_slope = look(new)
            looks += 1
            if new_loss <= loss + 1e-4 * length * (slope @ way) or length < 1e-12:
                break
            length /= 2
        step, turn = new - x, new_slope - slope
        if length < 1e-12:  # as low as numbers go
            break
        if step @ turn > 1e-12 * (turn @ turn):
            steps, turns = [*steps[-9:], step], [*turns[-9:], turn]
        x, loss, slope = new, new_loss, new_slope
    return x[:-1] * values, float(x[-1])


def fit(values: np.ndarray, row: np.ndarray, column: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge-penalised logistic regression; values by column, present at (row, column)."""

    def at(weights: np.ndarray, bias: float) -> tuple[float, float, np.ndarray]:
        total, off = _losses(bias + np.bincount(row, weights=weights[column], minlength=len(y)), y)
        return total, float(off.sum()), np.bincount(column, weights=off[row], minlength=len(values))

    return descend(values, len(y), at)


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, y) of a batch of labels and packed columns."""
    packed = batch.column(1).to_pylist()
    column = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int64)
    return np.repeat(np.arange(len(packed)), [len(p) // 4 for p in packed]), column, batch.column(0).to_numpy().astype(float)


def fit_in_tasks(values: np.ndarray, stored: DataFrame) -> tuple[np.ndarray, float]:
    """The same over ``stored`` rows (y, at) that are too many for the driver: tasks send sums."""
    k = len(values)

    def summed(batches_to_sums: Callable) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = sum((batches_to_sums(*_unpacked(b)) for b in batches), np.zeros(k + 2))
            place = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place])], ["place", "total"])

        found = np.zeros(k + 2)
        for r in stored.select("y", "at").mapInArrow(run, "place long, total double").groupBy("place").agg(F.sum("total")).collect():
            found[r[0]] = r[1]
        return found

    rows = stored.count()

    def at(weights: np.ndarray, bias: float) -> tuple[float, float, np.ndarray]:
        sent = stored.sparkSession.sparkContext.broadcast((weights, bias))

        def sums(row, column, y):
            weights, bias = sent.value
            total, off = _losses(bias + np.bincount(row, weights=weights[column], minlength=len(y)), y)
            return np.append(np.bincount(column, weights=off[row], minlength=k), [total, off.sum()])

        found = summed(sums)
        sent.unpersist()
        return found[k], found[k + 1], found[:k]

    return descend(values, rows, at)


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_column: str = "doc_id", text_column: str = "text", per_label: int = PER_LABEL
) -> Model:
    """A model from a bounded sample of the labelled rows that aren't held out."""
    known = labels.select(id_column, F.col(label).cast("int").alias("_y")).where(F.col("_y").isin(0, 1))
    chosen = sample(known, "_y", id_column, per_label)
    # The repeats of a text under its id and label go within tasks first, by hashes, so a hot id sends a row per task.
    named = docs.select(id_column, F.col(text_column).alias("_text")).join(F.broadcast(chosen), id_column).select(id_column, "_y", "_text")
    hashes = [F.xxhash64("_text").alias("_p"), F.xxhash64(F.lit(1), "_text").alias("_q")]
    once = named.groupBy(id_column, "_y", *hashes).agg(F.first("_text").alias("_text"))
    texts = materialize(once.select(id_column, "_y", "_text"), "training")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, rows = np.zeros((2, BUCKETS), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for batch in batches:
            for y, text in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                present[y, features(text.as_py())] += 1
                rows[y] += 1
        bucket = np.flatnonzero(present.any(axis=0))
        columns = [np.append(bucket, -1), np.append(present[0, bucket], rows[0]), np.append(present[1, bucket], rows[1])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "clean", "toxic"])

    seen = texts.mapInArrow(count, "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean"), F.sum("toxic"))
    table = np.array([tuple(r) for r in seen.where(f"sum(clean) + sum(toxic) >= {LEAST_TEXTS} or bucket < 0").collect()], dtype=np.int64).reshape(-1, 3)
    rows = table[table[:, 0] < 0, 1:].sum(axis=0)
    table = table[table[:, 0] >= 0]
    weights = np.zeros(BUCKETS)
    if not rows.all() or not len(table):
        return Model(weights, 0.0 if rows[1] > 0 == rows[0] else -50.0)
    share = np.log(table[:, 1:] + 1.0) - np.log(rows + 2.0)
    ratio = share[:, 1] - share[:, 0]
    keep = np.argsort(-np.abs(ratio), kind="stable")[:MOST_KEPT]
    keep = np.sort(keep[np.abs(ratio[keep]) >= LEAST_RATIO])
    order = np.argsort(table[keep, 0])
    bucket, ratio = table[keep, 0][order], ratio[keep][order]

    def strong(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(BUCKETS, -1, dtype=np.int64)
        place[bucket] = np.arange(len(bucket))
        for batch in batches:
            own = []
            for text in batch.column(2):
                at = place[features(text.as_py())]
                own.append(at[at >= 0].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.binary())], schema.names)

    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType), T.StructField("y", T.IntegerType()), T.StructField("at", T.BinaryType())])
    stored = materialize(texts.mapInArrow(strong, schema), "buckets")
    # 64 for what a row takes besides.
    if stored.agg(F.sum(F.length("at") + 64)).first()[0] > SENT_BYTES:
        weights[bucket], bias = fit_in_tasks(ratio, stored)
        return Model(weights, bias)
    picked = sorted(((r["id"], r["y"], bytes(r["at"])) for r in stored.collect()))
    column = np.frombuffer(b"".join(at for _, _, at in picked), dtype="<u4").astype(np.int64)
    row = np.repeat(np.arange(len(picked)), [len(at) // 4 for _, _, at in picked])
    weights[bucket], bias = fit(ratio, row, column, np.array([float(y) for _, y, _ in picked]))
    return Model(weights, bias)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[id_column], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.score(t.as_py()) for t in batch.column(1)], pa.float64())], schema.names)

    return docs.select(id_column, text_column).mapInArrow(run, schema)


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            yield batch.filter(pa.array([own.score(t.as_py()) < threshold for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Learn from ``labels`` and score all of ``docs``: (id, held_out, score, predicted)."""
    scored = score(docs, train(docs, labels, id_column=id_column, text_column=text_column), id_column, text_column)
    return scored.select(id_column, held_out(id_column).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
