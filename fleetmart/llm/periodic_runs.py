"""Periodic runs of words: stretches that repeat themselves, and texts with the repetitions taken out.

A run is a stretch of words with smallest period q (words q apart are identical), as long as no neighbouring word
extends it, at least ``exponent`` periods and ``shortest`` words long.

Such a stretch with period p has ``max(shortest, exponent * p) - p`` neighbouring places where a word equals the one p
further on, so the multiples of that number (a grid for every p, a harmonic sum in all) meet one of them. Where a grid
place has equal words, the longest common extensions forward and backward give the whole stretch with that period. They
come from suffixes sorted only where a difference cover samples them: for any two places some number of steps below the
modulus reaches samples in both, so a question compares these few words and then looks up the least common prefix
between two sorted samples, by a table of minima. Stretches with equal ends are one run, with the least of their periods.

Several documents are searched at once, as one sequence with a separator of its own between any two, in parts of about
``MOST_WORDS`` words; a larger document is a part by itself, whole. Sorting is by doubling, so periodic texts need
n log n steps as others do.

Null and empty texts have no words and no runs. Rows without an id and repeated rows are searched like any other, each by
itself. Other columns are ignored, whatever their names. No rows: no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetmart.llm.frames import flushed

EXPONENT, SHORTEST = 4, 6
#: Any two places reach sampled ones within MODULUS steps: every difference of places is one of samples.
MODULUS, COVER = 13, (0, 1, 3, 9)
#: Words of documents that are searched at once, and grid places looked at at once.
MOST_WORDS, MOST_PLACES = 200_000, 1_000_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BLOCK = 16

_SLOT = np.full(MODULUS, -1)
_SLOT[list(COVER)] = range(len(COVER))
#: Steps from places of these remainders to the next two that are both sampled.
_STEPS = np.array([[next(d for d in range(MODULUS) if _SLOT[(i + d) % MODULUS] >= 0 and _SLOT[(j + d) % MODULUS] >= 0) for j in range(MODULUS)] for i in range(MODULUS)])


class Minima:
    """Least value between two places: within blocks by running minima, over blocks by a sparse table."""

    def __init__(self, values: np.ndarray):
        size = -(-max(1, len(values)) // _BLOCK) * _BLOCK
        rows = np.full(size, np.iinfo(np.int32).max, np.int32)
        rows[: len(values)] = values
        rows = rows.reshape(-1, _BLOCK)
        self.values = rows.ravel()
        self.up_to = np.minimum.accumulate(rows, axis=1).ravel()
        self.from_ = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [rows.min(axis=1)]
        step = 1
        while 2 * step <= len(self.table[0]):
            last = self.table[-1]
            self.table.append(np.minimum(last[: len(last) - step], last[step:]))
            step *= 2
        self.levels = np.zeros(len(self.table[0]) + 1, np.int64)
        for k in range(1, len(self.table)):
            self.levels[1 << k :] = k

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima over first..last, both included."""
        left, right = first // _BLOCK, last // _BLOCK
        least = np.minimum(self.from_[first], self.up_to[last])
        wide = np.flatnonzero(right - left > 1)
        level = self.levels[right[wide] - left[wide] - 1]
        for k in np.unique(level):
            at = wide[level == k]
            row = self.table[k]
            least[at] = np.minimum(least[at], np.minimum(row[left[at] + 1], row[right[at] - (1 << int(k))]))
        near = np.flatnonzero(left == right)
        if len(near):
            place, end = first[near], last[near]
            found = self.values[place]
            for _ in range(_BLOCK - 1):
                place = np.minimum(place + 1, end)
                found = np.minimum(found, self.values[place])
            least[near] = found
        return least


class Extensions:
    """Longest common extensions in a sequence whose last value occurs once; values are 0 to ``top``."""

    def __init__(self, values: np.ndarray, top: int, longest: int):
        self.size, each = len(values), len(COVER)
        padded = np.concatenate([values, np.zeros(MODULUS, np.int64)])
        self.values = padded
        base = np.arange(0, self.size, MODULUS)
        place = (base[:, None] + np.array(COVER)[None, :]).ravel()
        place = place[place < self.size]
        self.rank = self._sort(padded, place, top, longest, each)

    def _sort(self, padded: np.ndarray, place: np.ndarray, top: int, longest: int, each: int) -> np.ndarray:
        count, bits = len(place), int(top + 1).bit_length()
        packed = max(1, 63 // bits)
        order, rank = np.arange(count), np.zeros(count, np.int64)
        tied = np.arange(count)

        def refine(key: np.ndarray) -> None:
            """Samples of equal rank ordered by a further key; a rank is the place of the first of its equals."""
            nonlocal tied
            members = order[tied]
            by = np.lexsort((key[members], rank[members]))
            members = members[by]
            order[tied] = members
            above, keys = rank[members], key[members]
            head = np.ones(len(members), bool)
            head[1:] = (above[1:] != above[:-1]) | (keys[1:] != keys[:-1])
            rank[members] = np.maximum.accumulate(np.where(head, tied, 0))
            alone = head.copy()
            alone[:-1] &= head[1:]
            tied = tied[~alone]

        for start in range(0, MODULUS, packed):
            if len(tied):
                key = np.zeros(count, np.int64)
                for k in range(start, min(start + packed, MODULUS)):
                    key = (key << bits) | (padded[place + k] + 1)
                refine(key)
        levels, step = [rank.copy()], 1
        while len(tied) and MODULUS * step <= longest:
            further = np.full(count, -1, np.int64)
            further[: max(0, count - each * step)] = rank[each * step :]
            refine(further)
            levels.append(rank.copy())
            step *= 2
        self.common = Minima(self._prefixes(padded, place, order, levels, each))
        return rank

    @staticmethod
    def _prefixes(padded: np.ndarray, place: np.ndarray, order: np.ndarray, levels: list[np.ndarray], each: int) -> np.ndarray:
        """How many values sorted neighbours have in common."""
        one, other, count = order[:-1].copy(), order[1:].copy(), len(order)
        common = np.zeros(len(one), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            inside = (one < count) & (other < count)
            equal = np.zeros(len(one), bool)
            equal[inside] = levels[k][one[inside]] == levels[k][other[inside]]
            one[equal] += each << k
            other[equal] += each << k
            common[equal] += MODULUS << k
        first, second = place[order[:-1]] + common, place[order[1:]] + common
        left = np.arange(len(first))
        for step in range(MODULUS):
            left = left[padded[first[left] + step] == padded[second[left] + step]]
            common[left] += 1
        return common

    def of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Equal values from two different places on, pair by pair."""
        steps = _STEPS[first % MODULUS, second % MODULUS]
        common = steps.copy()
        left = np.arange(len(first))
        for step in range(MODULUS):
            left = left[steps[left] > step]
            if not len(left):
                break
            equal = self.values[first[left] + step] == self.values[second[left] + step]
            common[left[~equal]] = step
            steps[left[~equal]] = -1
            left = left[equal]
        left = np.flatnonzero(steps >= 0)
        one, other = (self.rank[self._sample(x[left] + steps[left])] for x in (first, second))
        common[left] += self.common.between(np.minimum(one, other), np.maximum(one, other) - 1)
        return common

    @staticmethod
    def _sample(place: np.ndarray) -> np.ndarray:
        return place // MODULUS * len(COVER) + _SLOT[place % MODULUS]


def _grids(sizes: np.ndarray, exponent: int, shortest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, period, place in it) of all grids, about ``MOST_PLACES`` at a time."""
    periods = np.where(sizes >= shortest, sizes // exponent, 0)
    document = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(document)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    stride = np.maximum(shortest, exponent * period) - period
    places = (sizes[document] - 1 - period) // stride + 1
    before = np.concatenate([[0], np.cumsum(places)])
    start = 0
    while start < len(places):
        end = max(start + 1, int(np.searchsorted(before, before[start] + MOST_PLACES, side="right")) - 1)
        of = np.repeat(np.arange(start, end), places[start:end])
        nth = np.arange(len(of)) - (before[of] - before[start])
        yield document[of], period[of], nth * stride[of]
        start = end


def find_runs(documents: list[np.ndarray], exponent: int = EXPONENT, shortest: int = SHORTEST) -> np.ndarray:
    """Rows (document, start, length, period) by document, start and period; documents are arrays of numbers from 0."""
    sizes = np.array([len(d) for d in documents], np.int64)
    starts = np.cumsum(sizes + 1) - sizes  # a separator before each, and one at the end
    top = len(documents) + max([0, *(int(d.max()) for d in documents if len(d))])
    values = np.arange(len(documents) + 1).repeat(np.append(sizes, 0) + 1)  # separators: 0 to the number of documents
    inside = np.ones(len(values), bool)
    inside[starts - 1] = inside[-1] = False
    if len(documents):
        values[inside] = np.concatenate(documents) + len(documents) + 1
    firsts, periods = [], []
    for document, period, place in _grids(sizes, exponent, shortest):
        first = starts[document] + place
        hit = values[first] == values[first + period]
        first, period = first[hit], period[hit]
        # The stretch that a grid is to meet has at least two such places next to each other, if the stride has.
        beside = (values[first + 1] == values[first + 1 + period]) | (values[first - 1] == values[first - 1 + period])
        beside |= np.maximum(shortest, exponent * period) - period < 2
        firsts.append(first[beside])
        periods.append(period[beside])
    if not firsts or not sum(map(len, firsts)):
        return np.zeros((0, 4), np.int64)

    # Only documents with such places are sorted.
    owner = np.searchsorted(starts, np.concatenate(firsts), side="right") - 1
    asked = np.unique(owner)
    kept = np.concatenate([np.arange(starts[d] - 1, starts[d] + sizes[d]) for d in asked] + [[len(values) - 1]])
    values = values[kept]
    moved = np.cumsum(sizes[asked] + 1) - sizes[asked]
    longest = int(sizes[asked].max()) + 1
    forward, backward = Extensions(values, top + 1, longest), Extensions(values[::-1], top + 1, longest)
    shift = np.zeros(len(documents), np.int64)
    shift[asked] = moved - starts[asked]
    size, found = len(values), np.zeros((0, 4), np.int64)
    for first, period in zip(firsts, periods):
        if not len(first):
            continue
        document = np.searchsorted(starts, first, side="right") - 1
        first = first + shift[document]
        after = forward.of(first, first + period)
        before = backward.of(size - first, size - first - period)
        enough = after + before + period >= np.maximum(shortest, exponent * period)
        rows = np.stack([document, first - before - shift[document] - starts[document], after + before + period, period], axis=1)[enough]
        found = _least_periods(np.concatenate([found, rows]))
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def _least_periods(rows: np.ndarray) -> np.ndarray:
    """Of stretches with equal ends the one with the least period."""
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    return rows[new]


def _searched(texts: list[list[str]], exponent: int, shortest: int) -> Iterator[tuple[int, tuple]]:
    """(size, (n_words, runs, collapsed)) for each list of words."""
    numbers: defaultdict[str, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    found = find_runs([np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in texts], exponent, shortest)
    ends = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
    for k, words in enumerate(texts):
        runs = found[ends[k] : ends[k + 1], 1:]
        count = len(words)
        if len(runs):
            # A word goes if it lies in a run beyond that run's first period.
            change = np.zeros(count + 1, np.int64)
            np.add.at(change, runs[:, 0] + runs[:, 2], 1)
            np.add.at(change, runs[:, 0] + runs[:, 1], -1)
            words = [words[at] for at in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
        collapsed = " ".join(words)
        yield len(collapsed), (count, [dict(zip(("start", "length", "period"), r)) for r in runs.tolist()], collapsed)


def periodic_runs(
    docs: DataFrame, exponent: int = EXPONENT, shortest: int = SHORTEST, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Columns: id, n_words, runs (start, length and period in words, by start, then period), collapsed.

    ``collapsed`` has the words that are in the first period of every run they belong to, joined by one space.
    """
    if exponent < 2 or shortest < 2:
        raise ValueError("a run has at least two periods and two words")
    run_kind = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType(
        [
            T.StructField(id_column, docs.schema[id_column].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(run_kind)),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    kinds = [pa.int64(), pa.list_(pa.struct([(c, pa.int64()) for c in run_kind.names])), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch):
            texts, size = [], 0
            for text in batch.column(1):
                texts.append(_WORD.findall(text.as_py() or ""))
                size += len(texts[-1]) + 1
                if size >= MOST_WORDS:
                    yield from _searched(texts, exponent, shortest)
                    texts, size = [], 0
            yield from _searched(texts, exponent, shortest)

        for batch in batches:
            for ids, columns in flushed(batch.column(0), rows(batch)):
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(columns, kinds))], schema.names)

    return docs.select(id_column, text_column).mapInArrow(run, schema)
