"""Benchmark decontamination: passages of documents that repeat a benchmark item.

Every item of n words is held against every window of n words of a document (the whole document, if that is shorter).
Both get a SimHash over their shingles of five words (all words of a shorter item), each as heavy as it occurs. A
multi-index finds the items near a window: fingerprints are cut into ``BLOCKS`` blocks, so two within ``RADIUS`` bits
differ in at most RADIUS // BLOCKS bits of some block, and every such block value is looked up. Items found are
verified exactly: weighted Jaccard similarity of the shingles (common over joint weight) of at least ``SIMILARITY``. At
that similarity two fingerprints differ in 10 bits on average, in more than 20 in one case of some thousands. The fewer
shingles, the more a fingerprint owes to each; items of at most ``FEW`` different ones are therefore compared with every
window that has enough of them, without a fingerprint: none of their windows is missed.

An item of fewer than five words is found in no longer text, where its words may stand by chance: it matches only
documents that consist of just these words.

A window needs a certain number of shingles that some item has, or no item can be similar enough; windows without them
are passed over before any fingerprint is made.

Words are lower-cased runs of word characters. Items without a word match nothing, nor do documents without. The index
is sent to all tasks; a benchmark beyond ``BLOCK_CHARS`` characters is dealt to several indexes, with a pass over the
documents for each. It has every text once, whatever the number of items with it. Repeated items are all reported, repeated documents too, each row by itself. Other columns are
ignored, whatever their names. No documents or no items: no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

SHINGLE, SIMILARITY = 5, 0.8
BLOCKS, RADIUS = 7, 20
#: Most different shingles of an item that is compared without fingerprints.
FEW = 16
#: Characters of the benchmark in one index, about; shingles of a document taken together.
BLOCK_CHARS, SLAB = 32_000_000, 1 << 15

_WORDS = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def shingle_hashes(words: list[str], size: int) -> np.ndarray:
    """One number for each run of ``size`` words."""
    own = np.array([xxh64_intdigest(w) for w in words], dtype=np.uint64)
    total = own[: len(own) - size + 1]
    for k in range(1, size):
        total = (total ^ (total >> np.uint64(31))) * _MIX + own[k : len(own) - size + 1 + k]
    total = (total ^ (total >> np.uint64(32))) * _MIX
    return total ^ (total >> np.uint64(29))


def simhashes(shingles: np.ndarray, starts: np.ndarray, width: int, sums: np.ndarray | None = None) -> np.ndarray:
    """Fingerprints of the windows of ``width`` shingles at ``starts``."""
    sums = running_votes(shingles) if sums is None else sums
    votes = sums[starts + width] - sums[starts]
    return np.packbits(2 * votes > width, axis=1, bitorder="little").view("<u8")[:, 0]


def running_votes(shingles: np.ndarray) -> np.ndarray:
    sums = np.zeros((len(shingles) + 1, 64), dtype=np.int32)
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    np.cumsum(bits, axis=0, out=sums[1:])
    return sums


def similarity(a: Counter, b: Counter) -> float:
    common = sum((a & b).values())
    return common / (a.total() + b.total() - common)


def weights(words: list[str], size: int) -> Counter:
    return Counter(zip(*[words[k : len(words) - size + 1 + k] for k in range(size)], strict=True))


class Index:
    """Items by shingle and by fingerprint block."""

    def __init__(self, items: list[tuple], blocks: int = BLOCKS, radius: int = RADIUS, least: float = SIMILARITY):
        self.least, self.radius = least, radius
        known = [(item, words) for item, text in items if (words := words_of(text))]
        self.ids = [item for item, _ in known]
        self.sizes = np.array([len(words) for _, words in known], dtype=np.int64)
        self.shingle = np.minimum(self.sizes, SHINGLE)
        self.weights = [weights(words, min(len(words), SHINGLE)) for _, words in known]
        hashes = [shingle_hashes(words, min(len(words), SHINGLE)) for _, words in known]
        # Items of few shingles: (size, different shingles, how often each), and which of them have a shingle.
        self.simple = {i: (len(known[i][1]), *np.unique(h, return_counts=True)) for i, h in enumerate(hashes) if len(np.unique(h)) <= FEW}
        self.having: dict[int, list[int]] = {}
        for i, (_, own, _) in self.simple.items():
            for h in own.tolist():
                self.having.setdefault(h, []).append(i)
        self.prints = np.array([simhashes(h, np.zeros(1, np.int64), len(h))[0] for h in hashes], dtype=np.uint64)
        # By shingle length: all shingles in order, and a bit map of their first bits that passes over most others.
        self.members = {}
        for size in sorted(set(self.shingle.tolist())):
            own = np.unique(np.concatenate([h for h, s in zip(hashes, self.shingle, strict=True) if s == size]))
            bits = max(10, min(30, (16 * len(own)).bit_length()))
            present = np.zeros(1 << bits, dtype=bool)
            present[own >> np.uint64(64 - bits)] = True
            self.members[size] = (own, present, np.uint64(64 - bits), sorted(set(self.sizes[self.shingle == size].tolist())))
        edges = np.linspace(0, 64, blocks + 1).astype(int).tolist()
        self.blocks = []
        for low, high in zip(edges, edges[1:], strict=False):
            width = high - low
            near = [x for x in range(1 << width) if x.bit_count() <= radius // blocks]
            keys = self._keys(self.prints, self.sizes, low, width)
            order = np.argsort(keys, kind="stable")
            self.blocks.append((low, width, np.array(near, dtype=np.int64), keys[order], order))

    @staticmethod
    def _keys(prints: np.ndarray, sizes: np.ndarray | int, low: int, width: int) -> np.ndarray:
        return ((prints >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64) | (sizes << np.int64(width))

    def near(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """All (window, item) with items of ``size`` words within the radius of the windows' fingerprints."""
        pairs = []
        for low, width, near, keys, order in self.blocks:
            wanted = (self._keys(prints, size, low, width)[:, None] ^ near).ravel()
            first, last = np.searchsorted(keys, wanted), np.searchsorted(keys, wanted, side="right")
            count = last - first
            at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            pairs.append(np.repeat(np.arange(len(wanted)) // len(near), count) * len(self.ids) + order[at])
        window, item = np.divmod(np.unique(np.concatenate(pairs)), max(1, len(self.ids)))
        close = np.bitwise_count(prints[window] ^ self.prints[item]) <= self.radius
        return window[close], item[close]

    def windows(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(size of items, shingle length, starts, fingerprints) of the windows that may be similar to some item."""
        for size, (own, present, shift, item_sizes) in self.members.items():
            if len(words) < size or (size < SHINGLE and len(words) > size):
                continue
            whole = shingle_hashes(words, size)
            maybe = np.flatnonzero(present[whole >> shift])
            at = np.searchsorted(own, whole[maybe])
            maybe = maybe[own[np.minimum(at, len(own) - 1)] == whole[maybe]]
            if not len(maybe):
                continue
            member = np.zeros(len(whole) + 1, dtype=np.int32)
            member[maybe + 1] = 1
            member = np.cumsum(member, dtype=np.int32)
            most = item_sizes[-1] - size + 1
            for begin in range(0, len(whole), SLAB):
                part = whole[begin : begin + SLAB + most - 1]
                seen, sums = member[begin : begin + len(part) + 1], None
                if seen[-1] == seen[0]:
                    continue
                for n in item_sizes:
                    own_width = n - size + 1
                    width = min(own_width, len(whole))
                    if len(part) < width:
                        continue
                    # Common weight c with c / (own + width - c) >= least.
                    need = self.least * (own_width + width) / (1 + self.least) - 1e-9
                    starts = np.flatnonzero((seen[width:] - seen[:-width])[:SLAB] >= need)
                    if len(starts):
                        sums = running_votes(part) if sums is None else sums
                        yield n, size, starts + begin, simhashes(part, starts, width, sums)

    def repeats(self, words: list[str]) -> Iterator[tuple[int, float, int, int]]:
        """The same as ``find`` for items of few shingles, each compared with all windows by running counts."""
        if len(words) < SHINGLE or not self.simple:
            return
        whole = shingle_hashes(words, SHINGLE)
        own, present, shift, _ = self.members.get(SHINGLE, (None, None, None, None))
        if own is None:
            return
        maybe = np.flatnonzero(present[whole >> shift])
        asked = {i for h in set(whole[maybe].tolist()) for i in self.having.get(h, ()) if self.sizes[i] >= SHINGLE}
        for i in sorted(asked):
            n, shingles, weight = self.simple[i]
            width, total = min(n - SHINGLE + 1, len(whole)), int(weight.sum())
            best = (0.0, 0)
            for begin in range(0, len(whole) - width + 1, SLAB):
                part = whole[begin : begin + SLAB + width - 1]
                common = np.zeros(len(part) - width + 1, np.int64)
                for shingle, most in zip(shingles, weight.tolist()):
                    seen = np.concatenate(([0], np.cumsum(part == shingle)))
                    common += np.minimum(seen[width:] - seen[:-width], most)
                top = int(common.argmax())
                found = int(common[top]) / (total + width - int(common[top]))
                if found > best[0]:
                    best = (found, begin + top)
            if best[0] >= self.least:
                yield i, best[0], best[1], min(n, len(words) - best[1])

    def find(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """(item, similarity, first word, words) of each item that some window repeats, at its best window."""
        words = words_of(text)
        best = {i: (found, w, n) for i, found, w, n in self.repeats(words)}
        for n, size, starts, prints in self.windows(words):
            window, item = self.near(prints, n)
            for w, i in zip(starts[window].tolist(), item.tolist(), strict=True):
                if (i in best and best[i][0] == 1) or (size == SHINGLE and i in self.simple):
                    continue
                own = words[w : w + n]
                found = similarity(self.weights[i], weights(own, size))
                if found >= self.least and (i not in best or found > best[i][0]):
                    best[i] = (found, w, len(own))
        return [(i, *best[i]) for i in sorted(best)]


def indexes(benchmark: DataFrame, text_column: str = "text") -> Iterator[Index]:
    """The benchmark's texts as one index, or as several of bounded size; a text's id is its hash."""
    texts = benchmark.select(F.col(text_column).alias("text")).where("text is not null").distinct()
    items = texts.select(F.md5("text").alias("item"), "text")
    chars = items.agg(F.sum(F.length("text").cast("long") + 1)).first()[0] or 0
    parts = -(-chars // BLOCK_CHARS)
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).collect()
        yield Index([(r["item"], r["text"]) for r in own])


def matches(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id"
) -> DataFrame:
    """(id, item id, similarity, first word, words): one row for each document and item that it repeats."""
    schema = T.StructType([docs.schema[id_column], T.StructField("_item", T.StringType()), T.StructField("similarity", T.DoubleType())])
    schema = schema.add("start_word", "long").add("n_words", "long")
    kind = pa.int64()
    found = docs.sparkSession.createDataFrame([], schema)
    for index in indexes(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = sent.value
            for batch in batches:
                rows = [(k, *hit) for k, text in enumerate(batch.column(1)) for hit in own.find(text.as_py())]
                where, hit, similar, start, size = zip(*rows, strict=True) if rows else ((),) * 5
                columns = [batch.column(0).take(pa.array(where, kind)), pa.array([own.ids[i] for i in hit], pa.string()), pa.array(similar, pa.float64())]
                columns += [pa.array(start, kind), pa.array(size, kind)]
                if rows:
                    yield pa.RecordBatch.from_arrays(columns, schema.names)

        found = found.union(docs.select(id_column, text_column).mapInArrow(run, schema))
    # The items come to their texts at the end.
    named = benchmark.where(F.col("text").isNotNull()).select(F.md5("text").alias("_item"), F.col(item_column).alias("item_id"))
    return found.join(named, "_item").select(id_column, "item_id", "similarity", "start_word", "n_words")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that repeat no item."""
    at, schema = docs.columns.index(text_column), docs.schema
    for index in indexes(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = sent.value
            for batch in batches:
                yield batch.filter(pa.array([not own.find(t.as_py()) for t in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs
