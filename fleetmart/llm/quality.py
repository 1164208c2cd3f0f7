"""Quality rules: base measures, and a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed n-grams (single tokens and pairs; a token is a run of word characters or of other
characters) are counted: one from the whole corpus, smoothed by one count per bucket, and one from trusted texts,
smoothed by an eighth (``PRIOR``) of their own counts dealt out as the corpus has them. So n-grams that the trusted texts
say nothing about count little against a text, however few these texts are. A text's score is the mean of
log(trusted / corpus) over its n-grams, so that long texts are not favoured.

The threshold comes from the trusted texts that pass the base rules, each scored by the counts of the others: it lies a
share of their spread below the lowest one (a quarter from a hundred texts on, more for fewer), or at ``CLEAR`` if that
is lower. Every text with a score of
at least the threshold is kept, no other; no draw is involved.

Words are split at ASCII white space. Null and empty texts have no word and fail the base rules. Trusted are the texts
whose id has ``quality`` 1 in the labels (null labels and ids: not trusted; repeated labels count once); without any,
all ratios are 0 and the base rules decide alone. Repeated rows are measured alike. Other columns are ignored, whatever
their names. No rows: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh32_intdigest

from fleetmart.llm.recent import Recent, kept

LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30
BUCKETS = 1 << 16
#: Counts of the prior for one count of the trusted texts.
PRIOR = 1 / 8
#: Share of the spread of trusted texts' scores by which the threshold is below the lowest: FEW by the root of their
#: number, MARGIN at least; no text that scores CLEAR nats per n-gram or more is rejected.
MARGIN, FEW, CLEAR = 0.25, 2.5, -0.25
#: Most trusted ids sent to all tasks; more are joined by a shuffle.
SENT_IDS = 1_000_000
#: Words taken together, and n-grams counted together.
SLAB, COUNTED = 1 << 18, 1 << 20

_MIX = np.int64(-7046029254386353131)
_SPACES, _SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
_TOKENS = regex.compile(r"\w+|[^\w\s]+")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more."""
    if len(words) <= window:
        return 0
    # Windows that are equal have equal hashes: mostly all of them differ.
    hashes = np.fromiter(map(hash, words), np.int64, len(words))
    mixed = hashes[: len(words) - window + 1].copy()
    for k in range(1, window):
        mixed = mixed * _MIX + hashes[k : len(hashes) - window + 1 + k]
    mixed.sort()
    if (mixed[1:] != mixed[:-1]).all():
        return 0
    numbers: dict[bytes, int] = {}
    rank = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    count, size = len(numbers), 1
    # Numbers of ever longer windows, from those of their two halves (which overlap for the last step, if need be).
    while size < window:
        step = min(size, window - size)
        _, rank, found = np.unique(rank[:-step] * count + rank[step:], return_inverse=True, return_counts=True)
        count, size = len(found), size + step
    again = (found[rank] > 1).astype(np.int64)
    inside = np.cumsum(np.concatenate((again, np.zeros(window, np.int64))) - np.concatenate((np.zeros(window, np.int64), again)))
    return int((inside > 0).sum())


def measures(text: str | None, words: list[bytes]) -> tuple[int, int, int, int, int]:
    text = text or ""
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    chars = len(text) - sum(map(text.count, _SPACES))
    return len(words), chars, sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


def word_tokens(word: bytes) -> bytes:
    found = _TOKENS.findall(word.decode().lower())
    return np.array([xxh32_intdigest(t.encode()) for t in found], dtype="<u4").tobytes()


def _words() -> Recent:
    """The worker's memory of words; it outlives a task."""
    return kept("quality", lambda: Recent(word_tokens))


def buckets(words: list[bytes]) -> Iterator[np.ndarray]:
    """The buckets of a text's n-grams, repeats included, some at a time."""
    last = np.empty(0, dtype=np.uint32)
    for at in range(0, len(words), SLAB):
        tokens = np.frombuffer(b"".join(map(_words().__getitem__, words[at : at + SLAB])), dtype="<u4")
        line = np.concatenate((last, tokens))
        pairs = (line[:-1] * np.uint32(0x85EBCA6B)) ^ (line[1:] * np.uint32(0xC2B2AE35))
        yield np.concatenate((tokens, pairs ^ (pairs >> np.uint32(16)))) & np.uint32(BUCKETS - 1)
        last = line[-1:]


@dataclass(frozen=True)
class Rule:
    """log(trusted / corpus) by bucket, and the least score of a kept text."""

    ratio: np.ndarray
    threshold: float


def _of_others(own: np.ndarray, trusted: np.ndarray, corpus: np.ndarray, total: float) -> float:
    """The score of a trusted text, by its buckets, from the counts of the other ones."""
    bucket, count = np.unique(own, return_counts=True)
    rest = total - len(own)
    others = (trusted[bucket] - count) / corpus[bucket]
    return float(np.log((others + PRIOR * rest) / (rest * (1 + PRIOR))) @ count) / len(own)


def threshold(least: float | None, most: float | None, n: int | None) -> float:
    """From the lowest and highest score of trusted texts and their number; few of them say little of how low others may be."""
    if not n:
        return CLEAR
    return min(CLEAR, least - max(MARGIN, FEW / n**0.5) * max(most - least, -least))


def ratios(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Rule:
    """What is counted over all of ``docs``: ratios by bucket, and the threshold."""
    trusted = labels.where(F.col("quality") == 1).select(F.col(id_column).alias("_id")).distinct().withColumn("_trusted", F.lit(True))
    few = trusted.limit(SENT_IDS + 1).count() <= SENT_IDS
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    marked = texts.join(F.broadcast(trusted) if few else trusted, "_id", "left").select("_text", F.coalesce("_trusted", F.lit(False)).alias("_trusted"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, size = np.zeros((2, BUCKETS), dtype=np.int64), ([], []), 0

        def add() -> None:
            for k in (0, 1):
                counts[k] += np.bincount(np.concatenate([np.empty(0, np.uint32), *held[k]]), minlength=BUCKETS)
                held[k].clear()

        for batch in batches:
            for text, good in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                for part in buckets((text.as_py() or "").encode().split()):
                    held[int(good)].append(part)
                    size += len(part)
                    if size >= COUNTED:
                        add()
                        size = 0
        add()
        counts[0] += counts[1]
        bucket = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(counts[0, bucket]), pa.array(counts[1, bucket])], ["bucket", "corpus", "trusted"])

    found = marked.mapInArrow(count, "bucket long, corpus long, trusted long").groupBy("bucket").agg(F.sum("corpus"), F.sum("trusted"))
    counts = np.zeros((2, BUCKETS))
    for r in found.collect():  # at most one small row per bucket
        counts[:, r[0]] = r[1], r[2]
    total = counts[1].sum()
    if not total:
        return Rule(np.zeros(BUCKETS), CLEAR)
    corpus = (counts[0] + 1) / (counts[0].sum() + BUCKETS)
    sent = docs.sparkSession.sparkContext.broadcast((counts[1], corpus, total))

    def rate_trusted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = []
        for batch in batches:
            for text in batch.column(0):
                words = (text.as_py() or "").encode().split()
                own = np.concatenate([np.empty(0, np.uint32), *buckets(words)])
                # One that is all there is says nothing of others.
                if len(words) >= LEAST_WORDS and 0 < len(own) < sent.value[2] and not failed(len(words), repeated_words(words)):
                    scores.append(_of_others(own, *sent.value))
        ends = [[min(scores)], [max(scores)], [len(scores)]] if scores else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(e, k) for e, k in zip(ends, (pa.float64(), pa.float64(), pa.int64()))], ["least", "most", "n"])

    rated = marked.where("_trusted").mapInArrow(rate_trusted, "least double, most double, n long")
    return Rule(np.log((counts[1] / corpus + PRIOR * total) / (total * (1 + PRIOR))), threshold(*rated.agg(F.min("least"), F.max("most"), F.sum("n")).first()))


def score(words: list[bytes], ratio: np.ndarray) -> float:
    total, n = 0.0, 0
    for part in buckets(words):
        total, n = total + float(ratio[part].sum()), n + len(part)
    return total / n if n else 0.0


def assess(docs: DataFrame, rule: Rule, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, the measures, base_failed, score, kept) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(rule)
    schema = T.StructType([docs.schema[id_column], *[T.StructField(n, T.LongType()) for n in MEASURES]])
    schema = schema.add("base_failed", "boolean").add("score", "double").add("kept", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                words = (text or "").encode().split()
                own = measures(text, words)
                bad, value = failed(own[0], own[4]), score(words, sent.value.ratio)
                rows.append((*own, bad, value, not bad and value >= sent.value.threshold))
            kinds = [pa.int64()] * len(MEASURES) + [pa.bool_(), pa.float64(), pa.bool_()]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    return docs.select(id_column, text_column).mapInArrow(run, schema)


def keep_good(docs: DataFrame, rule: Rule, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the threshold."""
    sent, at = docs.sparkSession.sparkContext.broadcast(rule), docs.columns.index(text_column)

    def good(text: str | None) -> bool:
        words = (text or "").encode().split()
        return len(words) >= LEAST_WORDS and not failed(len(words), repeated_words(words)) and score(words, sent.value.ratio) >= sent.value.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([good(t.as_py()) for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def rate(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    return assess(docs, ratios(docs, labels, id_column, text_column), id_column=id_column, text_column=text_column)
