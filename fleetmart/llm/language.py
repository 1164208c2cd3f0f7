"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. An n-gram's vector binds (multiplies) its
letters' vectors, each rotated by its place; a text's vector bundles (adds) those of its n-grams, and a language's
prototype the vectors of its labelled texts. A text gets the language whose prototype has the largest cosine with it.

Letters are lower-cased; everything between two runs of letters counts as one space. Null texts and texts without a
letter are ``und`` with score 0, as is everything if no text has a language. Equal cosines go to the first name. Repeated
rows are predicted alike. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.llm.labelled import held_out, sample
from fleetmart.llm.recent import kept

UNKNOWN = "und"
#: Length of the vectors and of the n-grams, and the draw of the letters.
DIMENSIONS, LETTERS, SEED = 1024, 3, 20
#: Texts a language's prototype is made from, about: a bounded sample, by the hash of the id.
PER_LANGUAGE = 20_000
#: Most n-gram vectors a worker keeps (a byte per place).
KEPT = 60_000

_SPACE, _SHIFT = 32, 21  # code points take 21 bits


@lru_cache(maxsize=1)
def _alphabet() -> tuple[np.ndarray, np.ndarray]:
    """By code point: its lower case where that is one letter, and whether that is a letter."""
    lower, letter = np.arange(0x110000, dtype=np.int64), np.zeros(0x110000, dtype=bool)
    for code in range(0x110000):
        low = chr(code).lower()
        if len(low) == 1:
            lower[code] = ord(low)
        letter[code] = low[0].isalpha()
    return lower, letter


def grams(text: str | None, letters: int = LETTERS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text, as numbers, and how often each occurs."""
    lower, letter = _alphabet()
    codes = lower[np.frombuffer((text or "").encode("utf-32-le"), dtype="<u4")]
    is_letter = letter[codes]
    if not is_letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    spaced = np.where(is_letter, codes, _SPACE)
    spaced = spaced[is_letter | np.concatenate(([False], is_letter[:-1]))]
    last = [_SPACE] * bool(spaced[-1] != _SPACE)
    line = np.concatenate(([_SPACE], spaced, last, [_SPACE] * max(0, letters - 1 - len(spaced) - len(last)))).astype(np.int64)
    keys = np.zeros(len(line) - letters + 1, dtype=np.int64)
    for k in range(letters):
        keys = keys << _SHIFT | line[k : k + len(keys)]
    return np.unique(keys, return_counts=True)


class Vectors(dict):
    """Row numbers of n-gram vectors, made on demand."""

    def __init__(self, dimensions: int, letters: int, seed: int):
        self.dimensions, self.letters, self.seed = dimensions, letters, seed
        self.matrix = np.empty((KEPT, dimensions), dtype=np.int8)
        self.signs: dict[int, np.ndarray] = {}

    def _sign(self, code: int) -> np.ndarray:
        if code not in self.signs:
            if len(self.signs) >= KEPT:
                self.signs.clear()
            self.signs[code] = np.random.default_rng([self.seed, code]).choice(np.array([-1, 1], dtype=np.int8), self.dimensions)
        return self.signs[code]

    def __missing__(self, key: int) -> int:
        bound = np.ones(self.dimensions, dtype=np.int8)
        for place in range(self.letters):
            bound *= np.roll(self._sign(key >> _SHIFT * place & (1 << _SHIFT) - 1), place)
        self[key] = row = len(self)
        self.matrix[row] = bound
        return row

    def bundle(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The text's vector; sums of whole numbers, so the same in any order."""
        total = np.zeros(self.dimensions)
        for at in range(0, len(keys), 1024):
            part, weights = keys[at : at + 1024].tolist(), counts[at : at + 1024]
            if len(self) + len(part) > KEPT:
                self.clear()
            kind = np.float32 if weights.sum() < 1 << 23 else np.float64  # exact either way
            total += weights.astype(kind) @ self.matrix[[self[k] for k in part]].astype(kind)
        return total


def vectors(dimensions: int, letters: int, seed: int) -> Vectors:
    """The worker's vectors; they outlive a task."""
    return kept(("language", dimensions, letters, seed), lambda: Vectors(dimensions, letters, seed))


def prototypes(
    docs: DataFrame, dimensions: int = DIMENSIONS, letters: int = LETTERS, seed: int = SEED, per_language: int = PER_LANGUAGE,
    id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang",
) -> dict[str, np.ndarray]:
    """Each language's vector, from labelled texts that aren't held out.

    Tasks add up their own texts and a few tasks those sums; the driver gets one small row from each of these.
    """
    chosen = sample(docs, language_column, id_column, per_language).withColumnRenamed(language_column, "_language")
    texts = docs.select(id_column, F.col(text_column).alias("_text"), F.col(language_column).alias("_own"))
    texts = texts.join(F.broadcast(chosen), id_column).where("_own = _language").select("_language", "_text")
    schema = "language string, vector binary"

    def emit(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        if sums:
            yield pa.RecordBatch.from_pydict({"language": pa.array(list(sums)), "vector": pa.array([v.tobytes() for v in sums.values()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = vectors(dimensions, letters, seed), {}
        for batch in batches:
            for language, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                sums[language] = sums.get(language, 0) + own.bundle(*grams(text, letters))
        yield from emit(sums)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, vector in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                sums[language] = sums.get(language, 0) + np.frombuffer(vector)
        yield from emit(sums)

    found: dict[str, np.ndarray] = {}
    for r in texts.mapInArrow(add, schema).repartition(8).mapInArrow(merge, schema).collect():
        found[r["language"]] = found.get(r["language"], 0) + np.frombuffer(r["vector"])
    return {language: found[language] for language in sorted(found) if found[language].any()}


def predict(
    docs: DataFrame, known: dict[str, np.ndarray], dimensions: int = DIMENSIONS, letters: int = LETTERS, seed: int = SEED,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(id, lang_pred, score) of every row; score is the cosine, or 0 if that is below."""
    names = [*known]
    units = np.array([v / np.linalg.norm(v) for v in known.values()]).reshape(len(names), dimensions)
    sent = docs.sparkSession.sparkContext.broadcast(units)
    schema = T.StructType([docs.schema[id_column], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vectors(dimensions, letters, seed)
        for batch in batches:
            best, score = [], []
            for text in batch.column(1):
                keys, counts = grams(text.as_py(), letters)
                whole = own.bundle(keys, counts) if names and len(keys) else np.zeros(dimensions)
                if not whole.any():
                    best.append(UNKNOWN if not (names and len(keys)) else names[0])
                    score.append(0.0)
                    continue
                cosines = sent.value @ whole / np.linalg.norm(whole)
                k = int(np.argmax(cosines))
                best.append(names[k])
                score.append(float(min(1.0, max(0.0, cosines[k]))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64())], schema.names)

    return docs.select(id_column, text_column).mapInArrow(run, schema)


def identify(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang") -> DataFrame:
    """Learn from the labelled rows of ``docs`` and predict all: (id, held_out, lang_pred, score)."""
    known = prototypes(docs, id_column=id_column, text_column=text_column, language_column=language_column)
    found = predict(docs, known, id_column=id_column, text_column=text_column)
    return found.select(id_column, held_out(id_column).alias("held_out"), "lang_pred", "score")
