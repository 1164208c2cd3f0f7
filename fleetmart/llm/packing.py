"""Best-fit packing of documents into training sequences.

Best-fit decreasing: pieces are placed from the longest to the shortest, each in the open sequence with the least room
that still holds it; a segment tree over the room left (0 to the capacity) finds that sequence in logarithmic time.
Which sequence a piece gets follows from its length and its place among the pieces of that length alone. So the tree
walks the histogram of lengths (at most ``capacity`` rows, on the driver) and takes runs of equal pieces at a time; its
result is a list of runs that every task looks its pieces up in. The packing is that of the whole input, however it is
split, and the list is small: a sequence's room at least halves when it takes pieces, and each length opens at most
three new groups of sequences, so there are fewer than 3 * capacity * log2(capacity) runs for any number of documents.

Null and empty texts are one end-of-text id. Rows without an id, repeated ids and repeated rows are packed like any
other, each row by itself. Other columns are ignored, whatever their names. No rows: no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.llm.encoding import encoder, public
from fleetmart.session import materialize

CAPACITY, END = 2048, 0

_RANKS = 1 << 44  # places within one length


class OpenSequences:
    """Groups of sequences by the room left in them, under a segment tree."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.size)
        self.groups: dict[int, list[tuple[int, int]]] = {}

    def put(self, room: int, first: int, count: int) -> None:
        if room and count:
            self.groups.setdefault(room, []).append((first, count))
            self._mark(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        group = self.groups[room].pop()
        if not self.groups[room]:
            self._mark(room, 0)
        return group

    def tightest(self, length: int) -> int | None:
        """The least room of at least ``length`` that some sequence has."""
        node = self.size + length
        while not self.any[node]:
            while node & 1:  # a right child: nothing to its right below the same parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.size:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        return node - self.size

    def _mark(self, room: int, value: int) -> None:
        node = self.size + room
        self.any[node] = value
        while node > 1:
            node >>= 1
            value = self.any[2 * node] | self.any[2 * node + 1]
            if self.any[node] == value:
                return
            self.any[node] = value


def best_fit(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Runs (length, first place, pieces per sequence, first sequence, offset), by length and place."""
    open_, runs, opened = OpenSequences(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        left, place = histogram[length], 0
        while left:
            room = open_.tightest(length)
            if room is None:
                room, first, count = capacity, opened, -(-left // (capacity // length))
                opened += count
            else:
                first, count = open_.take(room)
            # The sequence just used stays the tightest until it is full.
            each = room // length
            full = min(count, left // each)
            if full:
                runs.append((length, place, each, first, capacity - room))
                open_.put(room - each * length, first, full)
                place, left = place + full * each, left - full * each
            rest = count - full
            if rest and left:
                runs.append((length, place, each, first + full, capacity - room))
                open_.put(room - left * length, first + full, 1)
                left, rest, full = 0, rest - 1, full + 1
            open_.put(room, first + full, rest)
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)


def cut(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end: int = END,
    id_column: str = "doc_id", text_column: str = "text", ids: bool = False,
) -> DataFrame:
    """Each document's ids and the end id, in pieces of ``capacity`` ids; the last piece may be shorter.

    Columns: id, piece, start, length, ids_crc32 and, if asked for, the ids themselves.
    """
    path = tokenizer or public()
    kind = docs.schema[id_column].dataType
    fields = [T.StructField(id_column, kind), T.StructField("piece", T.IntegerType())]
    fields += [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")]
    fields += [T.StructField("ids", T.BinaryType())] if ids else []
    stop, step = np.array([end], dtype="<u4").tobytes(), 4 * capacity

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).ids
        for batch in batches:
            row, piece, length, crc, parts = [], [], [], [], []
            for k, text in enumerate(batch.column(1)):
                whole = encode(text.as_py()) + stop
                for at in range(0, len(whole), step):
                    part = whole[at : at + step]
                    row.append(k)
                    piece.append(at // step)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if ids:
                        parts.append(part)
            number = np.array(piece, dtype=np.int32)
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(number)]
            columns += [pa.array(number.astype(np.int64) * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            columns += [pa.array(parts, pa.binary())] if ids else []
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return docs.select(id_column, text_column).mapInArrow(pieces, T.StructType(fields))


def pack(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end: int = END,
    id_column: str = "doc_id", text_column: str = "text", ids: bool = False,
) -> DataFrame:
    """The pieces of ``cut``, each with its ``sequence_id`` and its ``offset`` there.

    Texts are encoded once; the pieces (a few numbers each) are kept in the shared folder, with a number each. Their
    places within a length come from a window over (length, salt): a length with many pieces gets many salts, dealt by
    that number, so that no task holds more than about its share of the rows, repeated rows included.
    """
    spark = docs.sparkSession
    found = cut(docs, capacity, tokenizer, end, id_column, text_column, ids)
    pieces = materialize(found.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = best_fit(histogram, capacity)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, -(-sum(histogram.values()) // tasks))
    salts = [(length, -(-count // share)) for length, count in sorted(histogram.items())]
    salt = F.pmod(F.xxhash64("_row"), F.col("_salts"))
    salted = pieces.join(F.broadcast(spark.createDataFrame(salts, "length long, _salts long")), "length").withColumn("_salt", salt)
    before, offsets = {}, []
    for length, s, count in sorted(tuple(r) for r in salted.groupBy("length", "_salt").count().collect()):
        offsets.append((length, s, before.get(length, 0)))
        before[length] = before.get(length, 0) + count

    rank = F.row_number().over(W.partitionBy("length", "_salt").orderBy(id_column, "piece", "ids_crc32", "_row"))
    ranked = (
        salted.withColumn("_rank", rank)
        .join(F.broadcast(spark.createDataFrame(offsets, "length long, _salt long, _before long")), ["length", "_salt"])
        .select(*found.columns, (F.col("_before") + F.col("_rank") - 1).alias("_place"))
    )
    known = spark.sparkContext.broadcast(runs)
    schema = T.StructType([*found.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    at = found.columns.index("length")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, each, sequence, offset = known.value.T
        keys = length * _RANKS + first
        for batch in batches:
            size, where = batch.column(at).to_numpy(), batch.column(batch.num_columns - 1).to_numpy()
            run = np.searchsorted(keys, size * _RANKS + where, side="right") - 1
            nth = where - first[run]
            columns = [*batch.columns[:-1], pa.array(sequence[run] + nth // each[run]), pa.array(offset[run] + nth % each[run] * size)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The packed sequences themselves, from ``pack(..., ids=True)``: the joined ids (little-endian unsigned 32-bit
    numbers), and where each document's piece begins. A sequence holds at most ``capacity`` pieces."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.col(id_column).alias("id"), "piece", "length", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("_parts"))
        .select(
            "sequence_id",
            F.aggregate("_parts.ids", F.lit(b""), lambda whole, part: F.concat(whole, part)).alias("ids"),
            F.transform("_parts", lambda p: F.struct(p["offset"].alias("offset"), p["id"].alias("id"), p["piece"].alias("piece"))).alias("pieces"),
        )
    )
