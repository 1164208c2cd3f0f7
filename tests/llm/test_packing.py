import random
import zlib

import numpy as np
import pytest

from fleetmart.llm import packing
from fleetmart.llm.encoding import Encoder, public

TEXTS = [
    "It's a TEST, don't 'Panic'!", "Größe Élan ÑANDÚ ½ ² ª", "a\tb\x0bc d\x1ce\x85f", "ΑΣ ΣΑΣ İstanbul ﬁ Å é 가각 日本 語",
    "<|endoftext|> x<|startoftext|>y", "  \n\n ", "", "!!! ### 1234 '", "ẹ́ q̣̇ ́ x", "w" * 5000,
]


def test_parts_give_the_ids_of_the_whole_text():
    mine = Encoder(public())
    for text in TEXTS:
        whole = mine._tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(mine.ids(text), dtype="<u4").tolist() == whole, text
    assert mine.ids(None) == b""


def one_by_one(lengths, capacity):
    """Best-fit decreasing, a piece at a time: the room left in each sequence."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(12))
def test_runs_are_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 50, 100])
    lengths = [min(capacity, 1 + int(rng.expovariate(rng.choice([0.05, 0.3])))) for _ in range(rng.choice([1, 40, 400]))]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    runs = packing.best_fit(histogram, capacity)
    used = {}
    for length, count in histogram.items():
        own = [r for r in runs.tolist() if r[0] == length]
        for place in range(count):
            _, first, each, sequence, offset = [r for r in own if r[1] <= place][-1]
            k = place - first
            used.setdefault(sequence + k // each, []).append((offset + k % each * length, length))
    for parts in used.values():
        assert [o for o, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1]]
    assert sorted(capacity - sum(n for _, n in parts) for parts in used.values()) == one_by_one(lengths, capacity)
    assert len(runs) < 3 * capacity * max(1, capacity.bit_length())


def check(found, capacity):
    used = {}
    for r in found:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in used.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]]
        assert sum(n for _, n in parts) <= capacity
    return used


def test_pack(spark, frame):
    rows = [(k, t, 1) for k, t in enumerate(TEXTS)] + [(50, None, 1), (50, None, 1), (None, "x y", 1), (60, "a " * 9000, 1)]
    rows += [(100 + k, "same words here", 1) for k in range(300)]
    found = packing.pack(frame("doc_id long, text string, length int", *rows), capacity=64).collect()
    used = check(found, 64)
    mine = Encoder(public())
    expected = []
    for doc, text, _ in rows:
        ids = mine.ids(text) + bytes(4)
        expected += [(doc, at // 256, at // 4, len(ids[at : at + 256]) // 4, zlib.crc32(ids[at : at + 256])) for at in range(0, len(ids), 256)]
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted((tuple(r)[:5] for r in found), key=key) == sorted(expected, key=key)
    assert sorted(64 - sum(n for _, n in p) for p in used.values()) == one_by_one([e[3] for e in expected], 64)


def test_sequences_round_trip(spark, frame):
    docs = frame("doc_id long, text string", *[(k, t) for k, t in enumerate(TEXTS)])
    packed = packing.pack(docs, capacity=32, ids=True)
    whole = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    mine = Encoder(public())
    back = {}
    for r in packed.collect():
        part = bytes(whole[r["sequence_id"]]["ids"])[4 * r["offset"] : 4 * (r["offset"] + r["length"])]
        back.setdefault(r["doc_id"], []).append((r["piece"], part))
    assert {d: b"".join(p for _, p in sorted(v)) for d, v in back.items()} == {k: mine.ids(t) + bytes(4) for k, t in enumerate(TEXTS)}


def test_empty_table(spark, frame):
    assert packing.pack(frame("doc_id long, text string")).collect() == []
