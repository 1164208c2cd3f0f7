from collections import Counter
from hashlib import md5

import pytest

from fleetmart.llm import sharding


def plain_fill(names, size):
    """Every shard's whole order of preference, then turn by turn."""
    number = lambda t: int(md5(t.encode()).hexdigest()[:15], 16)
    orders = []
    for n in sorted(names):
        start, stride = number(f"{n} start") % size, number(f"{n} stride") % (size - 1) + 1
        orders.append([(start + k * stride) % size for k in range(size)])
        assert sorted(orders[-1]) == list(range(size))
    owner = {}
    while len(owner) < size:
        for k, order in enumerate(orders):
            free = [s for s in order if s not in owner]
            if free:
                owner[free[0]] = k
    return [owner[s] for s in range(size)]


@pytest.mark.parametrize(("n", "size"), [(1, 2), (3, 7), (5, 101), (16, 257)])
def test_fill(n, size):
    names = [f"s{k}" for k in range(n)]
    owner = sharding.fill([*names, names[0]], size)
    assert owner == plain_fill(names, size)
    counts = Counter(owner)
    assert max(counts.values()) - min(counts.values()) <= 1


def test_wrong_tables():
    for names, size in (([], 7), (["a"] * 3, 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.fill(names, size)


def test_assign_and_moved(spark, frame):
    names = ["a", "b", "c"]
    rows = [(k, "x", "y") for k in range(500)] + [(7, "x", "y"), (None, "x", "y")]
    docs = frame("doc_id long, shard string, text string", *rows)
    found = sharding.assign(docs, names, 101).collect()
    owner = plain_fill(names, 101)
    for r in found:
        slot = int(md5(("" if r["doc_id"] is None else str(r["doc_id"])).encode()).hexdigest()[:15], 16) % 101
        assert (r["slot"], r["shard"]) == (slot, names[owner[slot]])
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in rows)
    after = plain_fill(["a", "b"], 101)
    changed = {r["doc_id"]: (r["from"], r["to"]) for r in sharding.moved(docs, names, ["a", "b"], 101).collect()}
    assert changed == {r["doc_id"]: (r["shard"], ["a", "b"][after[r["slot"]]]) for r in found if r["shard"] != ["a", "b"][after[r["slot"]]]}
    assert sum(f != "c" for f, _ in changed.values()) < 0.2 * len(rows)
    assert sharding.assign(docs.limit(0), names, 101).collect() == []


def test_write(spark, frame, tmp_path):
    docs = frame("doc_id long, text string", *[(k, f"t{k}") for k in range(200)])
    sharding.write(docs, str(tmp_path / "out"), ["a", "b"], 101)
    back = spark.read.parquet(str(tmp_path / "out"))
    placed = {r["doc_id"]: r["shard"] for r in sharding.assign(docs, ["a", "b"], 101).collect()}
    assert {r["doc_id"]: r["shard"] for r in back.collect()} == placed
