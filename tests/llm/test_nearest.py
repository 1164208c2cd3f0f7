import math

import numpy as np
import pytest

from fleetmart.llm import nearest as nn
from fleetmart.llm import queries

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>"


def exact(rows, asked, k):
    """Every query against every row: {id: [(score, id)]}, one entry per query row."""
    rows = sorted({(i, tuple(float(x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    out = []
    for i, v in rows:
        if asked(i):
            scores = [(-float((np.array(v) * np.array(w)).sum()), j) for j, w in rows if (j, w) != (i, v)]
            out.append((i, [(j, -s) for s, j in sorted(scores)[:k]]))
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    lists = {}
    for q, rows in out.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(rows, rows[1:]))
        lists[q] = [(j, s) for _, j, s in rows]
    return lists


def recall(got, want):
    hit = sum(len({j for j, _ in got.get(q, [])} & {j for j, _ in rows}) for q, rows in want)
    return hit / max(1, sum(len(rows) for _, rows in want))


def test_estimates_and_bounds():
    """On average the estimate is right, and the bound holds about as often as it says."""
    rng = np.random.default_rng(0)
    vectors, queries_ = rng.standard_normal((3000, 48)), rng.standard_normal((50, 48))
    codes = nn.fit(vectors[:500], 8, 128)
    assert np.allclose(codes.rotation @ codes.rotation.T, np.eye(48))
    cells = codes.cells(vectors)
    wrong, error = [], []
    for cell in range(8):
        own = vectors[cells == cell]
        packed, length, share = codes.encode(own, np.full(len(own), cell))
        assert packed.shape == (len(own), 16)
        estimate, spread = codes.estimate(queries_, cell, packed, length, share)
        miss = estimate - queries_ @ own.T
        bound = np.linalg.norm(queries_, axis=1)[:, None] * spread[None, :]
        wrong.append((np.abs(miss) > bound).mean())
        error.append(miss.mean())
    assert max(wrong) < 0.08 and abs(np.mean(error)) < 0.05


def clustered(rng, size, width=16):
    centres = rng.standard_normal((12, width))
    return [(k, (centres[rng.integers(12)] + 0.05 * rng.standard_normal(width)).tolist()) if k % 3 else (k, rng.standard_normal(width).tolist()) for k in range(size)]


def test_recall_with_many_cells_parts_and_blocks(spark, monkeypatch):
    for name, value in {"PER_CELL": 20, "VECTORS": 16, "QUERIES": 8, "PART": 1, "PAIRS": 256}.items():
        monkeypatch.setattr(nn, name, value)
    rows = clustered(np.random.default_rng(1), 1200)
    want = exact(rows, lambda i: i % 20 == 0, 10)
    got = found(nn.nearest(spark.createDataFrame(rows, SCHEMA).repartition(3), lambda i: i % 20 == 0, k=10))
    assert set(got) == {q for q, _ in want} and all(len(r) == 10 for r in got.values())
    assert recall(got, want) >= 0.95
    vectors = dict(rows)
    for q, rows_ in got.items():
        for j, score in rows_:
            assert score == pytest.approx(float((np.array(vectors[q]) * np.array(vectors[j])).sum()), abs=1e-12)


def test_copies_and_ties(spark):
    """A third of the rows is one vector; equal scores go to the smaller ids."""
    rng = np.random.default_rng(2)
    same, other = [1.0, 0.0, 2.0], [0.0, 3.0, 0.0]
    rows = [(k, same if k % 3 == 0 else other if k % 3 == 1 else rng.standard_normal(3).tolist()) for k in range(300)]
    rows += [(0, same), (0, same), (20, other)]  # a repeated row, and an id with a second vector
    want = dict()
    for q, r in exact(rows, lambda i: i % 20 == 0, 5):
        want.setdefault(q, []).append(r)
    out = nn.nearest(spark.createDataFrame(rows, SCHEMA), lambda i: i % 20 == 0, k=5).collect()
    for q, lists in want.items():
        expected = sorted((n + 1, *p) for r in lists for n, p in enumerate(r))
        assert sorted((r["rank"], r["vec_id"], r["score"]) for r in out if r["query_id"] == q) == [pytest.approx(e) for e in expected], q


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, [2.0, 1.0]), (20, [-1.0, 0.5]), (3, None), (4, []), (5, [0.0, -0.0]), (6, [nan, 1.0]), (7, [1.0, inf]),
        (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [5.0, 5.0]), (40, [0.0, 0.0]), (60, None), (11, [0.0, 1.0]), (12, [-0.0, 1.0]),
    ]
    docs = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], SCHEMA + ", rank string, score double")
    out = nn.nearest(docs, lambda i: i % 20 == 0, k=20)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert [t for _, t in out.dtypes] == ["bigint", "int", "bigint", "double"]
    sound = [(i, v) for i, v in rows if v is None or len(v) == 2]
    want = {q: [(j, pytest.approx(s)) for j, s in r] for q, r in exact(sound, lambda i: i % 20 == 0, 20)}
    assert found(out) == want and set(want) == {0, 20}
    assert nn.nearest(docs.limit(0), lambda i: i % 20 == 0).collect() == []
    assert nn.nearest(docs.where("vec_id = 0"), lambda i: i % 20 == 0).collect() == []
    assert nn.nearest(docs, lambda i: i == -1).collect() == []


def test_query(spark):
    """Recall and scores of the whole query against brute force."""
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    want = exact(rows, lambda i: i % 20 == 0, 20)
    got = found(queries.QUERIES["op12_nearest_neighbours"](spark, FOLDER))
    assert {q: len(r) for q, r in got.items()} == {q: len(r) for q, r in want}
    assert recall(got, want) >= 0.95
    vectors = dict(rows)
    assert all(abs(s - np.dot(np.array(vectors[q], float), np.array(vectors[j], float))) < 1e-12 for q, r in got.items() for j, s in r)
