import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetmart.llm import periodic_runs as pr
from fleetmart.llm import queries

FOLDER = "/root/testdata/sf0.001"


def by_hand(words, exponent=4, shortest=6):
    """All stretches of every period, word by word; of those with equal ends the least period."""
    n, found = len(words), {}
    for p in range(1, n // exponent + 1):
        k = 0
        while k + p < n:
            if words[k] != words[k + p]:
                k += 1
                continue
            first = k
            while k + p < n and words[k] == words[k + p]:
                k += 1
            if k - first + p >= max(shortest, exponent * p):
                found.setdefault((first, k - first + p), p)
    return sorted(((a, length, p) for (a, length), p in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {k for a, length, p in runs for k in range(a + p, a + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def sequence(rng):
    size, kinds = rng.choice([0, 1, 5, 6, 40, 300]), rng.choice([1, 2, 3, 40])
    words = [rng.randrange(kinds) for _ in range(size)]
    for _ in range(rng.choice([0, 1, 3])):
        unit, at = [rng.randrange(kinds) for _ in range(rng.randint(1, 30))], rng.randrange(len(words) + 1)
        words[at:at] = (unit * 9)[: rng.randint(1, 9 * len(unit))]
    return words


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("exponent,shortest", [(4, 6), (2, 2), (3, 7)])
def test_runs_against_all_periods(seed, exponent, shortest):
    rng = random.Random(seed)
    texts = [sequence(rng) for _ in range(30)] + [[0] * 500, [0, 1] * 200, [0, 1, 0, 0, 1] * 50]
    found = pr.find_runs([np.array(t, np.int64) for t in texts], exponent, shortest).tolist()
    assert [tuple(r) for r in found] == [(k, *r) for k, t in enumerate(texts) for r in by_hand(t, exponent, shortest)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=200), st.data())
def test_extensions(values, data):
    values = [*values, 3]
    pairs = data.draw(st.lists(st.tuples(*[st.integers(0, len(values) - 1)] * 2).filter(lambda p: p[0] != p[1]), min_size=1, max_size=30))
    got = pr.Extensions(np.array(values), 3, len(values)).of(*(np.array(x) for x in zip(*pairs)))
    for (i, j), length in zip(pairs, got.tolist()):
        assert values[i : i + length] == values[j : j + length]
        assert max(i, j) + length == len(values) or values[i + length] != values[j + length]


def test_only_the_cover_is_sorted():
    size = 10_000
    values = np.append(np.random.default_rng(0).integers(0, 50, size), 50)
    assert len(pr.Extensions(values, 50, size).rank) <= len(pr.COVER) * (size // pr.MODULUS + 2)
    differences = {(a - b) % pr.MODULUS for a in pr.COVER for b in pr.COVER}
    assert differences == set(range(pr.MODULUS))


def test_minima():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1000, 777).astype(np.int32)
    first, last = np.sort(rng.integers(0, 777, (2, 4000)), axis=0)
    assert pr.Minima(values).between(first, last).tolist() == [int(values[a : b + 1].min()) for a, b in zip(first, last)]


def test_odd_rows(spark):
    words = "la la la la la la one two one two one two one two end".split()
    texts = [None, "", " \t\n\x0b\x0c\r", "word", "la " * 6, "LA la " * 4, "a\x1cb " * 7, "a b " * 7, " ".join(words)]
    data = [(k, t, [1], "x") for k, t in enumerate(texts)] + [(None, "la " * 9, None, None), (8, " ".join(words), [2], "y"), (8, "other", [2], "y")]
    docs = spark.createDataFrame(data, "doc_id long, text string, runs array<int>, collapsed string")
    out = pr.periodic_runs(docs)
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed"]
    expected = []
    for k, text, _, _ in data:
        own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = by_hand(own)
        expected.append((k, len(own), runs, collapsed(own, runs)))
    found = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out.collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert sum(len(r[2]) for r in found) >= 8
    assert pr.periodic_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError, match="two periods"):
        pr.periodic_runs(docs, exponent=1)


def test_long_documents_are_searched_whole(monkeypatch):
    monkeypatch.setattr(pr, "MOST_PLACES", 1000)  # grids come in many parts
    unit = [f"w{k}" for k in range(1500)]
    words = ["a", "b", *unit * 5, *unit[:700], "b"]
    assert pr._searched([words], 4, 6).__next__()[1][1] == [{"start": 2, "length": 8200, "period": 1500}]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query(spark):
    """Every row of the query against the rule, word by word."""
    expected = []
    for doc, text in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        numbers = {w: k for k, w in enumerate(set(words))}
        runs = by_hand([numbers[w] for w in words]) if n < 4000 else [tuple(r) for r in pr.find_runs([np.array([numbers[w] for w in words])])[:, 1:].tolist()]
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        milli = best[0] is not None and 1000 * best[1] // best[2] or None
        expected.append((doc, len(runs), *best, milli, digest("".join(f"{a},{length},{p}\n" for a, length, p in runs)), digest(collapsed(words, runs))))
    out = queries.QUERIES["op11_periodic_runs"](spark, FOLDER)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(tuple(r) for r in out.collect()) == sorted(expected)
    assert sum(r[1] > 0 for r in expected) >= 10


def test_loops_of_odd_rows(spark):
    """No word to repeat, no id, one word."""
    looped = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0][:3]
    data = [(looped[0], None), (looped[0], " \n"), (looped[1], "one"), (None, "a  b"), (looped[2], "a\tb\nc  d e f g h")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = [r["text"] for r in queries.with_loops(docs).coalesce(1).collect()]
    assert found[:4] == [None, " \n", "one", "a  b"]
    assert len(found[4].split(" ")) == 8
