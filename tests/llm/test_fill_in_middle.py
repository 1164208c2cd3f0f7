import hashlib
import random

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from fleetmart.llm import fill_in_middle as fim

TEXTS = ["", "a", "ab", "naïve 日本語 👩‍👩‍👧 é", "x" * 9, "<", "<P", "P><S", "line\n\nline two\n", "😀" * 500, " ", "<<<S", "<P>inside"]


@pytest.mark.parametrize("seed", range(6))
def test_every_rank_is_found(seed):
    rng = random.Random(seed)
    size = [0, 1, 7, 60, 700, 5000][seed]
    widths = np.array([rng.randint(1, 9) for _ in range(size)], np.int64)
    units, before = fim.SkipList(widths), np.concatenate([[0], np.cumsum(widths)])
    assert [units.find(k) for k in range(size + 1)] == before.tolist()
    plain = fim.SkipList(size)
    assert [plain.find(k) for k in range(size + 1)] == list(range(size + 1))


def test_long_lists_have_short_lanes():
    size = 3 * fim._BLOCK + 17
    units = fim.SkipList(np.full(size, 2))
    for lane, (wide, long, below) in enumerate(units.lanes):
        assert wide.sum() == size and long.sum() == 2 * size
        assert below is None or len(below) < 0.2 * len(units.lanes[lane - 1][0])
    assert len(units.lanes[-1][0]) <= fim.FEW
    for rank in (0, 1, fim._BLOCK - 1, fim._BLOCK, fim._BLOCK + 1, size - 1, size):
        assert units.find(rank) == 2 * rank
    assert fim.SkipList(10**8).find(98_765_432) == 98_765_432


def plainly(name, text):
    """The rule of the query, by slices."""
    h = [int(hashlib.sha256(f"1:{name}".encode()).hexdigest()[k : k + 8], 16) for k in (0, 8, 16, 24)]
    text = text or ""
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(text), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(text), "spm", a, b - a, "<S>" + text[b:] + "<P>" + text[:a] + "<M>" + text[a:b]
    return len(text), "psm", a, b - a, "<P>" + text[:a] + "<S>" + text[b:] + "<M>" + text[a:b]


def test_against_slices_and_back(spark):
    data = [(k, TEXTS[k % len(TEXTS)]) for k in range(300)] + [(7, "again"), (7, "again"), (8, None), (None, "nameless"), (None, None)]
    docs = spark.createDataFrame([(k, t, "clash", 1, t) for k, t in data], "doc_id long, text string, form string, n int, output string")
    out = fim.fill_in_middle(docs)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    found = sorted((tuple(r) for r in out.collect()), key=str)
    assert found == sorted([(k, *plainly("" if k is None else k, t)) for k, t in data], key=str)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}
    back = sorted((tuple(r) for r in out.select("doc_id", fim.restored(F.col("output"), F.col("form"))).collect()), key=str)
    assert back == sorted([(k, t or "") for k, t in data], key=str)
    assert fim.fill_in_middle(docs.limit(0)).collect() == []


@pytest.mark.parametrize("unit", [r"\S+", r"[^\n]*\n", r"\X", "z"])
def test_other_units(spark, unit):
    docs = spark.createDataFrame([(k, TEXTS[k % len(TEXTS)] * 3) for k in range(100)], "doc_id long, text string")
    out = fim.fill_in_middle(docs, unit=unit).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in out.collect():
        text, starts = texts[r["doc_id"]], [m.start() for m in regex.finditer(unit, texts[r["doc_id"]]) if m.group()]
        assert r["back"] == text
        assert r["n"] == (len(starts) or int(bool(text)))
        if r["form"] != "plain":
            ends = {0, len(text), *starts[1:]}
            assert r["prefix_chars"] in ends and r["prefix_chars"] + r["middle_chars"] in ends


def test_long_texts_leave_in_parts(spark):
    long = "é" * 9_000_000
    docs = spark.createDataFrame([(k, long if k % 2 else "short") for k in range(4)], "doc_id long, text string").coalesce(1)
    back = fim.fill_in_middle(docs).select(F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("s"))
    assert {r["s"] for r in back.collect()} == {hashlib.sha256(t.encode()).hexdigest() for t in (long, "short")}
