import random
import zlib

import numpy as np
import pytest

from fleetmart.llm import queries, toxicity


def plain_grams(text):
    line = f" {text.lower()} "
    line = "".join(" " if ord(c) < 32 else c for c in line)
    found = {line[k : k + n] for n in range(2, 6) for k in range(len(line) - n + 1)}
    return {g for g in found if " " not in g[1:-1] and g != "  "}


def bucket(gram):
    value = 0
    for c in gram:
        value = (value * 0x01000193 + ord(c)) & 0xFFFFFFFF
    return ((value ^ value >> 15) * 0x9E3779B1 & 0xFFFFFFFF) >> 14


def test_features_are_the_hashed_grams():
    for text in ["An Idiot!", "a", "x\ny  z\tw", "größe ß", "ab " * 50]:
        assert toxicity.features(text).tolist() == sorted({bucket(g) for g in plain_grams(text)}), text
    assert toxicity.features(None).tolist() == toxicity.features("").tolist() == []


def test_slabs_change_nothing(monkeypatch):
    text = "".join(random.Random(1).choices("abc d", k=500))
    whole = toxicity.features(text).tolist()
    monkeypatch.setattr(toxicity, "SLAB", 7)
    assert toxicity.features(text).tolist() == whole


def test_fit_finds_the_least_loss():
    rng = np.random.default_rng(3)
    x = rng.random((200, 6)) < 0.4
    y = (x[:, 0] ^ (rng.random(200) < 0.1)).astype(float)
    values = np.array([1.5, -0.7, 0.9, 0.6, -1.2, 0.8])
    row, column = np.nonzero(x)
    weights, bias = toxicity.fit(values, row, column, y)
    z = x @ weights + bias
    off = 1 / (1 + np.exp(-z)) - y
    slope = (off @ x * values + toxicity.RIDGE * weights / values) / 200
    assert abs(slope).max() < 1e-3 and abs(off.mean()) < 1e-3


def corpus(n=400):
    rng = random.Random(5)
    docs, labels = [], []
    for k in range(n):
        words = rng.choices(["river", "stone", "paper", "window", "green", "walk"], k=rng.randint(3, 40))
        bad = k % 4 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["nasty", "nastiest", "vile"])
        docs.append((k, " ".join(words), 9))
        labels.append((k, 1, int(bad)))
    return docs, labels


def test_held_out_accuracy_and_odd_rows(spark, frame):
    docs, labels = corpus()
    docs += [(None, "nasty vile", 9), (1000, None, 9), (1001, "", 9), (1002, "river nasty " * 5000, 9), (1002, "river nasty " * 5000, 9)]
    labels += [(None, 1, 1), (1000, None, None), (1001, 1, 7), (5, 1, 0), (5, 1, 0), (5000, 1, 1)]
    d, lab = frame("doc_id long, text string, score int", *docs), frame("doc_id long, quality int, toxic int", *labels)
    found = toxicity.classify(d, lab).collect()
    assert len(found) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    truth = {k: t for k, _, t in labels if k is not None and k < 400}
    held = [r["predicted"] == truth[r["doc_id"]] for r in found if r["doc_id"] is not None and r["doc_id"] < 400 and r["held_out"]]
    assert len(held) > 50 and np.mean(held) > 0.97
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found if r["doc_id"] is not None)
    own = {r["doc_id"]: r["predicted"] for r in found}
    assert own[None] == own[1002] == 1 and own[1000] == own[1001] == 0
    kept = toxicity.keep_clean(d, toxicity.train(d, lab))
    assert kept.columns == d.columns and {r["doc_id"] for r in kept.collect()} == {k for k, p in own.items() if not p}


def test_the_fit_ends_at_the_bottom(monkeypatch):
    rng = np.random.default_rng(3)
    present = rng.random((400, 60)) < 0.2
    y = (present[:, :10].sum(axis=1) + rng.normal(0, 1, 400) > 2).astype(float)
    row, column = np.nonzero(present)
    values = rng.normal(0, 2, 60)
    weights, bias = toxicity.fit(values, row, column, y)
    off = 1 / (1 + np.exp(-(present @ weights + bias))) - y
    slope = np.append((present.T @ off) * values + toxicity.RIDGE * weights / values, off.sum()) / 400
    first = np.append((present.T @ (0.5 - y)) * values, (0.5 - y).sum()) / 400
    assert np.linalg.norm(slope) <= 1.01 * toxicity.TOLERANCE * np.linalg.norm(first)
    monkeypatch.setattr(toxicity, "MOST_LOOKS", 3)
    with pytest.raises(RuntimeError, match="converged"):
        toxicity.fit(values, row, column, y)


def test_empty_tables_and_one_label(spark, frame):
    docs, labels = frame("doc_id long, text string"), frame("doc_id long, quality int, toxic int")
    assert toxicity.classify(docs, labels).collect() == []
    some = frame("doc_id long, text string", (1, "a b"), (2, None))
    assert {(r["score"] < 1e-9, r["predicted"]) for r in toxicity.classify(some, labels).collect()} == {(True, 0)}


def test_query_on_small_tables(spark):
    folder = "/root/testdata/sf0.01"
    found = {r["doc_id"]: r for r in queries.QUERIES["op6_toxicity"](spark, folder).collect()}
    assert len(found) == queries.table(spark, folder, "documents").count()
    labels = {r["doc_id"]: r["toxic"] for r in queries.table(spark, folder, "labels").collect() if r["doc_id"] in found}
    assert np.mean([found[k]["predicted"] == t for k, t in labels.items() if found[k]["held_out"]]) > 0.9


def test_repeats_of_a_text_teach_once(frame, monkeypatch):
    docs, labels = corpus()
    lab = frame("doc_id long, quality int, toxic int", *labels)
    hot = next(k for k in range(400) if zlib.crc32(str(k).encode()) % 5 and k % 4)
    once = toxicity.train(frame("doc_id long, text string", *[d[:2] for d in docs]), lab)
    many = toxicity.train(frame("doc_id long, text string", *[d[:2] for d in docs], *[docs[hot][:2]] * 300), lab)
    assert np.array_equal(once.weights, many.weights) and once.bias == many.bias


def test_a_fit_in_tasks_is_that_of_the_driver(frame, monkeypatch):
    docs, labels = corpus(200)
    d, lab = frame("doc_id long, text string", *[r[:2] for r in docs]), frame("doc_id long, quality int, toxic int", *labels)
    monkeypatch.setattr(toxicity, "TOLERANCE", 0.05)  # few rounds
    here = toxicity.train(d, lab)
    monkeypatch.setattr(toxicity, "SENT_BYTES", 0)
    monkeypatch.setattr(toxicity, "fit", None)
    there = toxicity.train(d, lab)
    assert np.allclose(here.weights, there.weights, atol=1e-9) and abs(here.bias - there.bias) < 1e-9 and here.weights.any()
