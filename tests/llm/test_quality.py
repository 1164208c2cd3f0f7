import math
import random
import re
from collections import Counter

import numpy as np
import regex

from fleetmart.llm import quality, queries


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_measures(text):
    text, words = text or "", plain_words(text)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    inside = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if plain_words(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(inside)


def texts():
    rng = random.Random(2)
    found = [None, "", " \n\t", "one", "a\x1cb c\x85d \xa0 e f", "x\n x\nx\n\n\ny\ny", "|" * 50, "Größe <b> # $ 日本 " * 3, "a " * 8, "a " * 9]
    for _ in range(200):
        line = " ".join(rng.choices("ab", k=rng.randint(1, 30)))
        found.append(rng.choice(["\n", " "]).join([line] * rng.randint(1, 3) + [" ".join(rng.choices("abc", k=rng.randint(0, 40)))]))
    return found


def test_measures_are_the_plain_ones():
    for text in texts():
        words = (text or "").encode().split()
        assert quality.measures(text, words) == plain_measures(text), text


def plain_counts(texts):
    counts = np.zeros(quality.BUCKETS)
    for text in texts:
        tokens = [t for w in plain_words(text) for t in regex.findall(r"\w+|[^\w\s]+", w.lower())]
        hashes = [quality.xxh32_intdigest(t.encode()) for t in tokens]
        for h in hashes:
            counts[h % quality.BUCKETS] += 1
        for a, b in zip(hashes, hashes[1:], strict=False):
            p = a * 0x85EBCA6B & 0xFFFFFFFF ^ b * 0xC2B2AE35 & 0xFFFFFFFF
            counts[(p ^ p >> 16) % quality.BUCKETS] += 1
    return counts


def plain_rule(docs, labels):
    """Ratios and threshold, each trusted text against counts made without it."""
    good = {k for k, q in labels if q == 1 and k is not None}
    corpus, trusted = plain_counts([t for _, t in docs]) + 1, [t for k, t in docs if k in good]
    corpus /= corpus.sum()

    def ratio(counts):
        counts = counts + counts.sum() / 8 * corpus
        return np.log(counts / counts.sum()) - np.log(corpus) if counts.sum() else np.zeros(quality.BUCKETS)

    scores, own = [], [plain_counts([t]) for t in trusted]
    whole = sum(own, np.zeros(quality.BUCKETS))
    for text, counts in zip(trusted, own):
        base, others = plain_measures(text), ratio(whole - counts)
        if base[0] >= 20 and 100 * base[4] <= 30 * base[0] and others.any():
            scores.append(counts @ others / counts.sum())
    if not scores:
        return ratio(whole), -0.25
    spread = max(max(scores) - min(scores), -min(scores))
    return ratio(whole), min(-0.25, min(scores) - spread * max(0.25, 2.5 / len(scores) ** 0.5))


def check(spark, found, docs, labels):
    """Every column of ``found`` against counts made in plain Python."""
    ratio, threshold = plain_rule(docs, labels)
    expected = []
    for k, text in docs:
        own, counts = plain_measures(text), plain_counts([text])
        bad = own[0] < 20 or 100 * own[4] > 30 * own[0]
        mean = float(counts @ ratio / counts.sum()) if counts.sum() else 0.0
        expected.append((k, *own, bad, mean, not bad and mean >= threshold))
    key = lambda r: str(r[:6])
    for a, b in zip(sorted(map(tuple, found), key=key), sorted(expected, key=key), strict=True):
        assert a[:7] == b[:7] and a[8] == b[8] and math.isclose(a[7], b[7], abs_tol=1e-9), (a, b)


def test_against_plain_counts(spark, frame, monkeypatch):
    docs = [(k if k % 7 else None, t) for k, t in enumerate(texts())] + [(3, "one"), (900, "some word ### " * 60), (901, "w" * 40000)]
    labels = [(k, k % 2) for k in range(0, 200)] + [(4, 1), (4, 1), (None, 1), (7, None)]
    d, lab = frame("doc_id long, text string", *docs).selectExpr("*", "1 as score", "true as _trusted"), frame("doc_id long, quality int", *labels)
    check(spark, quality.rate(d, lab).collect(), docs, labels)
    monkeypatch.setattr(quality, "SENT_IDS", 1)
    monkeypatch.setattr(quality, "COUNTED", 100)
    check(spark, quality.rate(d, lab).collect(), docs, labels)
    kept = quality.keep_good(d, quality.ratios(d, lab))
    assert kept.columns == d.columns
    ids = sorted(str(r["doc_id"]) for r in quality.rate(d, lab).where("kept").collect())
    assert ids == sorted(str(r["doc_id"]) for r in kept.collect())


def test_empty_tables(spark, frame):
    docs, labels = frame("doc_id long, text string"), frame("doc_id long, quality int")
    assert quality.rate(docs, labels).collect() == []
    some = frame("doc_id long, text string", (1, " ".join(f"w{k}" for k in range(30))), (2, "short"))
    assert {r["doc_id"]: (r["base_failed"], r["kept"], r["score"]) for r in quality.rate(some, labels).collect()} == {1: (False, True, 0.0), 2: (True, False, 0.0)}


def test_query_on_the_smallest_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in queries.table(spark, folder, "documents").collect()]
    labels = [(r["doc_id"], r["quality"]) for r in queries.table(spark, folder, "labels").collect()]
    check(spark, queries.QUERIES["op9_quality_rules"](spark, folder).collect(), docs, labels)


def test_few_trusted_texts_lose_no_good_ones(spark):
    """Of the documents kept with all labels less than a twentieth is lost with some of them, or with few of a language."""
    folder = "/root/testdata/sf0.1"
    docs, labels = queries.table(spark, folder, "documents"), queries.table(spark, folder, "labels")
    good = sorted(r["doc_id"] for r in labels.where("quality = 1").select("doc_id").distinct().collect())
    german = {r["doc_id"] for r in docs.where("lang = 'de'").select("doc_id").collect()}
    draw = random.Random(4).sample
    sets = [good, draw(good, 10), draw(good, 40), [k for k in good if k not in german] + draw([k for k in good if k in german], 48)]
    own = []
    for r in docs.select("text").collect():
        words = (r["text"] or "").encode().split()
        if len(words) >= 20 and not quality.failed(len(words), quality.repeated_words(words)):
            own.append(np.concatenate(list(quality.buckets(words))))
    ends = np.cumsum([len(b) for b in own])
    found = []
    for some in sets:
        rule = quality.ratios(docs, spark.createDataFrame([(k, 1) for k in some], "doc_id long, quality int"))
        sums = np.add.reduceat(rule.ratio[np.concatenate(own)], np.append(0, ends[:-1]))
        found.append(sums / np.diff(ends, prepend=0) >= rule.threshold)
    assert found[0].sum() > 8000
    assert [bool((found[0] & ~few).sum() < 0.05 * found[0].sum()) for few in found[1:]] == [True] * 3
    poor = {r["doc_id"] for r in labels.where("quality = 0").select("doc_id").distinct().collect()}
    assert found[0].sum() < len(own) - len(poor) / 3, "most of the poor documents go"
