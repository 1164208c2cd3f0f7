import random
import re
from collections import Counter

import numpy as np
import pytest

from fleetmart.llm import decontamination as dec
from fleetmart.llm import queries


def plain(text, item, least=0.8):
    """Best similarity over all item-sized windows, by comparing every window."""
    words, own = re.findall(r"\w+", (text or "").lower()), re.findall(r"\w+", (item or "").lower())
    if not own:
        return 0.0
    if len(own) < 5:
        return float(words == own)
    size = 5
    cut = lambda w: Counter(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    best, goal = 0.0, cut(own)
    for at in range(max(1, len(words) - len(own) + 1)):
        window = cut(words[at : at + len(own)])
        common = sum(min(window[s], goal[s]) for s in window)
        best = max(best, common / (sum(window.values()) + sum(goal.values()) - common))
    return best


def corpus(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    make = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(k, make(rng.choice([1, 3, 5, 9, 14, 30, 60]))) for k in range(40)] + [(90, None), (91, ""), (92, "?!")]
    docs = []
    for k in range(200):
        words = make(rng.randint(0, 200)).split()
        for _ in range(rng.choice([0, 3, 4, 5])):
            own = (rng.choice(items[:40])[1]).split()
            for _ in range(rng.choice([0, 0, 1, 3])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            own = own[rng.choice([0, 0, 1, 4]) :]
            at = rng.randint(0, len(words))
            words[at:at] = own
        docs.append((k, rng.choice([" ", ", ", "\n"]).join(words).title() if k % 3 else " ".join(words)))
    short = next(item for _, item in items[:40] if len(item.split()) == 3)
    docs += [(310, short), (311, short.upper() + "!"), (312, f"{short} more"), (313, short.split()[0])]
    return docs + [(300, items[9][1]), (301, None), (302, ""), (303, " ".join(items[30][1].split()[:-1]))], items


def test_near_finds_all_within_the_radius():
    rng = random.Random(1)
    index = dec.Index([(k, " ".join(f"{rng.random()}" for _ in range(4))) for k in range(300)])
    base = index.prints[rng.randrange(300)]
    index.prints = np.array([int(base) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 40))) for _ in range(300)], dtype=np.uint64)
    index.sizes[:] = 8
    for k, (low, width, near, _, _) in enumerate(index.blocks):
        keys = index._keys(index.prints, index.sizes, low, width)
        order = np.argsort(keys, kind="stable")
        index.blocks[k] = (low, width, near, keys[order], order)
    window, item = index.near(index.prints[:50], 8)
    expected = {(a, b) for a in range(50) for b in range(300) if int(index.prints[a] ^ index.prints[b]).bit_count() <= dec.RADIUS}
    assert {*zip(window.tolist(), item.tolist(), strict=True)} == expected


@pytest.mark.parametrize(("chars", "slab"), [(10**6, 1 << 15), (400, 16)])
def test_against_every_window(spark, frame, monkeypatch, chars, slab):
    monkeypatch.setattr(dec, "BLOCK_CHARS", chars)
    monkeypatch.setattr(dec, "SLAB", slab)
    docs, items = corpus()
    index = dec.Index(items)
    found = {(k, index.ids[i]): s for k, text in docs for i, s, _, _ in index.find(text)}
    expected = {(k, i): s for k, text in docs for i, item in items if (s := plain(text, item)) >= 0.8}
    assert found == expected and len(expected) > 100
    if chars < 1000:
        d = frame("doc_id long, text string", *docs).selectExpr("*", "1 as item_id", "2 as similarity")
        b = frame("item_id long, text string", *items)
        rows = dec.matches(d, b).collect()
        assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows} == expected and len(rows) == len(expected)
        kept = dec.keep_clean(d, b)
        assert kept.columns == d.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted({k for k, _ in docs} - {k for k, _ in expected})


@pytest.mark.parametrize("different", [1, 2, 3, 8, 16])
@pytest.mark.parametrize("slab", [1 << 15, 32])
def test_items_of_few_shingles_are_never_missed(monkeypatch, different, slab):
    """Words that go round, shifted, cut short or changed in places, against every window."""
    monkeypatch.setattr(dec, "SLAB", slab)
    rng = random.Random(different)
    items, docs = [], []
    for k in range(12):
        ring = [f"r{k}x{j}" for j in range(different)]
        size = rng.randint(max(6, different), 120)
        items.append((k, " ".join(ring[j % different] for j in range(size))))
        for shift in (0, 1):
            words = [ring[(j + shift) % different] for j in range(size - rng.choice([0, 0, 2]))]
            for _ in range(rng.choice([0, 0, 1])):
                words[rng.randrange(len(words))] = "other"
            docs.append(" ".join(["before"] * rng.choice([0, 3, 40]) + words + ["after"] * rng.choice([0, 50])))
    index = dec.Index(items)
    assert len(index.simple) == 12
    found = {(d, index.ids[i]): s for d, text in enumerate(docs) for i, s, _, _ in index.find(text)}
    expected = {(d, i): s for d, text in enumerate(docs) for i, item in items if (s := plain(text, item)) >= 0.8}
    assert found == expected and len(expected) >= 12


def test_slabs_and_places():
    words = [f"x{k}" for k in range(1 << 16)]
    words[40000:40000] = [f"i{k}" for k in range(33)]
    index = dec.Index([(1, " ".join(f"i{k}" for k in range(33)))])
    assert index.find(" ".join(words)) == [(0, 1.0, 40000, 33)]


def test_odd_rows(frame):
    docs = frame("doc_id long, text string", (1, "one two three four five six seven"), (1, "one two three four five six seven"), (None, "one two three four five six seven"), (2, None))
    items = frame("item_id long, text string", (7, "One two, three four five six!"), (7, "One two, three four five six!"), (None, "two three four five six"), (8, None), (9, "four five"))
    found = sorted(((r["doc_id"], r["item_id"]) for r in dec.matches(docs, items).collect()), key=str)
    assert found == sorted([(1, 7)] * 4 + [(1, None)] * 2 + [(None, 7)] * 2 + [(None, None)], key=str)
    none = docs.limit(0)
    assert dec.matches(none, items).collect() == [] == dec.matches(docs, items.limit(0)).collect() == dec.keep_clean(none, items).collect()
    assert dec.keep_clean(docs, items.limit(0)).count() == 4


def test_query_on_the_smallest_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = queries.table(spark, folder, "documents").collect()
    items = queries.table(spark, folder, "benchmark").collect()
    found = queries.QUERIES["op2_benchmark_decontamination"](spark, folder).collect()
    expected = {}
    for d in docs:
        shingles = lambda t: {tuple(w[k : k + 5]) for w in [re.findall(r"\w+", t.lower())] for k in range(len(w) - 4)}
        own = shingles(d["text"])
        for i in items:
            if own & shingles(i["text"]) and (s := plain(d["text"], i["text"])) >= 0.8:
                expected[d["doc_id"], i["item_id"]] = s
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in found} == expected and expected
