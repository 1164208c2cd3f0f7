import zlib
from collections import Counter

import numpy as np

from fleetmart.llm import language, queries


def plain_grams(text, n=3):
    line = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    return Counter(line[k : k + n] for k in range(len(line) - n + 1)) if line.strip() else Counter()


def test_grams_are_the_plain_ones():
    for text in ["It's so", "  A", "a", "Größe, ÉLAN\n1x2", "123 !", "", "日本語 x", "a\U0001d504b"]:
        keys, counts = language.grams(text)
        found = {"".join(chr(k >> 21 * p & (1 << 21) - 1) for p in (2, 1, 0)): c for k, c in zip(keys.tolist(), counts.tolist(), strict=True)}
        assert found == dict(plain_grams(text)), text
    assert len(language.grams(None)[0]) == 0


def test_bundle_adds_bound_rotated_letters():
    own = language.Vectors(64, 3, 7)
    sign = lambda c: np.random.default_rng([7, ord(c)]).choice(np.array([-1, 1], dtype=np.int8), 64).astype(int)
    whole = sum(n * np.roll(sign(g[0]), 2) * np.roll(sign(g[1]), 1) * sign(g[2]) for g, n in plain_grams("some words, some").items())
    assert (own.bundle(*language.grams("some words, some")) == whole).all()


def test_query_on_held_out_texts(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r["doc_id"]: r for r in docs.collect()}
    found = queries.QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in found)
    held = [r["lang_pred"] == texts[r["doc_id"]]["lang"] for r in found if r["held_out"] and texts[r["doc_id"]]["lang"]]
    assert len(held) > 50 and sum(held) > 0.98 * len(held)


def test_odd_rows(spark, frame):
    rows = [(k, "the cat and the dog were there", "en", 0.1) for k in range(40)] + [(100 + k, "der Hund und die Katze waren da", "de", 0.1) for k in range(40)]
    rows += [(None, "the there", "de", 0.0), (300, None, "en", 0.0), (301, "123 !!", "en", 0.0), (302, "", None, 0.0), (303, "und die Hunde " * 9000, None, 0.0)]
    rows += [(300, None, "en", 0.0)]
    docs = frame("doc_id long, text string, lang string, score double", *rows)
    found = language.identify(docs).collect()
    assert len(found) == len(rows)
    own = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
    assert own[300] == own[301] == own[302] == ("und", 0.0)
    assert own[303][0] == "de" and own[None][0] == "en" and {own[k][0] for k in range(40)} == {"en"}
    assert not [r for r in found if r["doc_id"] is None][0]["held_out"]
    assert language.identify(docs.limit(0)).collect() == []
    assert {r["lang_pred"] for r in language.identify(docs.where("lang is null")).collect()} == {"und"}


def test_held_out_rows_and_other_columns_teach_nothing(spark, frame):
    rows = [(k, f"alpha beta {'x' * (k % 3)}", "en") for k in range(60)]
    changed = [(k, "completely other text" if zlib.crc32(str(k).encode()) % 5 == 0 else t, lang) for k, t, lang in rows]
    a, b = (language.prototypes(frame("doc_id long, text string, lang string", *r)) for r in (rows, changed))
    assert (a["en"] == b["en"]).all()
