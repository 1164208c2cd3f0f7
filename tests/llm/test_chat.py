import random

from fleetmart.llm import chat


def plain(rows):
    """Every conversation against every other one."""
    own = {}
    for nth, (conversation, turn, role, text) in enumerate(set(rows)):
        own.setdefault(("row", nth) if conversation is None else conversation, []).append((turn, role, text))
    whole = {c: [t[1:] for t in sorted(ts, key=lambda t: t[0])] for c, ts in own.items()}
    for c, turns in whole.items():
        longer = any(len(o) > len(turns) and o[: len(turns)] == turns for o in whole.values())
        equal = [k for k, o in whole.items() if o == turns]
        if not longer and c == min(equal, key=lambda k: (isinstance(k, tuple), k)):
            yield None if isinstance(c, tuple) else c, len(turns), "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in turns)


def test_against_every_pair(frame):
    rng = random.Random(6)
    rows = []
    for k in range(120):
        n = rng.randint(1, 6)
        rows += [(k, t, ["user", "assistant", None][rng.choice([0, 0, 1, 2])] if rng.random() < 0.2 else "user", rng.choice(["a", "b", "", None])) for t in range(n)]
    rows += [(200, t, "user", "long " * 2000) for t in range(30)] + [(201, t, "user", "long " * 2000) for t in range(29)]
    rows += [(None, 0, "user", "a"), (300, 5, "user", "only"), (301, 9, "user", "only"), rows[0], rows[0]]
    found = chat.format_chats(frame("conv_id long, turn int, role string, text string", *rows).selectExpr("*", "1 as conversation", "2 as x", "3 as kept"))
    expected = sorted(plain(rows), key=str)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected and len(expected) > 20


def test_ties_and_nulls(frame):
    rows = [(1, 0, "user", "x"), (1, 0, "user", "y"), (2, 0, "user", "y"), (2, 0, "user", "x"), (2, 1, None, None), (3, None, "user", "z"), (3, 0, "user", "w")]
    found = {r["conv_id"]: r for r in chat.format_chats(frame("conv_id long, turn int, role string, text string", *rows)).collect()}
    assert sorted(found) == [2, 3] and found[2]["n_turns"] == 3
    assert found[3]["text"] == "<|im_start|>user\nz<|im_end|>\n<|im_start|>user\nw<|im_end|>\n"
    assert found[2]["text"].endswith("<|im_start|>\n<|im_end|>\n")


def test_rows_without_an_id_stand_alone(spark, frame):
    """Most rows have none, and most of these are one row again and again."""
    rows = [(None, 0, "user", "again")] * 300 + [(None, k % 3, "user", f"own {k}") for k in range(50)] + [(None, None, None, None), (None, 1, "user", "")]
    rows += [(1, 0, "user", "own 1"), (1, 1, "user", "more"), (2, 0, "user", "own 2"), (3, 0, "user", "again"), (3, 1, "user", "own 4")]
    found = chat.format_chats(frame("conv_id long, turn int, role string, text string", *rows).repartition(4))
    expected = sorted(plain(rows), key=str)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected and len(expected) == 53
    assert max(r["count"] for r in chat._turns(frame("conv_id long, turn int, role string, text string", *set(rows)), "conv_id", "turn", "role", "text").groupBy("key").count().collect()) == 2


def test_empty_table(frame):
    assert chat.format_chats(frame("conv_id long, turn int, role string, text string")).collect() == []


def test_long_conversations_by_ranges(spark, frame, monkeypatch):
    rng = random.Random(7)
    said = [(t // 3, rng.choice(["user", None]), f"{t} {rng.choice('abc')}") for t in range(400)]
    rows = [(c, *t) for c, n in ((1, 400), (2, 399), (3, 130), (4, 400), (None, 60), (5, 2)) for t in said[:n]]
    rows += [(6, *t) for t in said[:200]] + [(6, 500, "user", "another end"), (7, 0, "user", "short"), (8, None, None, None)] + rows[:50]
    turns = chat._turns(frame("conv_id long, turn int, role string, text string", *rows).repartition(5), "conv_id", "turn", "role", "text")
    whole = sorted(map(tuple, chat.prefixes(turns).collect()), key=str)
    monkeypatch.setattr(chat, "RANGE", 100)
    assert sorted(map(tuple, chat.prefixes(turns).collect()), key=str) == whole
    ranges = []
    monkeypatch.setattr(chat, "materialize", lambda df, label: ranges.append((label, kept := df.localCheckpoint())) or kept)
    assert sorted(map(tuple, chat.prefixes(turns).collect()), key=str) == whole
    dealt = dict(ranges)["ranges"].groupBy("key").agg({"part": "max", "*": "count"}).collect()
    assert {r["key"] for r in dealt} == {"id 1", "id 2", "id 3", "id 4", "id 6"}
    assert dict(ranges)["ranges"].select("part").distinct().count() > 1
