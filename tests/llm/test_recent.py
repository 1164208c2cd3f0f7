from fleetmart.llm import recent


def test_recent_is_bounded_and_keeps_what_is_used():
    made = []
    own = recent.Recent(lambda k: made.append(k) or k.upper(), 3)
    assert [own[k] for k in "abcabc"] == list("ABCABC") and made == list("abc")
    assert own["d"] == "D" and own["a"] == "A" and made == list("abcd")
    for k in "efghij":
        assert own[k] == k.upper() and len(own) <= 3 and len(own.before) <= 3
    assert own["a"] == "A" and made[-1] == "a"
    long = "x" * (recent.LONGEST + 1)
    assert own[long] == own[long] == long.upper() and made[-2:] == [long, long]


def test_one_object_is_kept():
    a = recent.kept("a", object)
    assert recent.kept("a", object) is a
    b = recent.kept("b", object)
    assert recent.kept("b", object) is b and recent.kept("a", object) is not a
