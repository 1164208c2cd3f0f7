from fleetmart.operators.fingerprint import fingerprint, same_rows


def test_same_rows(frame):
    def made(*rows):
        return frame("a string, b string, n int", *rows)

    one = [("x", None, 1), (None, "x", 1), ("y", "z", None), ("y", "z", None)]
    assert same_rows(made(*one), made(*reversed(one)).repartition(3))
    assert not same_rows(made(*one), made(*one[:3])), "repeated rows count"
    assert not same_rows(made(*one), made(one[0], one[0], *one[2:])), "a NULL elsewhere is another row"
    assert not same_rows(made(*one), made(*one[:3], ("y", "z", 0)))
    assert same_rows(made(*one), made(*one[:3], ("y", "z", 0)), ["a", "b"])
    assert same_rows(made(), made()) and fingerprint(made()).first()["rows"] == 0
