import datetime
import decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.functions import text

D = decimal.Decimal
MONEY = T.DecimalType(10, 2)


def one(frame, value, expression):
    return frame("v string", (value,)).select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value, expected",
    [
        (" 12 ", D("12.00")),
        ("1e3", D("1000.00")),
        ("12d", None),
        ("nan", None),
        ("inf", None),
        ("1,5", None),
        ("", None),
        (None, None),
        ("2.675", D("2.68")),
        ("-2.675", D("-2.68")),
        ("2.67499999999999", D("2.67")),
        ("99999999999", None),
    ],
)
def test_numbers(frame, value, expected):
    assert one(frame, value, lambda c: text.to_decimal(c, MONEY)) == expected


@pytest.mark.parametrize("value, expected", [("99999999999", True), ("1e12", True), ("12", False), ("x", False), (None, False)])
def test_too_big(frame, value, expected):
    assert one(frame, value, lambda c: text.too_big(c, MONEY)) is expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2026-01-01 00:00:00+00:00", datetime.datetime(2026, 1, 1)),
        ("2026-01-01T03:00:00+03:00", datetime.datetime(2026, 1, 1)),
        ("2026-01-01 00:00:00.25", datetime.datetime(2026, 1, 1, 0, 0, 0, 250000)),
        ("2026-01-01", datetime.datetime(2026, 1, 1)),
        (" 2026-01-01 10:00 ", datetime.datetime(2026, 1, 1, 10)),
        ("10:00", None),
        ("2026", None),
        ("2026-02-30", None),
        ("x", None),
    ],
)
def test_times(frame, value, expected):
    got = one(frame, value, lambda c: text.to_time(c).cast("timestamp_ntz"))
    assert got == expected


@pytest.mark.parametrize("value, expected", [("5", 5), ("5.0", 5), ("5.5", None), ("five", None), ("99999999999", None)])
def test_codes(frame, value, expected):
    assert one(frame, value, text.to_code) == expected


def test_every_python_space_is_stripped(spark):
    odd = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert set(text.WHITE_SPACE) == set(odd)
    padded = "".join(odd) + "a b" + "".join(odd)
    assert spark.createDataFrame([(padded,)], "v string").select(text.strip(F.col("v"))).first()[0] == "a b"


@pytest.mark.parametrize("value, expected", [("NA", None), ("None", None), ("", None), (" NA ", "NA"), ("nano", "nano")])
def test_missing_values(frame, value, expected):
    assert one(frame, value, lambda c: text.strip(text.na_to_null(c))) == expected


def test_case(frame):
    assert one(frame, " а123вс66\t", text.strip_upper) == "А123ВС66"
    assert one(frame, " В Пути ", text.strip_lower) == "в пути"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\0"), max_size=20), min_size=1, max_size=30))
def test_strip_is_pythons(spark, values):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, v string")
    got = {r[0]: r[1] for r in df.select("n", text.strip(F.col("v"))).collect()}
    assert got == {n: v.strip() for n, v in enumerate(values)}


def test_padded_texts_are_stripped_alike(spark):
    given = ["", " ", "a", " a", "a ", "\ta b\n", "\xa0a", "a\x85", "é", "aé", "éa", "\x7fa", "a\x7f", "~", "!", "~ ", "a\x1f", "　", "a　", "日 本", None]
    df = spark.createDataFrame([(t,) for t in given], "t string").select("t", text.strip_padded(F.col("t")).alias("now"), text.strip(F.col("t")).alias("was"))
    assert [r.now for r in df.collect()] == [r.was for r in df.collect()] == [t if t is None else t.strip() for t in given]
