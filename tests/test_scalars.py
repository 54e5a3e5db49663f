"""Edge rows of the scalar rules."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loadstone.functions import scalar


def value(spark, column, **inputs):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in inputs.items())
    frame = spark.createDataFrame([tuple(v for _, v in inputs.values())], schema)
    return frame.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text, expected", [
    ("01/31/2009 09:30", datetime(2009, 1, 31, 9, 30)),
    ("1/5/2009 9:05", datetime(2009, 1, 5, 9, 5)),
    ("01/31/2009 13:15", datetime(2009, 1, 31, 13, 15)),
    ("01/31/2009 12:15", datetime(2009, 1, 31, 0, 15)),
    ("01/31/2009 10:15 PM", datetime(2009, 1, 31, 10, 15)),
    ("13/01/2008 10:00", datetime(2009, 1, 1, 10, 0)),
    ("02/30/2009 10:00", datetime(2009, 3, 2, 10, 0)),
    ("01.31.2009 09:30 PM", datetime(2009, 1, 31, 21, 30)),
    ("01.31.2009 12:30 AM", datetime(2009, 1, 31, 0, 30)),
    ("01.31.2009 12:30 PM", datetime(2009, 1, 31, 12, 30)),
    ("Sat Jan 31 21:30:15 EST 2009", datetime(2009, 2, 1, 2, 30, 15)),
    ("01.31.2009 21:30 UTC", datetime(2009, 1, 31, 21, 30)),
    ("01.31.2009 21:30 -0500", datetime(2009, 2, 1, 2, 30)),
    ("2009-01-31 21:30:15.123", datetime(2009, 1, 31, 21, 30, 15)),
    ("2009-01-31", None), ("soon", None), ("", None), (None, None),
])
def test_parse_timestamp(spark, text, expected):
    assert value(spark, scalar.parse_timestamp("t"), t=("string", text)) == expected


@pytest.mark.parametrize("kind, answer, expected", [
    (1, "1", 1), (1, "1/4", 1), (1, "4/4", 4), (1, "5", 15), (1, "10/10", 20), (1, "abc", None),
    (2, "1", 11), (2, "7/10", 17), (2, "2/4", None), (3, "1", None), (4, "Yes", 5), (4, "1", 5), (4, "No", 6), (4, " ", None),
    (5, "42", 42), (5, " 42", None), (5, "abc", None), (5, "0", None), (1, None, None),
])
def test_evaluation_id(spark, kind, answer, expected):
    assert value(spark, scalar.evaluation_id("k", "a"), k=("int", kind), a=("string", answer)) == expected


@pytest.mark.parametrize("text, checked, expected", [
    ("3/7", True, (3, 7)), ("x/y", True, (1, 1)), ("x/7", False, (None, 7)), ("7", True, (1, 1)), ("3/", True, (1, 1)),
    (None, True, (1, 1)), ("3/7/9", True, (3, 7)), ("/7", True, (1, 1)),
])
def test_ratio(spark, text, checked, expected):
    got = tuple(value(spark, scalar.ratio_part("t", part, checked), t=("string", text)) for part in (1, 2))
    assert got == expected


def test_header_cut(spark):
    cases = {
        "a" * 249 + "\n" + "b" * 100: "a" * 249 + "\n...",
        "a" * 250 + "\n" + "b": "a" * 250 + "\n...",
        "a" * 251 + "\n" + "b": "a" * 251 + "\nb",
        "one two " + "c" * 400: "one two...",
        "a" * 250 + " b": "a" * 250 + "...",
        "a" * 251 + " b": "a" * 251 + " b",
        "x" * 400: "x" * 400,
        "short\ntext": "short\n...",
        "": "",
    }
    for text, expected in cases.items():
        assert value(spark, scalar.header_cut("t"), t=("string", text)) == expected
    assert value(spark, scalar.header_cut("t"), t=("string", None)) is None


def test_paths_and_codes(spark):
    for path, expected in (("f", "d/f"), ("/f", "d//f"), ("a/f", "a/f"), (None, None)):
        assert value(spark, scalar.path_prefix("p", "d"), p=("string", path)) == expected
    for code, expected in ((None, ""), (" 7 ", "007"), ("840", "840"), ("", "000")):
        assert value(spark, scalar.pad_code("c"), c=("string", code)) == expected


@pytest.mark.parametrize("total, placements, place, expected", [
    (450.0, 1, 1, 450.0), (450.0, 2, 2, 135.0), (451.0, 3, 2, 112.75), (450.0, 7, 5, 27.0), (450.0, 7, 6, 0.0),
    (450.0, 7, 0, 0.0), (450.0, 0, 1, 0.0), (0.0, 3, 1, 0.0), (0.07, 5, 4, 0.01), (450.0, 2, 5, 0.0), (450.0, 2, None, 0.0),
])
def test_placement_points(spark, total, placements, place, expected):
    column = scalar.placement_points("t", "n", "p")
    assert value(spark, column, t=("double", total), n=("int", placements), p=("int", place)) == expected


def test_durations_and_fees(spark):
    day = datetime(2009, 1, 1)
    later = datetime(2009, 1, 1, 1, 0, 59)
    duration = scalar.duration_minutes("a", "b")
    for start, end, expected in ((day, later, 60), (later, day, None), (day, None, None), (day, day, 0)):
        assert value(spark, duration, a=("timestamp_ntz", start), b=("timestamp_ntz", end)) == expected
    fee = scalar.admin_fee(F.col("s"), F.col("f"), F.col("p"), F.col("t"))
    for status, fixed_fee, share, expected in ((7, 10.0, None, 10.0), (4, 10.0, 0.0, 0.0), (4, 10.0, 0.5, 50.0), (7, None, 1e-6, 0.0)):
        got = value(spark, fee, s=("int", status), f=("double", fixed_fee), p=("double", share), t=("double", 100.0))
        assert got == expected


def test_flags_and_sentinels(spark):
    for text, expected in ((None, None), ("Succeeded", 1), ("succeeded", 0)):
        assert value(spark, scalar.success_flag("t"), t=("string", text)) == expected
    for text, expected in (("On", 1), ("Yes", 1), ("Off", 0), (None, 0)):
        assert value(spark, scalar.flag("t", "On", "Yes"), t=("string", text)) == expected
    for text, expected in (("0", None), ("-3", None), ("12", 12), ("x", None), (None, None)):
        assert value(spark, scalar.billing_id("t"), t=("string", text)) == expected
    assert value(spark, scalar.rating_key("r"), r=("int", None)) == -2
    picked = scalar.pick_by_code("c", {1: "a", 2: "b"})
    for code, expected in ((1, 5), (2, None), (3, None), (None, None)):
        assert value(spark, picked, c=("int", code), a=("bigint", 5), b=("bigint", 0)) == expected
