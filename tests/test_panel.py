import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricepanel.operators import panel as P
from pricepanel.schema import columns_of, panel_schema
from tests.conftest import day, rows


def test_sanitize_keeps_last_row_and_first_column(spark):
    df = spark.createDataFrame(
        [("2024-01-01 05:00:00", 1, 1.0, 9.0), ("2024-01-01", 2, 2.0, 8.0), ("nope", 3, 3.0, 7.0), (None, 4, 4.0, 6.0)],
        "date string, pos int, v double, w double").toDF("date", "pos", "v", "v")
    out = P.sanitize(df, order=["pos"])
    assert out.columns == ["date", "v"]
    assert rows(out) == [(day(0), 2.0)]


def test_keep_last_is_whole_row_and_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("a", 1, "x", None), ("a", 2, "y", 5.0), ("a", 2, "y", 7.0), ("b", 1, "z", 1.0)],
                               "k string, o int, s string, v double")
    assert rows(P.keep_last(df, ["k"], ["o"]), "k") == [("a", 2, "y", 7.0), ("b", 1, "z", 1.0)]


def test_to_long_null_choice_and_round_trip(spark):
    wide = spark.createDataFrame([(day(0), 1.0, None), (day(1), None, None)], "date date, a double, b double")
    assert P.to_long(wide, ["a", "b"], keep_nulls=True).count() == 4
    long = P.to_long(wide, ["a", "b"], keep_nulls=False)
    assert rows(long) == [(day(0), "a", 1.0)]
    back = P.to_wide(P.to_long(wide, ["a", "b"], keep_nulls=True), ["a", "b"], ["date"])
    assert rows(back, "date") == rows(wide, "date")


def test_reconcile_case_alternate_missing_extra(spark):
    raw = spark.createDataFrame([("2024-01-01", 1, 2, 3)], "DATE string, GOLD int, `BRK-B` int, extra int")
    out = P.reconcile(raw, panel_schema(["gold", "BRK_B", "gas"], "Date"), {"BRK_B": "BRK-B"})
    assert out.dtypes == [("gold", "double"), ("BRK_B", "double"), ("gas", "double"), ("Date", "date")]
    assert rows(out) == [(1.0, 2.0, None, day(0))]


def test_safe_cast(spark):
    df = spark.createDataFrame([("x", "2024-01-01")], "a string, d string")
    assert rows(P.safe_cast(df, columns_of("a double, d date"))) == [(None, day(0))]


def test_outer_and_left_align(spark):
    a = spark.createDataFrame([(day(0), 1.0), (day(1), None)], "date date, a double")
    b = spark.createDataFrame([(day(1), 5.0, 9.0), (day(2), 6.0, 9.0)], "date date, b double, a double")
    assert rows(P.outer_align([a, b]), "date") == [(day(0), 1.0, None), (day(1), None, 5.0), (day(2), None, 6.0)]
    # dates only later series have are lost
    assert rows(P.left_align(a, [b]), "date") == [(day(0), 1.0, None), (day(1), None, 5.0)]


def test_calendars(spark):
    df = spark.createDataFrame([(day(0),), (day(8),)], "date date")
    assert [r[0].weekday() for r in rows(P.business_calendar(df), "date")] == [0, 1, 2, 3, 4, 0, 1]
    assert P.business_calendar(df.where("false")).count() == 0
    long = spark.createDataFrame([("a", day(4), 1.0), ("b", day(6), None)], "series string, date date, value double")
    assert rows(P.future_dates(long, 2), "step") == [(1, day(7)), (2, day(8))]
    assert P.future_dates(long, 2, ["series"]).count() == 2


def test_replicate_rename_lookup(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    assert P.replicate(df, ["x", "y"]).count() == 2
    assert P.rename(df, {"k": "key", "missing": "m"}).columns == ["key", "v"]
    dim = spark.createDataFrame([(1, "one")], "k int, name string")
    assert rows(P.look_up(df, dim, ["k"])) == [(1, 2, "one")]
    assert P.lower_names(df.toDF(" K", "V ")).columns == ["k", "v"]
