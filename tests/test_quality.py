import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricepanel.operators import quality as Q
from tests.conftest import day, rows

LONG = "series string, date date, value double"
R = Q.Review(dt.date(2024, 3, 4), dt.datetime(2024, 3, 4, 9), "t")  # a Monday


def dates(spark, *ns):
    return spark.createDataFrame([(day(n),) for n in ns], "date date")


def one(df):
    r = df.collect()
    assert len(r) == 1 and r[0].review_date == R.as_of and r[0].table_name == "t"
    return r[0]


def test_empty_table_is_one_error_row(spark):
    empty = spark.createDataFrame([(None, 1.0)], "date date, a double")
    r = one(Q.all_checks(empty, ["a"], R))
    assert (r.metric_group, r.metric, r.status, r.value) == ("freshness", "no_data_available", "error", None)


@pytest.mark.parametrize("last,value,status", [
    (dt.date(2024, 3, 1), 0, "ok"), (dt.date(2024, 2, 28), 2, "error"), (dt.date(2024, 3, 3), 0, "ok")])
def test_freshness(spark, last, value, status):
    r = one(Q.freshness(spark.createDataFrame([(last,)], "date date"), R))
    assert (r.value, r.status, r.data_date) == (value, status, last)


def test_duplicates(spark):
    assert one(Q.duplicate_dates(dates(spark, 0, 0, 0, 1), R)).value == 2
    r = one(Q.duplicate_dates(dates(spark, 0, 1), R))
    assert (r.status, r.detail) == ("ok", "rows=2 | dates=2")


def test_gaps(spark):
    r = one(Q.gaps(dates(spark, 0, 2, 7), R))
    assert (r.value, r.status, r.detail) == (3, "error", "2024-01-02, 2024-01-04, 2024-01-05")
    assert one(Q.gaps(dates(spark, 0, 1, 2), R)).detail == "no gaps"
    many = one(Q.gaps(dates(spark, 0, 60), R))
    assert many.value == 43 and many.detail.count(",") == 9


def test_null_share_uses_the_newest_twenty_dates(spark):
    pts = [("a", day(i), None if i >= 36 else 1.0) for i in range(40)]
    pts += [("b", day(i), None if i in (38, 39) else 1.0) for i in range(40)]
    pts += [("c", day(i), 1.0) for i in range(40)]
    got = {r.series: (r.value, r.status) for r in Q.null_share(spark.createDataFrame(pts, LONG), R).collect()}
    assert got == {"a": (20.0, "error"), "b": (10.0, "warn"), "c": (0.0, "ok")}


def test_latest_null_counts_repeated_rows(spark):
    p = spark.createDataFrame([("a", day(1), None), ("a", day(1), 2.0), ("b", day(0), None)], LONG)
    assert sorted(r.value for r in Q.latest_null(p, R).collect()) == [0.0, 1.0]


def brute_z(pdf, n=30):
    """Per series in (date, value) order, each newest-date row against the rows before it."""
    last, out = pdf["date"].max(), []
    for s, g in pdf.dropna().groupby("series"):
        v = g.sort_values(["date", "value"])
        for i in range(len(v)):
            if v["date"].iloc[i] != last:
                continue
            prev = v["value"].iloc[max(0, i - n): i].to_numpy()
            std = prev.std(ddof=1) if len(prev) > 1 else np.nan
            z = abs(v["value"].iloc[i] - prev.mean()) / std if len(prev) > 1 and std > 1e-12 else None
            out.append((s, float(v["value"].iloc[i]), None if z is None else round(float(z), 8)))
    return sorted(out, key=str)


def test_zscore_matches_brute_force_with_copies(spark):
    rng = np.random.default_rng(1)
    pts = [("a", day(i), float(v)) for i, v in enumerate(rng.normal(50, 5, 60))]
    pts += [("a", day(59), 70.0)] * 45  # a hot group of copies on the newest date
    pts += [("a", day(59), 20.0)] * 3 + [("a", day(50), 33.0)] * 40
    pts += [("b", day(59), 1.0)]  # nothing before
    pts += [("c", day(58), 1.0), ("c", day(59), 2.0)]  # one before
    pts += [("d", day(i), 3.0) for i in range(60)]  # no spread
    pts += [("e", day(58), 3.0), ("e", day(59), None)]  # null now
    pdf = pd.DataFrame(pts, columns=["series", "date", "value"])
    df = spark.createDataFrame(pts, LONG)
    z = Q.latest_zscores(Q.newest_observations(df, 31), F.lit(day(59))).collect()
    got = sorted(((r.series, r.value, None if r.zscore is None or r["std"] < 1e-12 else round(r.zscore, 8)) for r in z), key=str)
    assert got == brute_z(pdf)


def test_outlier_levels(spark):
    base = [("x", day(i), 10.0 + (i % 2)) for i in range(30)]  # mean 10.5, std 0.5085
    for v, status in [(10.5, "ok"), (11.7, "warn"), (14.0, "error")]:
        r = one(Q.outliers(spark.createDataFrame(base + [("x", day(30), v)], LONG), R))
        assert r.status == status
    assert one(Q.outliers(spark.createDataFrame([("x", day(0), 1.0)], LONG), R)).status == "na"


def test_flatline(spark):
    pts = [("flat", day(i), 1.0 if i > 2 else 9.0) for i in range(8)]
    pts += [("short", day(i), 1.0) for i in range(4)] + [("moves", day(i), float(i)) for i in range(8)]
    pts += [("copies", day(9), 2.0)] * 4 + [("copies", day(8), 3.0)] * 9 + [("hot", day(9), 2.0)] * 7
    df = spark.createDataFrame(pts, LONG)
    got = {r.series: (r.value, r.status) for r in Q.flatline(df, R).collect()}
    assert got == {"flat": (1.0, "warn"), "short": (1.0, "na"), "moves": (5.0, "ok"), "copies": (2.0, "ok"),
                   "hot": (1.0, "warn")}
    shared = Q.flatline(df, R, recent=Q.newest_observations(df, 31))
    assert {r.series: (r.value, r.status) for r in shared.collect()} == got


def test_all_checks_columns(spark):
    wide = spark.createDataFrame([(day(i), float(i), None) for i in range(10)], "date date, a double, b double")
    out = Q.all_checks(wide, ["a", "b"], R)
    assert out.columns == Q.FACT
    assert out.groupBy("metric").count().count() == 7
