import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricepanel.functions import dates, numbers, transforms
from pricepanel.operators.features import power_transform
from pricepanel.operators.scoring import chi2_tail
from tests.conftest import rows


def test_expected_date_is_the_weekday_before(spark):
    days = [(dt.date(2024, 1, d),) for d in range(5, 13)]  # Friday .. Friday
    df = spark.createDataFrame(days, "d date").select("d", dates.expected_data_date(F.col("d")).alias("e"))
    back = {r.d.day: r.e.day for r in df.collect()}
    assert back == {5: 4, 6: 5, 7: 5, 8: 5, 9: 8, 10: 9, 11: 10, 12: 11}


def test_next_business_days_skip_weekends(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 8)], "d date")
    for r in df.select("d", dates.next_business_days(F.col("d"), 10).alias("n")).collect():
        want = np.busday_offset(np.datetime64(r.d), range(1, 11), roll="backward").astype(object).tolist()
        assert r.n == want


def test_years_before_clamps_leap_day(spark):
    d = spark.createDataFrame([(dt.date(2024, 2, 29),)], "d date")
    assert d.select(dates.years_before(F.col("d"), 10)).first()[0] == dt.date(2014, 2, 28)


def test_clean_number(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), ("Infinity",), ("-Infinity",), (None,)], "s string")
    assert [r[0] for r in df.select(numbers.clean_number(F.col("s"))).collect()] == [1.5, None, None, None, None, None]


def test_floor_keeps_null_and_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(None, 1.0), (-2.0, 0.0), (3.0, 2.0)], "a double, b double")
    got = rows(df.select(numbers.at_least(F.col("a"), 0.0), numbers.divide(F.col("a"), F.col("b"))))
    assert got == [(None, None), (0.0, None), (3.0, 1.5)]


def test_direction(spark):
    df = spark.createDataFrame([(2.0, 1.0), (1.0, 1.0), (0.0, 1.0), (1.0, None)], "v double, b double")
    assert [r[0] for r in df.select(numbers.direction(F.col("v"), F.col("b"))).collect()] == [1, 0, -1, None]


VALUES = [-50.0, -3.5, -1.0, -0.25, 0.0, 0.25, 1.0, 7.5, 900.0]


@pytest.mark.parametrize("lam", [-0.5, 0.0, 0.5, 1.0, 2.0, 2.5])
def test_yeo_johnson_round_trip_and_array_twin(spark, lam):
    df = spark.createDataFrame([(v,) for v in VALUES], "y double")
    t = transforms.yeo_johnson(F.col("y"), lam)
    got = rows(df.select("y", t, transforms.yeo_johnson_inverse(t, lam), transforms.yeo_johnson_inverse_clipped(t, lam)))
    twin = power_transform(np.array(VALUES), "yeojohnson", lam)
    for (y, t_, back, clipped), want in zip(got, twin):
        assert t_ == pytest.approx(want, rel=1e-12)
        assert back == pytest.approx(y, rel=1e-6, abs=1e-9)
        assert clipped == pytest.approx(y, rel=1e-6, abs=1e-9)


@pytest.mark.parametrize("kind,lam,shift", [("none", 0, 0), ("log", 0, 0), ("boxcox", 0.0, 0.0), ("boxcox", 0.3, 5.0)])
def test_other_round_trips(spark, kind, lam, shift):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.0, 20.0)], "y double")
    t = transforms.forward(F.col("y"), kind, lam, shift)
    for y, back in rows(df.select("y", transforms.inverse(t, kind, lam, shift))):
        assert back == pytest.approx(y)


def test_clipped_inverse_stays_in_range(spark):
    df = spark.createDataFrame([(5.0,), (-9.0,)], "t double")
    got = [r[0] for r in df.select(transforms.yeo_johnson_inverse_clipped(F.col("t"), -1.0)).collect()]
    assert all(math.isfinite(v) for v in got) and got[0] > 1e8
    down = df.select(transforms.yeo_johnson_inverse_clipped(F.col("t"), 3.0)).collect()[1][0]
    assert math.isfinite(down) and down < -1e8


def test_unknown_transform():
    with pytest.raises(ValueError):
        transforms.forward(F, "sqrt")


def test_chi_square_tail(spark):
    # published critical values
    for k, q, p in [(10, 18.307, 0.05), (2, 5.991, 0.05), (1, 3.841, 0.05), (5, 11.070, 0.05), (7, 18.475, 0.01)]:
        got = spark.createDataFrame([(q,)], "q double").select(chi2_tail(F.col("q"), k)).first()[0]
        assert got == pytest.approx(p, abs=5e-5)


def test_local_folders_are_no_shared_ones():
    from pricepanel.session import shared_only

    assert shared_only("hdfs://n/warehouse", "hdfs") == "hdfs://n/warehouse" and shared_only("/warehouse", "s3a") == "/warehouse"
    for folder in ("/tmp/warehouse", "file:/x", "spark-warehouse"):
        with pytest.raises(ValueError):
            shared_only(folder, "file")
