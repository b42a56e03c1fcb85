import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricepanel.operators import fill
from tests.conftest import day, rows

LONG = "series string, date date, value double"


def random_panel(spark, seed, n=400, gap=0.7, span=1500):
    rng = random.Random(seed)
    out = []
    for s in "abc":
        for d in sorted(rng.sample(range(span), n)):
            out.append((s, day(d), None if rng.random() < gap else float(rng.randint(1, 9))))
    out += [("void", day(d), None) for d in range(0, span, 50)]
    return spark.createDataFrame(out, LONG)


@pytest.mark.parametrize("width", [1, 7, 100, 5000])
def test_sliced_fill_equals_plain_fill(spark, width):
    p = random_panel(spark, width)
    part = F.floor(F.datediff("date", F.lit(dt.date(2020, 1, 1))) / width)
    key = ["series", "date"]
    assert rows(fill.forward_fill_sliced(p, part), *key) == rows(fill.forward_fill(p), *key)


def test_fills_match_pandas(spark):
    p = random_panel(spark, 3)
    pdf = p.toPandas().sort_values(["series", "date"]).reset_index(drop=True)
    g = pdf.groupby("series")["value"]
    filled, raw_mid = g.ffill(), g.transform("median")
    cases = {
        "both": (fill.fill_both_ways(p), filled.groupby(pdf["series"]).bfill()),
        "back": (fill.backward_fill(p), g.bfill()),
        "raw": (fill.median_fill(p), filled.fillna(raw_mid).fillna(0.0)),
        "no default": (fill.median_fill(p, default=None), filled.fillna(raw_mid)),
        "filled": (fill.median_fill(p, median_of="filled"),
                   filled.fillna(filled.groupby(pdf["series"]).transform("median")).fillna(0.0)),
    }
    for name, (got, want) in cases.items():
        have = got.orderBy("series", "date").toPandas()["value"].to_numpy(dtype=float)
        np.testing.assert_allclose(have, want.to_numpy(dtype=float), err_msg=name)


@pytest.mark.parametrize("method", ["last", "median", "mode"])
def test_future_values_match_pandas(spark, method):
    p = random_panel(spark, 11)
    pdf = p.toPandas().sort_values(["series", "date"])
    got = {r.series: r.value for r in fill.future_values(p, 3, method).where("step = 1").collect()}
    assert fill.future_values(p, 3, method).count() == 12
    for s, g in pdf.groupby("series"):
        med = g["value"].median()
        med = 0.0 if np.isnan(med) else med
        x = g["value"].ffill().fillna(med)
        want = {"last": x.iloc[-1], "median": med, "mode": x.mode().iloc[0]}[method]
        assert got[s] == pytest.approx(want)


def test_mode_takes_the_lowest_on_a_tie(spark):
    p = spark.createDataFrame([("a", day(i), v) for i, v in enumerate([5.0, 3.0, 5.0, 3.0, 9.0])], LONG)
    assert rows(fill.most_frequent(p)) == [("a", 3.0)]


def test_range(spark):
    raw = spark.createDataFrame([(day(0), None), (day(1), 1.0), (day(4), 2.0), (day(5), None)], "date date, a double")
    assert rows(fill.reload_range(raw, "a")) == [(day(1), day(4))]
    assert rows(fill.reload_range(raw.where("false"), "a")) == [(None, None)]


WIDE = "date date, a double, b double"


def test_seeded_fill_continues_and_hides_the_seed(spark):
    stored = spark.createDataFrame([(day(0), 1.0, 7.0), (day(1), 2.0, None)], WIDE)
    batch = spark.createDataFrame([(day(3), None, None), (day(4), 5.0, 6.0), (day(5), None, None)], WIDE)
    # only the newest stored row is the seed, so b stays empty until it gets a value
    assert rows(fill.seeded_fill(stored, batch, ["a", "b"]), "date") == [
        (day(3), 2.0, None), (day(4), 5.0, 6.0), (day(5), 5.0, 6.0)]
    none = stored.where("false")
    assert rows(fill.seeded_fill(none, batch, ["a", "b"]), "date")[0] == (day(3), None, None)
    assert fill.seeded_fill(stored, batch.where("false"), ["a", "b"]).count() == 0


def test_seeded_fill_keeps_repeated_dates(spark):
    stored = spark.createDataFrame([(day(0), 1.0, 1.0)], WIDE)
    batch = spark.createDataFrame([(day(1), None, 4.0)] * 3 + [(day(1), 2.0, None), (day(2), None, None)], WIDE)
    got = rows(fill.seeded_fill(stored, batch, ["a", "b"]), "date", "a")
    assert got == [(day(1), 1.0, 4.0)] * 3 + [(day(1), 2.0, 4.0), (day(2), 2.0, 4.0)]


def test_seeded_fill_long(spark):
    stored = spark.createDataFrame([("a", day(0), 1.0), ("a", day(1), 2.0), ("b", day(1), None), ("gone", day(1), 9.0)], LONG)
    batch = spark.createDataFrame([("a", day(2), None), ("b", day(2), None), ("b", day(3), 4.0), ("new", day(2), None)], LONG)
    got = rows(fill.seeded_fill_long(stored, batch), "series", "date")
    assert got == [("a", day(2), 2.0), ("b", day(2), None), ("b", day(3), 4.0), ("new", day(2), None)]
    assert fill.seeded_fill_long(stored, batch.where("false")).count() == 0
