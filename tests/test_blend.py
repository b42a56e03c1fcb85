import datetime as dt
import random

import pytest

from pricepanel.operators import blend
from tests.conftest import day, rows

PAIRS = "forecast_date date, target string, a double, b double, last_actual double"


def brute_path(points):
    """points: (a, b, anchor) in date order -> path."""
    out, m, pa, pb = [], None, None, None
    for i, (a, b, anchor) in enumerate(points):
        if i == 0:
            m, pa, pb = anchor, anchor, anchor
        size = 0.0 if None in (b, pb) or pb == 0 else abs((b - pb) / pb)
        if a is not None and pa is not None and a > pa:
            m = None if m is None else m * (1 + size)
        elif a is not None and pa is not None and a < pa:
            m = None if m is None else max(m * (1 - size), 0.0)
        out.append(m)
        pa, pb = a, b
    return out


def test_mixed_path_matches_brute_force(spark):
    rng = random.Random(5)
    pairs, want = [], {}
    for t in range(60):
        anchor = rng.choice([None, -3.0, 0.0, 2.0, 50.0])
        pts = [(rng.choice([None, 1.0, 2.0, 5.0, -4.0]), rng.choice([None, 0.0, 1.0, 3.0, 40.0, -2.0]), anchor)
               for _ in range(rng.randint(1, 10))]
        name = f"t{t:02}"
        pairs += [(day(i), name, *p) for i, p in enumerate(pts)]
        want[name] = brute_path(pts)
    got = rows(blend.mixed_path(spark.createDataFrame(pairs, PAIRS)), "target", "forecast_date")
    for name, path in want.items():
        assert [r[2] for r in got if r[0] == name] == path, name


def test_clamped_path_differs_from_a_product(spark):
    pts = [(1.0, 1.0, -2.0), (0.5, 4.0, -2.0), (0.9, 8.0, -2.0)]
    df = spark.createDataFrame([(day(i), "t", *p) for i, p in enumerate(pts)], PAIRS)
    assert [r[2] for r in rows(blend.mixed_path(df), "forecast_date")] == brute_path(pts)


FORECASTS = "forecast_date date, model string, target string, predicted double"


def test_pairs_need_rows_not_values(spark):
    preds = spark.createDataFrame(
        [(day(0), "A", "x", 1.0), (day(0), "B", "x", None), (day(1), "A", "x", 2.0), (day(2), "C", "x", 1.0)], FORECASTS)
    anchors = spark.createDataFrame([("y", 1.0)], "target string, last_actual double")
    assert rows(blend.pair_models(preds, anchors, "A", "B")) == [(day(0), "x", 1.0, None, None)]


def test_last_actual_is_the_newest_row_even_if_null(spark):
    wide = spark.createDataFrame([(day(0), 1.0, 5.0), (day(1), None, 6.0)], "date date, a double, b double")
    assert rows(blend.last_actual(wide, ["a", "b"]), "target") == [("a", None), ("b", 6.0)]


def test_derived_forecasts_and_snapshot(spark):
    actual = spark.createDataFrame([(day(0), 10.0, None)], "date date, a double, b double")
    cur = spark.createDataFrame(
        [(day(1), 11.0, 1.0, "A"), (day(1), 12.0, 3.0, "B"), (day(1), 0.0, 0.0, "mix"), (day(2), 1.0, 1.0, "A")],
        "forecast_date date, a double, b double, model string")
    new = blend.derived_forecasts(cur, actual, ["a", "b"], "A", "B", "mix", "mean")
    assert rows(new, "model") == [(day(1), "mean", 11.5, 2.0), (day(1), "mix", 12.0, None)]
    out = blend.with_derived(cur, new, ["mix", "mean"])
    assert out.where("model = 'mix'").count() == 1 and out.count() == 5
    assert blend.snapshot(out, dt.date(2024, 1, 9)).where("run_date = '2024-01-09'").count() == 5
