import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricepanel.operators import scoring as M
from tests.conftest import day, rows

PRED = "run_date date, forecast_date date, model string, target string, predicted double"


def test_predictions_drop_unknown_null_and_repeated(spark):
    h = spark.createDataFrame(
        [(day(1), 1.0, None, "A", day(0)), (day(1), 1.0, None, "A", day(0)), (day(1), 2.0, 2.0, "Z", day(0))],
        "forecast_date date, a double, b double, model string, run_date date")
    assert rows(M.predictions(h, ["a", "b"], ["A"])) == [(day(0), day(1), "A", "a", 1.0)]


def test_previous_actual_skips_gaps(spark):
    p = spark.createDataFrame([("a", day(0), 1.0), ("a", day(1), None), ("a", day(2), 3.0), ("a", day(2), 3.0)],
                              "series string, date date, value double")
    assert rows(M.actuals_with_previous(p), "date") == [("a", day(0), 1.0, None), ("a", day(2), 3.0, 1.0)]


def test_score_edges(spark):
    act = spark.createDataFrame([("x", day(0), 0.0), ("x", day(1), 4.0)], "series string, date date, value double")
    pred = spark.createDataFrame([(day(0), day(0), "A", "x", 2.0), (day(0), day(1), "A", "x", -1.0)], PRED)
    got = rows(M.score(pred, M.actuals_with_previous(act)).select(
        "abs_error", "ape", "predicted_direction", "actual_direction", "direction_hit"), "abs_error")
    assert got == [(2.0, None, None, None, None), (5.0, 1.25, -1, 1, 0)]


def test_first_publication_matches_correlated_delete(spark):
    rng = random.Random(2)
    preds = {(day(rng.randint(0, 9)), day(rng.randint(0, 3)), "A", "x"): float(rng.randint(1, 3)) for _ in range(80)}
    act = spark.createDataFrame([("x", day(i), float(i)) for i in range(4)], "series string, date date, value double")
    df = spark.createDataFrame([(*k, v) for k, v in preds.items()], PRED)
    scored = M.score(df, M.actuals_with_previous(act))
    got = rows(M.first_publication(scored), "run_date", "forecast_date")
    t, x = scored.alias("t"), scored.alias("x")
    cond = [F.col(f"x.{c}") == F.col(f"t.{c}") for c in ("forecast_date", "model", "target", "predicted")]
    literal = t.join(x, [*cond, F.col("x.run_date") < F.col("t.run_date")], "left_anti")
    assert got == rows(literal, "run_date", "forecast_date")


def test_new_publications_looks_at_stored_rows(spark):
    cols = ["run_date", "forecast_date", "model", "target", "predicted"]
    new = spark.createDataFrame([(day(5), day(9), "A", "x", 1.0), (day(5), day(9), "A", "x", 2.0)], PRED)
    old = spark.createDataFrame([(day(4), day(9), "A", "x", 1.0), (day(6), day(9), "A", "x", 2.0)], PRED)
    assert rows(M.new_publications(new, old).select(*cols)) == [(day(5), day(9), "A", "x", 2.0)]


def records(spark, n=40, seed=4):
    rng = np.random.default_rng(seed)
    out = [("t", m, i // 8 + 1, day(i), float(a), float(b), 10.0)
           for m in "AB" for i, (a, b) in enumerate(rng.normal(10, 3, (n, 2)))]
    return spark.createDataFrame(
        out, "target string, model string, window_id long, date date, y_true double, y_pred double, y_base double")


def test_metrics_match_numpy(spark):
    r = records(spark)
    pdf = r.toPandas()
    for row in M.accuracy(r).collect():
        g = pdf[pdf.model == row.model]
        assert row.mape_pct == pytest.approx(np.mean(np.abs((g.y_true - g.y_pred) / g.y_true)) * 100)
        assert row.rmse == pytest.approx(np.sqrt(np.mean((g.y_true - g.y_pred) ** 2)))
        assert row.direction_pct == pytest.approx(
            np.mean(np.sign(g.y_true - g.y_base) == np.sign(g.y_pred - g.y_base)) * 100)
    for row in M.fold_summary(r).collect():
        g = pdf[pdf.model == row.model]
        per = [np.sqrt(np.mean((w.y_true - w.y_pred) ** 2)) for _, w in g.groupby("window_id")]
        assert row.rmse_mean == pytest.approx(np.mean(per)) and row.rmse_std == pytest.approx(np.std(per))


def test_ljung_box_matches_numpy(spark):
    rng = np.random.default_rng(8)
    e = rng.normal(size=35)
    df = spark.createDataFrame([("t", "m", day(i), float(v)) for i, v in enumerate(e)],
                               "target string, model string, date date, residual double")
    r = M.ljung_box(df).first()
    c = e - e.mean()
    acf = [np.sum(c[k:] * c[:-k]) / np.sum(c * c) for k in range(1, 11)]
    q = 35 * 37 * sum(a * a / (35 - k) for k, a in enumerate(acf, 1))
    assert r.lb_stat == pytest.approx(q) and r.lb_ok == (r.lb_pvalue > 0.05)
    assert M.ljung_box(df.limit(11)).first().lb_stat is None


def test_ranking_default_puts_the_larger_error_first(spark):
    df = spark.createDataFrame([("t", "a", 0.5, 1.0), ("t", "b", 0.5, 2.0), ("t", "c", 0.9, 9.0)],
                               "target string, model string, direction_mean double, mape_mean double")
    assert [r.model for r in M.rank_grid(df).orderBy("rank").collect()] == ["c", "b", "a"]
    assert [r.model for r in M.rank_grid(df, True).orderBy("rank").collect()] == ["c", "a", "b"]


def test_best_and_compare(spark):
    df = spark.createDataFrame([("t", "a", 2.0, 5.0), ("t", "b", 1.0, 6.0), ("u", "a", None, 1.0)],
                               "target string, model string, mape_pct double, rmse double")
    assert rows(M.best_by_mape(df)) == [("t", 1.0, "b", 6.0)]
    left = df.where("model = 'a'").select("target", "rmse")
    right = df.where("model = 'b'").select("target", "rmse")
    assert rows(M.compare({"a": left}, {"b": right}), "target") == [("t", 5.0, 6.0), ("u", 1.0, None)]
    assert M.compare({"a": left, "b": right}).count() == 1
