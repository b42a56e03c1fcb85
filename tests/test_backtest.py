import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricepanel import fixed_values as fv
from pricepanel.operators import backtest as bt, forecast as fc, scoring as M
from pricepanel.operators.features import power_transform
from pricepanel.operators.running_fit import Covariates, RunningFit
from tests import plain_regression as plain
from tests.conftest import day, rows

LONG = "series string, date date, value double"


def panel(spark, sizes, seed=0, gap=0.0):
    rng = np.random.default_rng(seed)
    pts = []
    for s, n in sizes.items():
        for i in range(n):
            pts.append((s, day(2 * i), None if rng.random() < gap else float(rng.integers(1, 100))))
    return spark.createDataFrame(pts, LONG).repartition(5)


def test_folds_match_index_splits(spark):
    p = panel(spark, {"a": 60, "short": 40, "just": 41})
    got = rows(bt.rolling_folds(p), "series", "date")
    want = []
    for s, n in (("a", 60), ("just", 41)):
        for k in range(5):
            end = n - (5 - k) * 7
            want += [(s, day(2 * i), k + 1, end) for i in range(end, end + 7)]
    assert [(r[0], r[1], r[3], r[4]) for r in got] == sorted(want)
    assert rows(bt.too_short(p, 41)) == [("short", 40)]


@pytest.mark.parametrize("test_rows", [63, 66])
def test_holdout_windows(spark, test_rows):
    p = panel(spark, {"a": 100, "short": 50})
    got = rows(bt.holdout_windows(p, test_rows).drop("value"), "date")
    n_windows, want = test_rows // 7, []
    for w in range(n_windows):
        idx = range(100 - test_rows + 7 * w, 100 - test_rows + 7 * w + 7)
        want += [("a", day(2 * i), w + 1, day(2 * idx[0]), day(2 * idx[-1])) for i in idx]
    assert got == want
    ranges = rows(bt.window_ranges(bt.holdout_windows(p, test_rows)), "window_id")
    assert len(ranges) == n_windows and all(r[4] == 7 for r in ranges)


def test_naive_matches_pandas_with_gaps(spark):
    p = panel(spark, {"a": 100, "b": 70, "c": 63, "short": 62}, 3, gap=0.5)
    p = p.unionByName(spark.createDataFrame([("void", day(i), None) for i in range(90)], LONG))
    got = rows(bt.naive_last(p).select("series", "window_id", "date", "y_base", "y_true"), "series", "date")
    want = []
    for s, g in p.toPandas().sort_values("date").groupby("series"):
        if len(g) < 63:
            continue
        for w in range(9):
            lo = len(g) - 63 + 7 * w
            train = g.iloc[:lo]
            if lo < 21 or train["value"].dropna().empty:
                continue
            base = float(train["value"].dropna().iloc[-1])
            for _, r in g.iloc[lo: lo + 7].iterrows():
                want.append((s, w + 1, r["date"], base, None if np.isnan(r["value"]) else r["value"]))
    assert got == want and len(want) > 100


def test_training_rows_end_before_the_window(spark):
    p = panel(spark, {"a": 80})
    t = bt.training_rows(p, bt.holdout_windows(p))
    n = {r.window_id: r["count"] for r in t.groupBy("window_id").count().collect()}
    assert n == {w + 1: 17 + 7 * w for w in range(9)}


def test_grid_sizes_and_points(spark):
    assert [len(bt.grid(fv.GRID[t])) for t in ("oro", "plata", "cobre", "gas_natural", "petroleo_brent")] == [4, 8, 4, 2, 6]
    targets = spark.createDataFrame([("a",), ("b",)], "target string")
    assert bt.grid_points(targets, {"p": [1, 2, 2], "q": [0, 1]}).count() == 8


# ---------------------------------------------------------------- regression

NONE = np.zeros((0, 0))


def running(y, x, ahead, order, cuts=(), gap=None):
    """The running fit, fed in pieces."""
    f = RunningFit(order, x.shape[1])
    columns = np.hstack([np.nan_to_num(x), np.isnan(x).astype(float)])
    edges = [0, *cuts, len(y)]
    for a, b in zip(edges, edges[1:]):
        old = min(a, f.terms.context)
        f.add(y[a - old:b], columns[a - old:b], old)
    tail = min(len(y), f.terms.context + 1)
    return f.forecast(y[-tail:], columns[-tail:], np.zeros(x.shape[1]) if gap is None else gap, ahead)


ORDERS = [((0, 0, 0), (0, 0, 0, 0)), ((1, 1, 0), (0, 0, 0, 0)), ((2, 0, 0), (1, 0, 0, 5)), ((0, 1, 1), (0, 0, 0, 0)), ((2, 1, 1), (1, 0, 0, 5)),
          ((1, 1, 1), (1, 1, 1, 5)), ((0, 2, 0), (0, 0, 1, 7)), ((1, 0, 2), (0, 1, 0, 6))]


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("cuts", [(), (1, 2, 3, 40, 41, 100), (90, 180)])
def test_running_fit_equals_the_plain_one(order, cuts):
    rng = np.random.default_rng(5)
    n = 200
    x = np.column_stack([rng.normal(size=n).cumsum() * 1000, rng.normal(size=n), np.full(n, 3.0), rng.normal(size=n).cumsum()])
    y = 0.002 * x[:, 0] + x[:, 1] + rng.normal(size=n).cumsum() + np.sin(np.arange(n))
    x[:17, 3] = np.nan  # a gap at the start, filled with a value known later
    gap = np.array([0.0, 0.0, 0.0, 2.5])
    ahead = np.tile([x[-1, 0], 0.3, 3.0, 1.0], (6, 1))
    for width in (0, 2, 4):
        got = running(y, x[:, :width], ahead[:, :width], order, cuts, gap[:width])
        want = plain.fit_and_forecast(y, np.where(np.isnan(x), gap, x)[:, :width], ahead[:, :width], order)
        np.testing.assert_allclose(got["path"], want["path"], rtol=1e-8)
        assert got["aic"] == pytest.approx(want["aic"], rel=1e-8) and got["bic"] == pytest.approx(want["bic"], rel=1e-8)


@pytest.mark.parametrize("order", [((9, 1, 9), (0, 0, 0, 0)), ((1, 1, 0), (0, 0, 0, 0)), ((3, 0, 0), (0, 1, 0, 7))])
def test_running_fit_of_few_rows(order):
    for n in range(1, 16):
        y, x, ahead = np.arange(n) ** 1.5, np.cos(np.arange(n))[:, None], np.zeros((3, 1))
        try:
            want = plain.fit_and_forecast(y, x, ahead, order)["path"]
        except (ValueError, IndexError):
            want = None
        try:
            got = running(y, x, ahead, order, range(1, n))["path"]
        except ValueError:
            got = None
        assert (got is None) == (want is None), n
        if want is not None:
            np.testing.assert_allclose(got, want, rtol=1e-6)


@pytest.mark.parametrize("method", ["last", "median", "mode"])
@pytest.mark.parametrize("median_of", ["raw", "filled"])
def test_running_covariates_equal_the_plain_ones(method, median_of):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 5, (60, 4)).astype(float)
    x[rng.random((60, 4)) < 0.3] = np.nan
    x[:9, 0], x[:, 3] = np.nan, np.inf
    for n in (1, 8, 10, 60):
        past, ahead = plain.covariates(np.where(np.isinf(x), np.nan, x)[:n], 3, method, median_of)
        c = Covariates(4, method, median_of)
        columns = np.vstack([c.columns(x[a:min(a + 7, n)]) for a in range(0, n, 7)])
        centre = c.centre()
        np.testing.assert_allclose(columns[:, :4] + columns[:, 4:] * centre, past)
        np.testing.assert_allclose(c.next(centre, 3), ahead)


def test_backtest_equals_plain_fits_whatever_the_batches(spark):
    rng = np.random.default_rng(7)
    pts, n = [], 130
    for t in ("a", "b", "c"):
        x = rng.normal(size=(n, 2)).cumsum(0)
        x[:11, 1] = np.nan
        y = np.exp(0.1 * x[:, 0] + rng.normal(size=n).cumsum() * 0.1) + (-2 if t == "c" else 0)
        pts += [(t, day(i), float(y[i]), [float(x[i, 0]), None if i < 11 else float(x[i, 1])] if t != "b" else []) for i in range(n)]
    df = spark.createDataFrame(pts, "target string, date date, y double, x array<double>").repartition(5)
    held = bt.holdout_windows(df.drop("x"), 28, 7, ["target"]).withColumnRenamed("y", "y_true")
    orders = {"a": ORDERS[:6], "c": [ORDERS[4]]}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = fc.backtest(df, held, 7, orders, "m", transform="yeojohnson").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 28 * (6 + 1 + 1)
    found = {(r.target, r.window_id, r.grid_point, (r.date - day(0)).days): r for r in got}
    for t in "abc":
        y = np.array([p[2] for p in pts if p[0] == t])
        x = np.array([p[3] for p in pts if p[0] == t], float).reshape(n, -1)
        for w in range(1, 5):
            m = n - 28 + 7 * (w - 1)
            lam, shift = plain.best_lambda(y[:m], "yeojohnson")
            past, ahead = plain.covariates(x[:m], 7, "last", "raw") if x.shape[1] else (x[:m], np.zeros((7, 0)))
            for g, order in enumerate(orders.get(t, [ORDERS[1]])):
                want = plain.fit_and_forecast(power_transform(y[:m], "yeojohnson", lam, shift), past, ahead, order)
                r = found[t, w, g + 1, m]
                assert r.aic == pytest.approx(want["aic"], rel=1e-4) and r.status == ("covariates" if x.shape[1] else "no_covariates")
                assert r.y_base == y[m - 1]
                if lam * want["path"][0] + 1 > 1e-3:  # the inverse of others is clipped
                    assert r.y_pred == pytest.approx(float(inverse_yj(want["path"][0], lam)), rel=1e-3)


def inverse_yj(t, lam):
    if t >= 0:
        return np.expm1(t) if abs(lam) < 1e-12 else (lam * t + 1) ** (1 / lam) - 1
    k = 2 - lam
    return 1 - np.exp(-t) if abs(k) < 1e-12 else 1 - (1 - k * t) ** (1 / k)


def test_ar_process_is_recovered():
    rng = np.random.default_rng(1)
    y = np.zeros(3000)
    for i in range(2, 3000):
        y[i] = 0.6 * y[i - 1] + 0.2 * y[i - 2] + rng.normal()
    fit = running(y, np.zeros((3000, 0)), np.zeros((3, 0)), ((2, 0, 0), (0, 0, 0, 0)))
    one = 0.6 * y[-1] + 0.2 * y[-2]
    assert fit["path"][0] == pytest.approx(one, abs=0.15)
    assert fit["bic"] > fit["aic"]


def test_differencing_is_undone():
    t = np.arange(200.0)
    season = np.tile([1.0, 5.0, 2.0, 0.0, -3.0], 40)
    y = 3 * t + season
    fit = running(y, np.zeros((200, 0)), np.zeros((5, 0)), ((0, 1, 0), (0, 1, 0, 5)))
    np.testing.assert_allclose(fit["path"], 3 * np.arange(200, 205) + season[:5])


def test_covariate_effect_and_constant_covariates():
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.normal(size=400).cumsum(), np.ones(400)])
    y = 4 * x[:, 0] + rng.normal(scale=0.01, size=400)
    ahead = np.column_stack([np.repeat(x[-1, 0] + 2, 3), np.ones(3)])
    fit = running(y, x, ahead, ((0, 1, 0), (0, 0, 0, 0)))
    np.testing.assert_allclose(fit["path"], 4 * ahead[:, 0], atol=0.2)


def test_moving_average_terms_beat_none():
    rng = np.random.default_rng(3)
    e = rng.normal(size=3001)
    y = e[1:] + 0.7 * e[:-1]
    empty = np.zeros((3000, 0)), np.zeros((2, 0))
    with_ma = running(y, *empty, ((0, 0, 1), (0, 0, 0, 0)))
    without = running(y, *empty, ((1, 0, 0), (0, 0, 0, 0)))
    assert with_ma["aic"] < without["aic"]
    assert with_ma["path"][0] == pytest.approx(0.7 * e[-1], abs=0.15) and abs(with_ma["path"][1]) < 1e-9


def rows_frame(spark, sizes, k=0, seed=0):
    rng = np.random.default_rng(seed)
    pts = [(s, day(i), float(v), [float(v) * 2] * k) for s, n in sizes.items()
           for i, v in enumerate(rng.normal(size=n).cumsum() + 50)]
    return spark.createDataFrame(pts, "target string, date date, y double, x array<double>").repartition(6)


def test_forecast_job_falls_back_and_dates_are_business_days(spark):
    df = rows_frame(spark, {"long": 200, "tiny": 5, "mid": 40}, k=2)
    def run(rows, **more):
        return fc.forecast(rows, 5, {"long": ((2, 1, 1), (1, 0, 0, 5))}, "m", **more).orderBy("target", "forecast_date").collect()

    out = run(df, fallback=True)
    status = {r.target: r.status for r in out}
    assert status == {"long": "covariates", "tiny": "naive", "mid": "covariates"}
    assert len(out) == 15 and all(r.forecast_date.weekday() < 5 for r in out)
    last = df.where("target = 'tiny'").orderBy(F.desc("date")).first().y
    assert all(r.predicted == pytest.approx(last) for r in out if r.target == "tiny")
    again = run(df.repartition(2), fallback=True)
    assert [r.predicted for r in again] == pytest.approx([r.predicted for r in out], rel=1e-9)
    # without a fallback nothing is made up, and no asked target is left out
    strict = run(df, targets=["long", "tiny", "mid", "none"])
    assert {(r.target, r.status, r.predicted is None) for r in strict} == {
        ("long", "covariates", False), ("mid", "covariates", False), ("tiny", "failed", True), ("none", "no_rows", True)}
    assert len(strict) == 20
    assert {r.status for r in run(df, fallback=True, min_rows=41) if r.target == "mid"} == {"naive"}


def test_target_rows_skip_missing_features(spark):
    wide = spark.createDataFrame([(day(0), 1.0, 2.0), (day(1), None, 3.0)], "date date, a double, b double")
    out = rows(fc.target_rows(wide, {"a": ["b", "nope"], "b": []}), "target", "date")
    assert out == [("a", day(0), 1.0, [2.0]), ("b", day(0), 2.0, []), ("b", day(1), 3.0, [])]


@pytest.mark.parametrize("lambda_from", ["window", "global"])
def test_backtest_uses_only_earlier_rows(spark, lambda_from):
    df = rows_frame(spark, {"a": 150, "b": 150})
    held = bt.holdout_windows(df.drop("x"), 21, 7, ["target"]).withColumnRenamed("y", "y_true")
    orders = {"a": [((1, 1, 0), (0, 0, 0, 0)), ((2, 1, 1), (0, 0, 0, 0))]}
    rec = fc.backtest(df, held, 7, orders, "m", transform="none", lambda_from=lambda_from)
    got = rec.collect()
    assert len(got) == 2 * 21 + 21
    pdf = df.toPandas().sort_values("date")
    for r in got:
        train = pdf[(pdf.target == r.target)].iloc[: 150 - 21 + 7 * (r.window_id - 1)]
        assert r.y_base == train["y"].iloc[-1]
    # the same forecast from the training rows alone
    y = pdf[pdf.target == "b"]["y"].to_numpy()[:129]
    path = plain.fit_and_forecast(y, np.zeros((129, 0)), np.zeros((7, 0)), ((1, 1, 0), (0, 0, 0, 0)))["path"]
    mine = sorted((r.date, r.y_pred) for r in got if r.target == "b" and r.window_id == 1)
    np.testing.assert_allclose([v for _, v in mine], path, rtol=1e-9)
    ranked = M.rank_grid(fc.grid_results(rec))
    assert ranked.count() == 3 and ranked.where("lb_pvalue IS NULL").count() == 0


def test_skipped_windows_and_failed_fits_keep_their_records(spark):
    df = rows_frame(spark, {"a": 40, "b": 90})
    held = bt.holdout_windows(df.drop("x"), 28, 7, ["target"]).withColumnRenamed("y", "y_true")
    orders = {"a": [((1, 1, 0), (0, 0, 0, 0)), ((9, 1, 9), (0, 0, 0, 0))]}
    rec = fc.backtest(df, held, 7, orders, "m", transform="none").cache()
    a = {(r.window_id, r.grid_point): r for r in rec.where("target = 'a'").collect()}
    assert {k: r.status for k, r in a.items()} == {
        (w, g): "few_rows" if w < 3 else "no_covariates" if g == 1 else "failed" for w in (1, 2, 3, 4) for g in (1, 2)}
    assert all((r.y_pred is None) == (r.status != "no_covariates") for r in a.values())
    ranked = {(r.target, r.grid_point): r for r in fc.rank_fitted(fc.grid_results(rec, 3)).collect()}
    assert {k: (r.windows, r.fitted, r.rank) for k, r in ranked.items()} == {
        ("a", 1): (4, 2, None), ("a", 2): (4, 0, None), ("b", 1): (4, 4, 1)}
    assert [tuple(r) for r in bt.skipped_windows(df, 28, 7, 21, ["target"]).orderBy("window_id").collect()] == [("a", 1, 12), ("a", 2, 19)]


def test_windows_of_one_calendar(spark):
    df = spark.createDataFrame([(day(i), float(i)) for i in range(30) for _ in range(2)], "date date, a double")
    got = bt.calendar_windows(df, 14, 7).orderBy("date").collect()
    assert [(r.date, r.window_id, r.window_start, r.window_end) for r in got] == [
        (day(i), 1 if i < 23 else 2, day(16 if i < 23 else 23), day(22 if i < 23 else 29)) for i in range(16, 30)]
