"""Forecast errors against actuals, and accuracy metrics of backtest records.

Errors: one row per (run_date, forecast_date, model, target).  Backtest records:
``target, model, window_id, date, y_true, y_pred, y_base``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from pricepanel.functions.numbers import direction, divide
from pricepanel.operators.blend import forecasts_long

# ---------------------------------------------------------------- errors by run


def predictions(history: DataFrame, targets: Sequence[str], models: Sequence[str]) -> DataFrame:
    """Non-null forecasts of the known models, one per (run, date, model, target).

    Of repeated rows the highest value is kept (any one would do; this one is the same on
    every run).  A plain max combines copies before the shuffle.
    """
    long = forecasts_long(history, targets, models, keep_nulls=False)
    return one_prediction(long)


def one_prediction(long: DataFrame) -> DataFrame:
    return (
        long.where(F.col("predicted").isNotNull())
        .groupBy("run_date", "forecast_date", "model", "target")
        .agg(F.max("predicted").alias("predicted"))
    )


def actuals_with_previous(long: DataFrame) -> DataFrame:
    """``target, date, actual, previous_actual``: each non-null actual and the one before."""
    one = (
        long.where(F.col("value").isNotNull())
        .groupBy(F.col("series").alias("target"), "date")
        .agg(F.max("value").alias("actual"))
    )
    w = W.partitionBy("target").orderBy("date")  # at most one row per day
    return one.withColumn("previous_actual", F.lag("actual").over(w))


def score(preds: DataFrame, actuals: DataFrame) -> DataFrame:
    """Absolute error, error as a fraction of the actual, and direction hits."""
    p, a, before = F.col("predicted"), F.col("actual"), F.col("previous_actual")
    abs_error = F.abs(a - p)
    said, was = direction(p, before), direction(a, before)
    joined = preds.withColumnRenamed("forecast_date", "date").join(actuals, ["target", "date"])
    return joined.select(
        "run_date",
        F.col("date").alias("forecast_date"),
        "model",
        "target",
        "previous_actual",
        "actual",
        "predicted",
        abs_error.alias("abs_error"),
        divide(abs_error, F.abs(a)).alias("ape"),
        said.alias("predicted_direction"),
        was.alias("actual_direction"),
        F.when(before.isNotNull(), (said == was).cast("long")).alias("direction_hit"),
    )


def first_publication(errors: DataFrame) -> DataFrame:
    """Drop a forecast that an earlier run already made with the same value.

    Rows, scored or not, are unique per (run, date, model, target), and all columns but the run
    follow from (date, model, target, value); so "no earlier equal row" is a minimum over the run date.
    The minimum is combined before the shuffle, so a value repeated by every run costs one
    row per map task.  Rows without a forecast are kept.
    """
    rest = [c for c in errors.columns if c != "run_date"]
    own_run = F.when(F.col("predicted").isNull(), F.col("run_date")).alias("own_run")
    return errors.groupBy(*rest, own_run).agg(F.min("run_date").alias("run_date")).select(*errors.columns)


def forecast_errors(preds: DataFrame, actuals: DataFrame) -> DataFrame:
    """The error fact: a pure function of forecast history and actuals.

    Repeated forecasts are dropped before they are scored, by the few columns a forecast has.
    """
    return score(first_publication(preds), actuals_with_previous(actuals))


def new_publications(errors: DataFrame, stored: DataFrame) -> DataFrame:
    """Errors whose forecast no stored row of an earlier run already made with that value.

    The stored side is reduced to its first run per forecast before the join.
    """
    key = ["forecast_date", "model", "target", "predicted"]
    first = stored.where(F.col("predicted").isNotNull()).groupBy(*key).agg(F.min("run_date").alias("first_run"))
    known = errors.join(first, key, "left")
    keep = F.col("first_run").isNull() | (F.col("first_run") >= F.col("run_date"))
    return known.where(keep).select(*errors.columns)


# ---------------------------------------------------------------- metrics of backtests


def mape(y_true: Column, y_pred: Column, eps: float = 1e-9) -> Column:
    """Mean absolute percentage error, in percent."""
    return F.avg(F.abs(y_true - y_pred) / F.greatest(F.abs(y_true), F.lit(eps))) * 100


def rmse(y_true: Column, y_pred: Column) -> Column:
    return F.sqrt(F.avg((y_true - y_pred) * (y_true - y_pred)))


def direction_ratio(y_true: Column, y_pred: Column, base: Column) -> Column:
    """Share of rows whose forecast is on the same side of ``base`` as the actual; rows with
    a NULL do not count."""
    hit = F.signum(y_true - base) == F.signum(y_pred - base)
    return F.avg(hit.cast("double"))


def accuracy(records: DataFrame, by: Sequence[str] = ("target", "model")) -> DataFrame:
    """Direction (percent), MAPE (percent) and RMSE per group."""
    t, p, b = F.col("y_true"), F.col("y_pred"), F.col("y_base")
    return records.groupBy(*by).agg(
        (direction_ratio(t, p, b) * 100).alias("direction_pct"),
        mape(t, p).alias("mape_pct"),
        rmse(t, p).alias("rmse"),
    )


def direction_vs_previous(records: DataFrame, by: Sequence[str] = ("target", "model")) -> DataFrame:
    """Direction ratio (percent) against the previous actual instead of a fixed base."""
    w = W.partitionBy(*by).orderBy("date")
    prev = records.withColumn("y_prev", F.lag("y_true").over(w))
    ratio = direction_ratio(F.col("y_true"), F.col("y_pred"), F.col("y_prev")) * 100
    return prev.groupBy(*by).agg(ratio.alias("direction_pct"))


def fold_summary(records: DataFrame, by: Sequence[str] = ("target", "model")) -> DataFrame:
    """Mean and population deviation over folds of RMSE, MAPE (percent) and direction (fraction)."""
    t, p, b = F.col("y_true"), F.col("y_pred"), F.col("y_base")
    folds = records.groupBy(*by, "window_id").agg(
        rmse(t, p).alias("rmse"), mape(t, p).alias("mape"), direction_ratio(t, p, b).alias("direction")
    )
    aggs = [f(c).alias(f"{c}_{n}") for c in ("rmse", "mape", "direction")
            for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    return folds.groupBy(*by).agg(*aggs)


def chi2_tail(q: Column, df: int) -> Column:
    """P(X > q) for a chi-square with ``df`` degrees: a finite sum of powers of q / 2.

    For odd ``df`` the sum starts from the normal tail, the one term Spark has no function for.
    """
    h = q / 2
    if df % 2 == 0:
        terms, k = F.lit(1.0), 1.0
        for i in range(1, df // 2):
            k *= i
            terms = terms + F.pow(h, F.lit(float(i))) / k
        return F.exp(-h) * terms
    tail = normal_tail(F.sqrt(h))
    for i in range((df - 1) // 2):
        tail = tail + F.exp(-h) * F.pow(h, F.lit(i + 0.5)) / math.gamma(i + 1.5)
    return tail


@F.pandas_udf(T.DoubleType())
def normal_tail(x: pd.Series) -> pd.Series:
    """Complementary error function."""
    return x.map(math.erfc, na_action="ignore").astype("float64")


def ljung_box_statistic(residuals: DataFrame, lags: int = 10, by: Sequence[str] = ("target", "model"),
                        order: str = "date") -> DataFrame:
    """``n, lb_stat`` of the residuals in date order; NULL unless n > lags + 1.

    Each lagged product is a window column, so all lags come from one sort.
    """
    part = W.partitionBy(*by)
    w = part.orderBy(order)
    clean = residuals.where(F.col("residual").isNotNull())
    e = clean.withColumn("e", F.col("residual") - F.avg("residual").over(part))
    prods = e.withColumns({f"p{k}": F.col("e") * F.lag("e", k).over(w) for k in range(1, lags + 1)})
    sums = prods.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sum(F.col("e") * F.col("e")).alias("s0"),
        *[F.sum(f"p{k}").alias(f"s{k}") for k in range(1, lags + 1)],
    )
    terms = [
        divide(F.pow(divide(F.col(f"s{k}"), F.col("s0")), F.lit(2.0)), F.col("n") - k)
        for k in range(1, lags + 1)
    ]
    stat = F.col("n") * (F.col("n") + 2) * sum(terms[1:], terms[0])
    return sums.select(*by, "n", F.when(F.col("n") > lags + 1, stat).alias("lb_stat"))


def ljung_box(residuals: DataFrame, lags: int = 10, alpha: float = 0.05,
              by: Sequence[str] = ("target", "model"), order: str = "date") -> DataFrame:
    """Whiteness test: statistic, p-value and whether it passes."""
    stat = ljung_box_statistic(residuals, lags, by, order)
    tested = stat.withColumn("lb_pvalue", chi2_tail(F.col("lb_stat"), lags))
    return tested.withColumn("lb_ok", F.col("lb_pvalue") > alpha)


def rank_grid(results: DataFrame, mape_ascending: bool = False) -> DataFrame:
    """Grid points per target by direction, then MAPE, both descending.

    ``mape_ascending=True`` puts the smaller error first among equal directions.
    """
    m = F.asc("mape_mean") if mape_ascending else F.desc("mape_mean")
    tie = [F.asc(c) for c in results.columns if c not in ("target", "mape_mean", "direction_mean")]
    w = W.partitionBy("target").orderBy(F.desc("direction_mean"), m, *tie)
    return results.withColumn("rank", F.row_number().over(w).cast("long"))


def best_by_mape(metrics: DataFrame) -> DataFrame:
    """Per target the row with the smallest MAPE (ties: by the other columns)."""
    rest = [c for c in metrics.columns if c not in ("target", "mape_pct")]
    best = F.min(F.struct("mape_pct", *rest)).alias("best")
    return metrics.where(F.col("mape_pct").isNotNull()).groupBy("target").agg(best).select("target", "best.*")


def compare(required: dict[str, DataFrame], optional: dict[str, DataFrame] | None = None) -> DataFrame:
    """Metric tables side by side per target: inner with the required, left with the optional."""
    out = None
    for how, group in (("inner", required), ("left", optional or {})):
        for name, df in group.items():
            named = df.select("target", *[F.col(c).alias(f"{name}_{c}") for c in df.columns if c != "target"])
            out = named if out is None else out.join(named, "target", how)
    return out
