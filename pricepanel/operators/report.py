"""Reporting views: actuals and the newest forecasts in one long table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from pricepanel.functions.dates import years_before
from pricepanel.operators.panel import replicate, to_long


def newest_run(history: DataFrame, models: Sequence[str]) -> DataFrame:
    """Rows of each model's newest run."""
    known = history.where(F.col("model").isin(list(models)))
    newest = known.groupBy("model").agg(F.max("run_date").alias("run_date"))
    # one row per listed model, so the broadcast is as long as the list
    return known.join(F.broadcast(newest), ["model", "run_date"])


def _actuals(panel: DataFrame, targets: Sequence[str], since) -> DataFrame:
    newest = panel.agg(F.max("date").alias("d")).select(since(F.col("d"))).scalar()
    recent = panel.where(F.col("date") >= newest)
    if "month" in panel.columns:  # partition column of the stored panel
        recent = recent.where(F.col("month") >= F.trunc(newest, "MM"))
    recent = recent.select("date", *targets)
    return to_long(recent, targets, keep_nulls=False, series="target")


def actuals_and_forecasts(
    panel: DataFrame, history: DataFrame, targets: Sequence[str], order: Mapping[str, int],
    unknown_order: int = 99, years: int = 10,
) -> DataFrame:
    """Ten years of actuals plus the newest forecast of every model."""
    real = _actuals(panel, targets, lambda d: years_before(d, years)).select(
        "date", "target", "value", F.lit("real").alias("source"), F.lit(1).cast("long").alias("source_order")
    )
    rank = F.lit(unknown_order)
    for model, n in order.items():
        rank = F.when(F.col("model") == model, n).otherwise(rank)
    runs = newest_run(history, list(order)).withColumnRenamed("forecast_date", "date")
    preds = to_long(runs, targets, keep_nulls=False, ids=["date", "model"], series="target").select(
        "date", "target", "value", F.col("model").alias("source"), rank.cast("long").alias("source_order")
    )
    return real.unionByName(preds)


def summary(
    panel: DataFrame, history: DataFrame, targets: Sequence[str], models: Sequence[str], days: int = 30
) -> DataFrame:
    """The last thirty days of actuals once per model, plus each model's newest forecast."""
    real = _actuals(panel, targets, lambda d: F.date_sub(d, days))
    real = replicate(real, models, "source").select(
        "date", "target", "value", "source", F.lit(1).cast("long").alias("source_order"),
        F.lit("real").alias("kind"),
    )
    runs = newest_run(history, models).withColumnRenamed("forecast_date", "date")
    preds = to_long(runs, targets, keep_nulls=False, ids=["date", "model"], series="target").select(
        "date", "target", "value", F.col("model").alias("source"),
        F.lit(2).cast("long").alias("source_order"), F.lit("prediccion").alias("kind"),
    )
    return real.unionByName(preds)
