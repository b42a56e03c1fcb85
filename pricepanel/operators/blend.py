"""Blending the forecasts of two models and archiving a run.

Long forecasts have columns ``forecast_date, model, target, predicted``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from pricepanel.functions.numbers import at_least, divide
from pricepanel.operators.panel import to_long, to_wide


def forecasts_long(wide: DataFrame, targets: Sequence[str], models: Sequence[str] | None = None,
                   keep_nulls: bool = True) -> DataFrame:
    """Wide forecast table to long, one scan, optionally only some models."""
    rows = wide if models is None else wide.where(F.col("model").isin(list(models)))
    return to_long(rows, targets, keep_nulls, series="target", value="predicted")


def last_actual(wide: DataFrame, targets: Sequence[str]) -> DataFrame:
    """``target, last_actual`` of the single newest row; a NULL there stays NULL."""
    newest = wide.where(F.col("date") == wide.agg(F.max("date")).scalar())
    # of repeated newest rows one is taken whole
    row = newest.agg(F.max(F.struct(*targets)).alias("r")).select("r.*")
    return row.select(
        F.explode(F.array(*[
            F.struct(F.lit(t).alias("target"), F.col(f"`{t}`").cast("double").alias("last_actual"))
            for t in targets
        ])).alias("x")
    ).select("x.*")


def last_actual_by_target(long: DataFrame) -> DataFrame:
    """The same for a long panel: each target's value on its own newest date."""
    return long.groupBy(F.col("series").alias("target")).agg(
        F.max_by("value", "date").alias("last_actual")
    )


def pair_models(preds: DataFrame, anchors: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """One row per (date, target) both models have a row for, with the last actual."""
    is_a, is_b = F.col("model") == model_a, F.col("model") == model_b
    return (
        preds.where(is_a | is_b)
        .groupBy("forecast_date", "target")
        .agg(
            F.max(F.when(is_a, F.col("predicted"))).alias("a"),
            F.max(F.when(is_b, F.col("predicted"))).alias("b"),
            F.count_if(is_a).alias("n_a"),
            F.count_if(is_b).alias("n_b"),
        )
        .where("n_a > 0 AND n_b > 0")
        .drop("n_a", "n_b")
        .join(anchors, "target", "left")
        .select("forecast_date", "target", "a", "b", "last_actual")
    )


def mixed_path(pairs: DataFrame) -> DataFrame:
    """Path with the direction of model a and the step size of model b.

    Each step multiplies the path so far: up ``1 + size``, down ``1 - size`` but not below
    zero, unchanged if a does not move or a comparison is impossible.  The first step is
    taken against the last actual.  Steps depend on each other, so the path is a fold over
    the target's horizon (a short array), not a product: clamping makes the order matter.
    """
    w = W.partitionBy("target").orderBy("forecast_date")
    prev_a = F.coalesce(F.lag("a").over(w), F.when(F.row_number().over(w) == 1, F.col("last_actual")))
    prev_b = F.coalesce(F.lag("b").over(w), F.when(F.row_number().over(w) == 1, F.col("last_actual")))
    steps = pairs.select(
        "target", "forecast_date", "last_actual",
        F.when(F.col("a") > prev_a, 1).when(F.col("a") < prev_a, -1).otherwise(0).alias("dir"),
        F.coalesce(F.abs(divide(F.col("b") - prev_b, prev_b)), F.lit(0.0)).alias("size"),
    )
    paths = steps.groupBy("target").agg(
        F.array_sort(F.collect_list(F.struct("forecast_date", "dir", "size", "last_actual"))).alias("steps")
    )

    def step(done, s):
        at = F.when(F.size(done) == 0, s["last_actual"]).otherwise(F.element_at(done, -1)["mixed"])
        moved = (
            F.when(s["dir"] == 1, at * (1 + s["size"]))
            .when(s["dir"] == -1, at_least(at * (1 - s["size"]), 0.0))
            .otherwise(at)
        )
        return F.concat(done, F.array(F.struct(s["forecast_date"].alias("forecast_date"), moved.alias("mixed"))))

    start = F.array().cast("array<struct<forecast_date:date,mixed:double>>")
    return paths.select(
        "target", F.explode(F.aggregate("steps", start, step)).alias("x")
    ).select("target", "x.forecast_date", F.col("x.mixed").alias("predicted"))


def ensemble(pairs: DataFrame) -> DataFrame:
    """Mean of both models, NULL if either is."""
    return pairs.select("target", "forecast_date", ((F.col("a") + F.col("b")) / 2).alias("predicted"))


def derived_forecasts(
    current: DataFrame, actuals: DataFrame, targets: Sequence[str], model_a: str, model_b: str,
    mixed_label: str, ensemble_label: str,
) -> DataFrame:
    """Wide rows of the mixed and ensemble models for the current forecast table."""
    preds = forecasts_long(current, targets, [model_a, model_b])
    pairs = pair_models(preds, last_actual(actuals, targets), model_a, model_b)
    both = mixed_path(pairs).withColumn("model", F.lit(mixed_label)).unionByName(
        ensemble(pairs).withColumn("model", F.lit(ensemble_label))
    )
    return to_wide(both, targets, ["forecast_date", "model"], series="target", value="predicted")


def with_derived(current: DataFrame, derived: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Current table with the derived models replaced."""
    return current.where(~F.col("model").isin(list(labels))).unionByName(derived)


def snapshot(current: DataFrame, run_date: dt.date) -> DataFrame:
    """The current table as a day of the forecast history."""
    return current.withColumn("run_date", F.lit(run_date))
