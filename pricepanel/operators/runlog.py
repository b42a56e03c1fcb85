"""Run log: one row per stage with row counts, date range and status."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

COLUMNS = [
    "run_date", "run_ts", "stage", "status", "table_name", "n_rows", "min_date", "max_date",
    "expected_rows", "detail",
]


def _counts(date: str) -> list[Column]:
    return [
        F.count("*").alias("n_rows"),
        F.min(F.col(date).cast("date")).alias("min_date"),
        F.max(F.col(date).cast("date")).alias("max_date"),
    ]


def table_stage(df: DataFrame, stage: str, table_name: str, date: str = "date") -> DataFrame:
    """Count and date range of a whole data table (rows with a date)."""
    return df.where(F.col(date).isNotNull()).agg(*_counts(date)).select(
        F.lit(stage).alias("stage"), F.lit(table_name).alias("table_name"),
        "n_rows", "min_date", "max_date", F.lit(None).cast("long").alias("expected_rows"),
    )


def model_stages(
    df: DataFrame, prefix: str, suffix: str, table_name: str, models: Sequence[str], expected: int,
    names: Mapping[str, str] | None = None, expect_all: bool = False,
) -> DataFrame:
    """Count and date range per model.

    A model without rows has no stage, unless ``expect_all``: then it is logged with 0.
    """
    label = F.upper("model")
    for model, name in (names or {}).items():
        label = F.when(F.col("model") == model, name).otherwise(label)
    counted = df.where(F.col("model").isin(list(models))).groupBy("model").agg(*_counts("forecast_date"))
    if expect_all:
        listed = df.sparkSession.createDataFrame([(m,) for m in models], "model string")
        counted = listed.join(counted, "model", "left").fillna(0, ["n_rows"])
    return counted.select(
        F.concat(F.lit(prefix), label, F.lit(suffix)).alias("stage"),
        F.lit(table_name).alias("table_name"),
        "n_rows", "min_date", "max_date", F.lit(expected).cast("long").alias("expected_rows"),
    )


def stage_status() -> Column:
    """Data stages need rows; forecast stages need exactly the expected number."""
    n, want = F.col("n_rows"), F.col("expected_rows")
    is_model = F.col("stage").like("PRED_%") | F.col("stage").like("HIST_%")
    return (
        F.when(F.col("stage").isin("RAW_EXTERNAL", "DATA_PROC"), F.when(n > 0, "ok").otherwise("error"))
        .when(is_model & (n == want), "ok")
        .when(is_model & n.between(1, want - 1), "warn")
        .when(is_model & (n == 0), "error")
        .otherwise("warn")
    )


def log_rows(stages: Sequence[DataFrame], run_date: dt.date, run_ts: dt.datetime) -> DataFrame:
    every = reduce(DataFrame.unionByName, stages)
    return every.select(
        F.lit(run_date).alias("run_date"),
        F.lit(run_ts).alias("run_ts"),
        "stage",
        stage_status().alias("status"),
        "table_name", "n_rows", "min_date", "max_date", "expected_rows",
        F.concat(  # NULL without a date range
            F.lit("rows="), F.col("n_rows").cast("string"), F.lit(" | range="),
            F.col("min_date").cast("string"), F.lit(" to "), F.col("max_date").cast("string"),
        ).alias("detail"),
    )


def run_log(
    raw: DataFrame, panel: DataFrame, current: DataFrame, history: DataFrame, models: Sequence[str],
    run_date: dt.date, run_ts: dt.datetime, expected: int = 10, names: Mapping[str, str] | None = None,
    expect_all: bool = False,
    tables: Sequence[str] = ("raw_panel", "panel", "forecasts", "forecast_history"),
) -> DataFrame:
    today = history.where(F.col("run_date") == F.lit(run_date))
    return log_rows(
        [
            table_stage(raw, "RAW_EXTERNAL", tables[0]),
            table_stage(panel, "DATA_PROC", tables[1]),
            model_stages(current, "PRED_", "", tables[2], models, expected, names, expect_all),
            model_stages(today, "HIST_", "_HOY", tables[3], models, expected, names, expect_all),
        ],
        run_date, run_ts,
    )
