"""Whole files: the raw panel and feature lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricepanel.functions.dates import day_of


def write_panel(df: DataFrame, path: str, date: str = "date", name: str = "Date") -> None:
    """Write a wide panel with an explicit DATE column; rows without a date are dropped."""
    dated = df.withColumn(date, day_of(df, date)).where(F.col(date).isNotNull())
    dated.withColumnRenamed(date, name).write.mode("overwrite").parquet(path)


def write_features(df: DataFrame, path: str) -> None:
    """Selected variables as CSV, sorted by target and variable."""
    df.select("target", "variable").orderBy("target", "variable").write.mode("overwrite").csv(path, header=True)
