"""Parquet and CSV inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pricepanel.functions.dates import day_of
from pricepanel.operators.panel import (
    business_days_only, clean_numeric, keep_last, lower_names,
)


def read_panel(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A raw wide panel as it is on disk."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def model_panel(table: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A stored panel made ready for models.

    Lower-case names, valid dates, one row per date, Monday to Friday, clean numbers.  Naming
    the columns a model needs keeps the scan to them.
    """
    df = lower_names(table)
    if "date" not in df.columns:
        raise ValueError("the table needs a date column")
    values = [c for c in dict.fromkeys(columns or df.columns) if c != "date" and c in df.columns]
    df = df.select("date", *values).withColumn("date", day_of(df, "date")).where(F.col("date").isNotNull())
    return keep_last(clean_numeric(business_days_only(df), values), ["date"], [])


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """``target, variable, position`` of the features switched on in a CSV file.

    The file needs ``commodity`` (or ``target``/``asset``) and ``variable``; a ``usada`` (or
    ``used``) column, if there is one, must be 1.
    """
    rows = spark.read.csv(path, header=True)
    # place in the file: a large file is read in blocks, and ids grow within a block
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    names = rows.columns
    placed = rows.select(*[F.col(f"`{c}`") for c in names], place.alias("position"))
    return pick_features(placed.toDF(*[c.strip().lower() for c in names], "position"))


def pick_features(raw: DataFrame) -> DataFrame:
    """The same from a frame that already has its ``position`` column."""
    key = next((c for c in ("commodity", "target", "asset") if c in raw.columns), None)
    if key is None or "variable" not in raw.columns:
        raise ValueError(f"need a target and a variable column, found {raw.columns}")
    used = next((c for c in ("usada", "used") if c in raw.columns), None)
    if used:
        raw = raw.where(F.coalesce(F.col(used).try_cast("double").try_cast("int"), F.lit(0)) == 1)
    return raw.where(F.col(key).isNotNull() & F.col("variable").isNotNull()).select(
        F.lower(F.trim(F.col(key))).alias("target"), F.lower(F.trim("variable")).alias("variable"), "position"
    )


def feature_lists(features: DataFrame) -> DataFrame:
    """``target, variables``: the list per target in file order."""
    rows = F.array_sort(F.collect_list(F.struct("position", "variable")))
    return features.groupBy("target").agg(rows["variable"].alias("variables"))


def melt_features(raw: DataFrame) -> DataFrame:
    """Features from a wide file: one row per ``asset``, variables in the other columns."""
    raw = lower_names(raw)
    if "asset" not in raw.columns:
        raise ValueError(f"need an asset column, found {raw.columns}")
    others = [c for c in raw.columns if c != "asset"]
    order = F.create_map(*[F.lit(x) for i, c in enumerate(others) for x in (c, i)])
    long = raw.unpivot(["asset"], [F.col(c).cast("string").alias(c) for c in others], "column", "variable")
    return long.where(F.col("variable").isNotNull()).select(
        F.lower(F.trim("asset")).alias("target"), F.trim("variable").alias("variable"),
        order[F.col("column")].cast("long").alias("position"),
    )
