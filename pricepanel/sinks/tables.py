"""Replacing slices of partitioned Parquet tables.

Plain files have no DELETE.  A slice is replaced by writing the rows that stay of the partitions
it touches, and the new rows, to a folder of their own, and then publishing a version of the table
that lists this folder in place of those partitions (``manifest``).  Publishing is one rename:
readers, also those already running, see the table before or after it, never between; a driver or
executor lost at any time leaves the old rows readable, and the job can simply be run again.
Partitions left without rows are only left out of the list.

A writer that finds its number taken looks at the version published in between: where that has
not changed the partitions it replaces, it publishes on top of it, else it starts again.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pricepanel.sinks import manifest as M

# Characters Spark escapes in partition folder names.
ESCAPED = set('"#%\'*/:=?\\{[]^\x7f') | {chr(i) for i in range(1, 32)}
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Times a writer starts again after others were first.
ATTEMPTS = 5


def _read(spark: SparkSession, path: str, schema: T.StructType, version: M.Manifest) -> DataFrame:
    folders = sorted({f"{path}/{f}" for fs in version.folders.values() for f in fs})
    if not folders:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return found.select(*[F.col(f.name) for f in schema])


def find_table(spark: SparkSession, path: str, schema: T.StructType, number: int | None = None) -> DataFrame | None:
    """The table, or its version ``number``; None if it was never written."""
    version = M.newest(spark, path) if number is None else M.load(spark, path, number)
    return None if version is None else _read(spark, path, schema, version)


def read_table(spark: SparkSession, path: str, schema: T.StructType, number: int | None = None) -> DataFrame:
    """The table, or no rows if it was never written."""
    found = find_table(spark, path, schema, number)
    return spark.createDataFrame([], schema) if found is None else found


def version(spark: SparkSession, path: str) -> int:
    """Number of the newest version, 0 if the table was never written."""
    return max(M.numbers(spark, path), default=0)


def partition_values(spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str], number: int | None = None) -> DataFrame:
    """The values of the partition columns that have rows, from the manifest alone."""
    found = M.newest(spark, path) if number is None else M.load(spark, path, number)
    return _values(spark, schema, by, found or M.NOTHING)


def _values(spark: SparkSession, schema: T.StructType, by: Sequence[str], found: M.Manifest) -> DataFrame:
    text = T.StructType([T.StructField(c, T.StringType()) for c in by])
    rows = spark.createDataFrame(list(found.folders), text)  # one row per partition
    return rows.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in by])


def partitions_meeting(spark: SparkSession, path: str, lo: dt.date, hi: dt.date | None = None) -> dict[M.Partition, tuple[str, str] | None]:
    """Partitions that may hold dates from ``lo`` to ``hi`` (on, if None), with their least and
    greatest date, by the manifest alone.  The dates are those of the column the writers named as
    ``span``; a partition written without one may hold any date."""
    found = M.newest(spark, path) or M.NOTHING
    spans = {p: found.span(p) for p in found.folders}
    return {p: s for p, s in spans.items() if s is None or (s[1] >= lo.isoformat() and (hi is None or s[0] <= hi.isoformat()))}


def _folder(by: Sequence[str], values: Sequence[object]) -> str:
    def text(v: object) -> str:
        if v is None:
            return NO_VALUE
        return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in str(v))

    return "/".join(f"{k}={text(v)}" for k, v in zip(by, values))


def _write(
    rows: DataFrame, path: str, schema: T.StructType, by: Sequence[str], sort: Sequence[str], span: str | None,
) -> tuple[dict[M.Partition, str], dict[str, tuple[str | None, str | None]]]:
    """Write rows to a version folder of their own; the folder of each partition, and its span."""
    name = f"version={uuid.uuid4().hex}"
    # gathers a partition's rows into few files, and splits one too large for a task
    out = rows.hint("rebalance", *by)
    if sort:
        out = out.sortWithinPartitions(*by, *sort)
    out.write.partitionBy(*by).parquet(f"{path}/{name}")
    text = [F.col(c).cast("string").alias(c) for c in by]
    written = rows.sparkSession.read.schema(schema).parquet(f"{path}/{name}")
    # of the data no column is read but the span's
    bounds = [F.min(span).cast("string"), F.max(span).cast("string")] if span else [F.lit(None), F.lit(None)]
    found = written.groupBy(*text).agg(bounds[0].alias("_lo"), bounds[1].alias("_hi")).collect()  # one row per partition
    folders = {tuple(r)[:-2]: f"{name}/{_folder(by, tuple(r)[:-2])}" for r in found}
    return folders, {folders[tuple(r)[:-2]]: (r["_lo"], r["_hi"]) for r in found} if span else {}


def replace_rows(
    spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str], gone: Column, new: DataFrame,
    touched: Column | None = None, sort: Sequence[str] = (), span: str | None = None,
) -> int:
    """Delete the rows where ``gone`` holds and add ``new``; the number of the version made.

    ``touched`` limits the partitions looked at (default: ``gone``); it must hold for every
    row of the partitions concerned and may use partition columns only.  Rows of ``new`` in
    other partitions are added to those.  An empty ``new`` still deletes.  ``span`` names a date
    column whose least and greatest value the manifest keeps for each partition.
    """
    touched = gone if touched is None else touched
    fitted = new.select(*[F.col(f.name).cast(f.dataType) for f in schema])
    for _ in range(ATTEMPTS):
        base = M.newest(spark, path) or M.NOTHING
        parts = [tuple(r) for r in _values(spark, schema, by, base).where(touched).select(*[F.col(c).cast("string") for c in by]).collect()]
        old = M.Manifest(base.number, {p: base.folders[p] for p in parts})
        rows = fitted
        if parts:
            rows = _read(spark, path, schema, old).where(~F.coalesce(gone, F.lit(False))).unionByName(fitted)
        added, spans = _write(rows, path, schema, by, sort, span)
        for _ in range(ATTEMPTS):
            made = base.replaced(parts, added, spans)
            try:
                M.publish(spark, path, made)
                return made.number
            except M.Conflict:
                base = M.newest(spark, path)
                here = [tuple(r) for r in _values(spark, schema, by, base).where(touched).select(*[F.col(c).cast("string") for c in by]).collect()]
                if {p: base.folders[p] for p in here} != old.folders:
                    break  # the rows that stay are others now
    raise M.Conflict(f"{path}: other writers were first {ATTEMPTS} times")


def write_table(spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str], rows: DataFrame, sort: Sequence[str] = ()) -> int:
    """Make ``rows`` the whole table; the number of the version made."""
    return replace_rows(spark, path, schema, by, F.lit(True), rows, sort=sort)


def replace_model(spark: SparkSession, path: str, schema: T.StructType, model: str, new: DataFrame) -> int:
    """All rows of one model; the table is partitioned by model."""
    return replace_rows(spark, path, schema, ["model"], F.col("model") == model, new)


def delete_models(spark: SparkSession, path: str, schema: T.StructType, models: Sequence[str]) -> int:
    none = spark.createDataFrame([], schema)
    return replace_rows(spark, path, schema, ["model"], F.col("model").isin(list(models)), none)


def replace_range(
    spark: SparkSession, path: str, schema: T.StructType, lo: dt.date | None, hi: dt.date | None, new: DataFrame,
) -> int | None:
    """All rows with lo <= date <= hi; the table is partitioned by ``month``.

    Old dates in the range that ``new`` does not bring vanish.  Without a range nothing happens.
    """
    if lo is None or hi is None:
        return None
    months = F.col("month").between(F.trunc(F.lit(lo), "MM"), F.trunc(F.lit(hi), "MM"))
    dated = new.withColumn("month", F.trunc("date", "MM"))
    return replace_rows(spark, path, schema, ["month"], F.col("date").between(F.lit(lo), F.lit(hi)), dated,
                 touched=months, sort=["date"])


def replace_day(
    spark: SparkSession, path: str, schema: T.StructType, day: dt.date, new: DataFrame, by: str = "run_date",
    sort: Sequence[str] = (), span: str | None = None,
) -> int:
    """The partition of one run date."""
    return replace_rows(spark, path, schema, [by], F.col(by) == F.lit(day), new, sort=sort, span=span)


def replace_review(
    spark: SparkSession, path: str, schema: T.StructType, day: dt.date, table_name: str, new: DataFrame
) -> int:
    """The rows of one review date and reviewed table (both are partition columns)."""
    slice_ = (F.col("review_date") == F.lit(day)) & (F.col("table_name") == table_name)
    return replace_rows(spark, path, schema, ["review_date", "table_name"], slice_, new,
                 sort=["metric_group", "series"])


def replace_runs(
    spark: SparkSession, path: str, schema: T.StructType, runs: DataFrame | Sequence[dt.date], new: DataFrame,
    sort: Sequence[str] = (), span: str | None = None,
) -> int:
    """Every run date listed in ``runs``, whether or not ``new`` has rows for it.

    Run dates are calendar days, so the list is short.
    """
    days = [r[0] for r in runs.select("run_date").distinct().collect()] if isinstance(runs, DataFrame) else list(runs)
    gone = F.col("run_date").isin(days) if days else F.lit(False)
    return replace_rows(spark, path, schema, ["run_date"], gone, new, sort=sort, span=span)
