"""Data-quality checks.  Every check returns rows of the quality fact (``FACT``).

Inputs may hold repeated dates (that is one of the checks), so nothing here relies on
one row per (series, date): rows are reduced by aggregation, or by rank limits that Spark
applies before the shuffle, and no task sees a whole series.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pricepanel.functions.dates import expected_data_date
from pricepanel.functions.numbers import divide
from pricepanel.operators.panel import business_calendar, to_long
from pricepanel.session import saved

FACT = [
    "review_date", "review_ts", "table_name", "metric_group", "metric", "series",
    "data_date", "value", "threshold", "status", "detail",
]


class Review:
    """What every fact row carries: review date, time and the table under review."""

    def __init__(self, as_of: dt.date, run_ts: dt.datetime | None = None, table_name: str = "panel"):
        self.as_of = as_of
        self.run_ts = run_ts or dt.datetime.combine(as_of, dt.time())
        self.table_name = table_name

    def rows(self, df: DataFrame, group: str, metric: str, threshold: float) -> DataFrame:
        """Complete ``df`` (value, status, detail and optionally series, data_date)."""
        have = set(df.columns)
        cols = {
            "review_date": F.lit(self.as_of),
            "review_ts": F.lit(self.run_ts),
            "table_name": F.lit(self.table_name),
            "metric_group": F.lit(group),
            "metric": F.lit(metric),
            "series": F.col("series").cast("string") if "series" in have else F.lit(None).cast("string"),
            "data_date": F.col("data_date") if "data_date" in have else F.lit(None).cast("date"),
            "value": F.col("value").cast("double"),
            "threshold": F.lit(float(threshold)),
            "status": F.col("status"),
            "detail": F.col("detail"),
        }
        return df.select(*[cols[c].alias(c) for c in FACT])


def _level(value: Column, warn: float, error: float) -> Column:
    return F.when(value >= error, "error").when(value >= warn, "warn").otherwise("ok")


def _text(*parts) -> Column:
    """NULL if any part is NULL."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def no_data(dates: DataFrame, review: Review) -> DataFrame:
    """One error row if there is no valid date at all, else nothing."""
    last = dates.agg(F.max("date").alias("last")).where(F.col("last").isNull())
    return review.rows(
        last.select(
            F.lit(None).cast("double").alias("value"),
            F.lit("error").alias("status"),
            F.lit("the table under review has no row with a valid date").alias("detail"),
        ),
        "freshness", "no_data_available", 0.0,
    )


def freshness(dates: DataFrame, review: Review) -> DataFrame:
    """Days the newest date lags behind the last weekday before the review date."""
    last = dates.agg(F.max("date").alias("data_date")).where(F.col("data_date").isNotNull())
    lag = last.withColumn("expected", expected_data_date(F.lit(review.as_of)))
    return review.rows(
        lag.select(
            "data_date",
            F.greatest(F.date_diff("expected", "data_date"), F.lit(0)).alias("value"),
            F.when(F.col("data_date") >= F.col("expected"), "ok").otherwise("error").alias("status"),
            _text("last_date=", F.col("data_date"), " | expected_date=", F.col("expected")).alias("detail"),
        ),
        "freshness", "days_lag_vs_expected", 0.0,
    )


def rows_per_day(dates: DataFrame) -> DataFrame:
    """``date, n``: combined before the shuffle, however often one date repeats."""
    return dates.where(F.col("date").isNotNull()).groupBy("date").agg(F.count("*").alias("n"))


def duplicate_dates(dates: DataFrame, review: Review) -> DataFrame:
    """Rows beyond one per date; ``dates`` may be counted already (``rows_per_day``)."""
    per_day = dates if "n" in dates.columns else rows_per_day(dates)
    n = per_day.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_dates")).where("n_dates > 0")
    extra = F.col("n_rows") - F.col("n_dates")
    return review.rows(
        n.select(
            extra.alias("value"),
            F.when(extra == 0, "ok").otherwise("error").alias("status"),
            _text("rows=", F.col("n_rows"), " | dates=", F.col("n_dates")).alias("detail"),
        ),
        "duplicates", "duplicate_dates", 0.0,
    )


def missing_days(dates: DataFrame) -> DataFrame:
    """Business days between the first and last date on which there is no row."""
    present = dates.where(F.col("date").isNotNull()).select("date").distinct()
    return business_calendar(present).join(present, "date", "left_anti")


def gaps(dates: DataFrame, review: Review) -> DataFrame:
    """Number of missing business days; the detail names the first ten."""
    missing = missing_days(dates)
    first_ten = missing.orderBy("date").limit(10).agg(
        F.array_join(F.array_sort(F.collect_list(F.col("date").cast("string"))), ", ").alias("days")
    )
    n = missing.agg(F.count("*").alias("value")).crossJoin(F.broadcast(first_ten))
    some = dates.agg(F.max("date").alias("last")).where(F.col("last").isNotNull())
    return review.rows(
        n.crossJoin(F.broadcast(some)).select(
            "value",
            F.when(F.col("value") == 0, "ok").otherwise("error").alias("status"),
            F.when(F.col("value") == 0, "no gaps").otherwise(F.col("days")).alias("detail"),
        ),
        "gaps", "missing_business_days", 0.0,
    )


def newest_dates(dates: DataFrame, n: int) -> DataFrame:
    return dates.where(F.col("date").isNotNull()).select("date").distinct().orderBy(F.desc("date")).limit(n)


def _newest(long: DataFrame, dates: DataFrame | None) -> Column:
    """Newest date of the table as a scalar subquery; ``dates`` spares reading the long form."""
    return (long if dates is None else dates).agg(F.max("date")).scalar()


def _times(long: DataFrame) -> Column:
    """How often a row counts: ``copies``, where equal rows were counted."""
    return F.col("copies") if "copies" in long.columns else F.lit(1).cast("long")


def null_share(long: DataFrame, review: Review, n_dates: int = 20, dates: DataFrame | None = None) -> DataFrame:
    """Percent of NULLs per series on the newest dates of the table.

    The newest dates are the ones from the oldest of them on: as a range it reaches the scan.
    """
    since = newest_dates(long if dates is None else dates, n_dates).agg(F.min("date")).scalar()
    times = _times(long)
    stats = long.where(F.col("date") >= since).groupBy("series").agg(
        F.sum(times).alias("n"), F.sum(F.when(F.col("value").isNull(), times).otherwise(0)).alias("nulls")
    )
    pct = 100 * divide(F.col("nulls").cast("double"), F.col("n").cast("double"))
    return review.rows(
        stats.select(
            "series",
            F.lit(_newest(long, dates)).alias("data_date"),
            pct.alias("value"),
            _level(pct, 10, 20).alias("status"),
            _text("nulls=", F.col("nulls"), " | rows=", F.col("n")).alias("detail"),
        ),
        "nulls", "pct_nulls_20d", 10.0,
    )


def latest_null(long: DataFrame, review: Review, dates: DataFrame | None = None) -> DataFrame:
    """Whether each series is NULL on the newest date."""
    latest = long.where(F.col("date") == _newest(long, dates))
    if "copies" in long.columns:
        latest = latest.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    missing = F.col("value").isNull()
    return review.rows(
        latest.select(
            "series",
            F.col("date").alias("data_date"),
            F.when(missing, 1.0).otherwise(0.0).alias("value"),
            F.when(missing, "error").otherwise("ok").alias("status"),
            _text("value=", F.col("value")).alias("detail"),
        ),
        "nulls", "is_null_latest_date", 0.0,
    )


def newest_observations(long: DataFrame, n_dates: int) -> DataFrame:
    """Non-null values of each series' ``n_dates`` newest dates: ``series, date, value, copies``.

    Every input partition first keeps its own ``n_dates`` newest dates of each series, so older
    history is never shuffled.  What is left is counted per distinct row before the next
    shuffle, so neither a hot series nor a hot group of copies reaches one task.
    """
    seen = long.where(F.col("value").isNotNull())
    if "copies" not in long.columns:
        seen = _counted(_near(seen, n_dates))
    by_date = W.partitionBy("series").orderBy(F.desc("date"))
    ranked = seen.withColumn("rank", F.dense_rank().over(by_date))
    return ranked.where(F.col("rank") <= n_dates).select("series", "date", "value", "copies")


def _near(rows: DataFrame, n_dates: int) -> DataFrame:
    """Rows of each series' ``n_dates`` newest dates within each input partition."""
    own = W.partitionBy("series", "empty", "part").orderBy(F.desc("date"))
    parted = rows.withColumns({"part": F.spark_partition_id(), "empty": F.col("value").isNull()})
    return parted.withColumn("rank", F.dense_rank().over(own)).where(F.col("rank") <= n_dates)


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("series", "date", "value").agg(F.count("*").alias("copies"))


def newest_state(long: DataFrame, n_dates: int) -> DataFrame:
    """``series, date, value, copies``: all that the value checks ask of a table, in one scan.

    Values and NULLs apart, the rows of each series' ``n_dates`` newest dates in each input
    partition; so both the newest observations of a series and all its rows on the table's newest
    ``n_dates`` dates are among them, whatever lies between.
    """
    return _counted(_near(long, n_dates))


LOOKBACK = 30


def latest_zscores(
    recent: DataFrame, newest: Column, lookback: int = LOOKBACK
) -> DataFrame:
    """Newest-date values against the ``lookback`` observations before each of them.

    ``recent``: at least the ``lookback + 1`` newest dates.  Beyond ``lookback`` copies of a
    row the frame holds nothing but its value, so later copies all repeat one result: they
    are left out of the window and spread again behind it.
    """
    spread = recent.withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(lookback + 1)).cast("int")))
    )
    frame = W.partitionBy("series").orderBy("date", "value", "copy").rowsBetween(-lookback, -1)
    scored = spread.withColumns({
        "mean": F.avg("value").over(frame), "std": F.stddev_samp("value").over(frame),
    })
    times = F.when(F.col("copy") > lookback, F.col("copies") - lookback).otherwise(1).cast("int")
    std = F.when(F.col("std") != 0, F.col("std"))
    return (
        scored.where(F.col("date") == newest)
        .withColumn("zscore", divide(F.abs(F.col("value") - F.col("mean")), std))
        .withColumn("i", F.explode(F.sequence(F.lit(1), times)))
        .select("series", "date", "value", "mean", "std", "zscore")
    )


def outliers(
    long: DataFrame, review: Review, lookback: int = LOOKBACK, dates: DataFrame | None = None,
    recent: DataFrame | None = None,
) -> DataFrame:
    """Z-score of the newest values.  ``recent`` may be shared with ``flatline``."""
    recent = newest_observations(long, lookback + 1) if recent is None else recent
    z = F.col("zscore")
    text = F.format_string("value=%f | avg_30=%f | std_30=%f", "value", "mean", "std")
    return review.rows(
        latest_zscores(recent, _newest(long, dates), lookback).select(
            "series",
            F.col("date").alias("data_date"),
            F.when(z.isNull(), "na").otherwise(_level(z, 2, 3)).alias("status"),
            F.when(F.col("mean").isNotNull() & F.col("std").isNotNull(), text).alias("detail"),
            z.alias("value"),
        ),
        "outliers", "zscore_latest_30", 3.0,
    )


def flatline(
    long: DataFrame, review: Review, n: int = 5, dates: DataFrame | None = None, recent: DataFrame | None = None
) -> DataFrame:
    """Distinct values among the newest ``n`` observations of each series."""
    recent = newest_observations(long, n) if recent is None else recent
    newest = W.partitionBy("series").orderBy(F.desc("date"), F.desc("value"))
    # observations up to and including the row, copies counted
    upto = F.sum("copies").over(newest.rowsBetween(W.unboundedPreceding, 0))
    counted = recent.withColumn("taken", F.least(F.col("copies"), F.lit(n) - (upto - F.col("copies"))))
    stats = counted.where(F.col("taken") > 0).groupBy("series").agg(
        F.sum("taken").alias("n"), F.size(F.collect_set("value")).cast("long").alias("distinct")
    )
    return review.rows(
        stats.select(
            "series",
            F.lit(_newest(long, dates)).alias("data_date"),
            F.col("distinct").alias("value"),
            F.when(F.col("n") < n, "na").when(F.col("distinct") == 1, "warn").otherwise("ok").alias("status"),
            _text("rows=", F.col("n"), " | distinct=", F.col("distinct")).alias("detail"),
        ),
        "flatline", "distinct_values_last_5d", 1.0,
    )


def all_checks(wide: DataFrame, columns: Sequence[str], review: Review) -> DataFrame:
    """Every check over a wide table with a ``date`` column; one error row if it is empty.

    The table is read twice, once for its dates and once for its values; what the checks need of
    either, a row per date and the newest rows of each series, is written down and shared.
    """
    base = wide.where(F.col("date").isNotNull()).select("date", *columns)
    days = saved(rows_per_day(base.select("date")), "days")
    long = saved(newest_state(to_long(base, columns, keep_nulls=True), LOOKBACK + 1), "newest")
    dates = days.select("date")
    recent = newest_observations(long, LOOKBACK + 1)
    parts = [
        no_data(dates, review), freshness(dates, review), duplicate_dates(days, review),
        gaps(dates, review), null_share(long, review, dates=dates), latest_null(long, review, dates),
        outliers(long, review, dates=dates, recent=recent), flatline(long, review, dates=dates, recent=recent),
    ]
    return reduce(DataFrame.unionByName, parts)
