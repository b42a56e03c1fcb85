"""Filling gaps and building future values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pricepanel.operators.panel import future_dates

EVER = W.unboundedPreceding


def forward_fill(panel: DataFrame, keys: Sequence[str] = ("series",), order: str = "date") -> DataFrame:
    """Replace a NULL by the last value before it in its series (daily panels)."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(EVER, 0)
    return panel.withColumn("value", F.last("value", ignorenulls=True).over(w))


def forward_fill_sliced(
    panel: DataFrame,
    slice_of: Column,
    keys: Sequence[str] = ("series",),
    order: str = "date",
) -> DataFrame:
    """Forward fill for series too long for one task.

    ``slice_of`` cuts the order axis into consecutive numbered slices, e.g.
    ``floor(unix_seconds(ts) / 86400)``.  Rows are shuffled by (series, slice), so a hot
    series is spread over as many tasks as it has slices.  The last value of each slice is
    carried over in a frame of one row per (series, slice).
    """
    cut = panel.withColumn("slice", slice_of)
    # "last non-null" as an aggregate: partial per map task, no row collection
    ends = cut.groupBy(*keys, "slice").agg(
        F.max_by("value", F.when(F.col("value").isNotNull(), F.col(order))).alias("end")
    )
    before = W.partitionBy(*keys).orderBy("slice").rowsBetween(EVER, -1)
    # the carried value joins its slice as a leading row: one sort does the merge and the fill
    carried = ends.select(
        *keys, "slice", F.last("end", ignorenulls=True).over(before).alias("value"), F.lit(True).alias("carried")
    )
    rows = cut.withColumn("carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    inside = W.partitionBy(*keys, "slice").orderBy(F.desc("carried"), order).rowsBetween(EVER, 0)
    filled = rows.withColumn("value", F.last("value", ignorenulls=True).over(inside))
    return filled.where(~F.col("carried")).select(*panel.columns)


def backward_fill(panel: DataFrame, keys: Sequence[str] = ("series",), order: str = "date") -> DataFrame:
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(0, W.unboundedFollowing)
    return panel.withColumn("value", F.first("value", ignorenulls=True).over(w))


def fill_both_ways(panel: DataFrame, keys: Sequence[str] = ("series",), order: str = "date") -> DataFrame:
    """Forward fill, then fill what is left at the start from the first value.

    After a forward fill only rows before a series' first value are NULL, and that value is
    the same for all of them: an aggregate over the window's partition, no second sort.
    """
    w = W.partitionBy(*keys).orderBy(order)
    forward = F.last("value", ignorenulls=True).over(w.rowsBetween(EVER, 0))
    first = F.first("value", ignorenulls=True).over(w.rowsBetween(EVER, W.unboundedFollowing))
    return panel.withColumn("value", F.coalesce(forward, first))


def reload_range(raw: DataFrame, anchor: str, date: str = "date") -> DataFrame:
    """One row ``lo, hi``: the dates on which the anchor column has a value."""
    return raw.where(F.col(anchor).isNotNull()).agg(F.min(date).alias("lo"), F.max(date).alias("hi"))


def seeded_fill(
    stored: DataFrame, batch: DataFrame, columns: Sequence[str], date: str = "date"
) -> DataFrame:
    """Forward fill of a wide batch that continues from the newest stored row before it.

    The seed row takes part in the fill and is not returned.  Runs on the long form: one
    window per series instead of one task for the whole table.  An empty batch gives no rows.
    Repeated dates stay (a quality check counts them): different rows of a date are filled in
    the order of their values, identical copies are counted, filled once and spread again.
    """
    cols = [F.col(f"`{c}`").cast("double").alias(c) for c in columns]
    rows = batch.select(date, *cols).groupBy(date, *columns).agg(F.count("*").cast("int").alias("copies"))
    at_date = W.partitionBy(date).orderBy(*[f"`{c}`" for c in columns])
    rows = rows.withColumn("row_no", F.row_number().over(at_date))

    before = stored.where(F.col(date) < batch.agg(F.min(date)).scalar())
    newest = before.where(F.col(date) == before.agg(F.max(date)).scalar())
    seed = newest.select(F.max(F.struct(date, *cols)).alias("r")).select("r.*").where(F.col(date).isNotNull())
    seed = seed.withColumns({"copies": F.lit(0), "row_no": F.lit(0)})

    long = rows.unionByName(seed).unpivot([date, "row_no", "copies"], list(columns), "series", "value")
    w = W.partitionBy("series").orderBy(date, "row_no").rowsBetween(EVER, 0)
    filled = long.withColumn("value", F.last("value", ignorenulls=True).over(w)).where("copies > 0")
    picks = [F.max(F.when(F.col("series") == c, F.col("value"))).alias(c) for c in columns]
    wide = filled.groupBy(date, "row_no", "copies").agg(*picks)
    return wide.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(date, *columns)


def seeded_fill_long(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The same for panels: every series of the batch continues from its newest stored value.

    Stored history is reduced to one row per series before the shuffle.
    """
    before = stored.where(F.col("date") < batch.agg(F.min("date")).scalar())
    seed = before.groupBy("series").agg(F.max_by("value", "date").alias("value"), F.max("date").alias("date"))
    rows = batch.select("series", "date", "value", F.lit(True).alias("is_new")).unionByName(
        seed.withColumn("is_new", F.lit(False))
    )
    return forward_fill(rows).where("is_new").drop("is_new")


def median_fill(
    panel: DataFrame, train: DataFrame | None = None, median_of: str = "raw", default: float | None = 0.0
) -> DataFrame:
    """Forward fill, then the series' median, then ``default`` (None leaves a series without
    any value empty).

    ``median_of``: "raw" takes the median of the values as they came, "filled" that of the
    forward-filled ones.  ``train`` is the panel the median is taken from (default: itself).
    """
    if median_of not in ("raw", "filled"):
        raise ValueError("median_of must be 'raw' or 'filled'")
    filled = forward_fill(panel)
    if train is None:  # same partitioning as the fill: no second shuffle
        w = W.partitionBy("series")
        if median_of == "filled":
            mid = F.median("value").over(w)
            return filled.withColumn("value", F.coalesce("value", mid, F.lit(default)))
        both = panel.withColumns({
            "mid": F.median("value").over(w),
            "value": F.last("value", ignorenulls=True).over(w.orderBy("date").rowsBetween(EVER, 0)),
        })
        return both.withColumn("value", F.coalesce("value", "mid", F.lit(default))).drop("mid")
    base = forward_fill(train) if median_of == "filled" else train
    mid = base.groupBy("series").agg(F.median("value").alias("mid"))
    return (
        filled.join(mid, "series", "left")
        .withColumn("value", F.coalesce("value", "mid", F.lit(default)))
        .drop("mid")
    )


def most_frequent(panel: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Most frequent value per series, the lowest on a tie.  Counting by value first keeps
    the state of a hot series spread over tasks."""
    counts = panel.where(F.col("value").isNotNull()).groupBy(*keys, "value").agg(
        F.count("*").alias("n")
    )
    best = F.max_by("value", F.struct(F.col("n"), -F.col("value")))
    return counts.groupBy(*keys).agg(best.alias("value"))


def future_values(
    history: DataFrame, horizon: int, method: str = "last", median_of: str = "raw",
    dates: DataFrame | None = None,
) -> DataFrame:
    """Covariates over the forecast horizon, from history only.

    ``method``: "last" repeats the newest filled value, "median" the median, "mode" the most
    frequent filled value.  ``dates`` (``step, date``) defaults to the next business days
    after the newest date of the history; more than ``horizon`` of them raise ``ValueError``.
    """
    if method not in ("last", "median", "mode"):
        raise ValueError("method must be 'last', 'median' or 'mode'")
    if method == "median":
        base = forward_fill(history) if median_of == "filled" else history
        row = base.groupBy("series").agg(F.median("value").alias("value"))
    elif method == "mode":
        row = history.select("series").distinct().join(
            most_frequent(median_fill(history, median_of=median_of)), "series", "left")
    else:
        # newest non-null value; a series with none falls back to its median, then to 0
        row = history.groupBy("series").agg(
            F.max_by("value", F.when(F.col("value").isNotNull(), F.col("date"))).alias("value")
        )
    row = row.withColumn("value", F.coalesce("value", F.lit(0.0)))
    if dates is not None and dates.limit(horizon + 1).count() > horizon:
        raise ValueError(f"more than {horizon} dates")
    days = future_dates(history, horizon) if dates is None else dates
    return row.crossJoin(F.broadcast(days.select("step", "date")))  # at most horizon rows
