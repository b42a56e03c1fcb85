"""Rolling-origin windows, the naive baseline and parameter grids.

Windows are assigned from the end of each series.  Panels hold one row per (series, date).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F


def newest_rows(panel: DataFrame, n: int, keys: Sequence[str] = ("series",)) -> DataFrame:
    """The ``n`` newest rows of each series with ``e`` (0 = newest) and ``have``, the number of
    them.  Spark applies the rank limit before the shuffle, so history stays where it is."""
    newest = W.partitionBy(*keys).orderBy(F.desc("date"))
    ranked = panel.withColumn("e", F.row_number().over(newest)).where(F.col("e") <= n)
    return ranked.withColumns({"e": F.col("e") - 1, "have": F.count(F.lit(1)).over(W.partitionBy(*keys))})


def rolling_folds(
    panel: DataFrame, horizon: int = 7, n_folds: int = 5, keys: Sequence[str] = ("series",)
) -> DataFrame:
    """Validation rows with their ``window_id`` (1 = oldest) and ``train_rows``.

    The training rows of a fold are the first ``train_rows`` rows of the series.  A series
    with no more than ``n_folds * horizon + 5`` rows has no folds (see ``too_short``).
    """
    total = n_folds * horizon
    block = F.floor(F.col("e") / horizon)
    tail = newest_rows(panel, total + 6, keys).where((F.col("have") > total + 5) & (F.col("e") < total))
    n = panel.groupBy(*keys).agg(F.count("*").alias("n"))
    return (
        tail.withColumn("window_id", (n_folds - block).cast("long"))
        .join(n, list(keys))
        .withColumn("train_rows", (F.col("n") - (block + 1) * horizon).cast("long"))
        .drop("e", "have", "n")
    )


def too_short(panel: DataFrame, min_rows: int, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Series a backtest has to leave out."""
    n = panel.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return n.where(F.col("n_rows") < min_rows)


def holdout_windows(
    panel: DataFrame, test_rows: int = 63, window: int = 7, keys: Sequence[str] = ("series",)
) -> DataFrame:
    """The last ``test_rows`` rows in consecutive full windows, with id and date bounds."""
    tail = (
        newest_rows(panel, test_rows, keys)
        .where(F.col("have") == test_rows)
        .withColumn("at", (F.lit(test_rows - 1) - F.col("e")).cast("int"))
        .where(F.col("at") < (test_rows // window) * window)
    )
    # bounds by position within the series' own order: no sort by window
    w = W.partitionBy(*keys).orderBy(F.desc("date"))
    place = F.col("at") % window
    start = F.first(F.when(place == 0, F.col("date")), ignorenulls=True)
    end = F.last(F.when(place == window - 1, F.col("date")), ignorenulls=True)
    return tail.withColumns({
        "window_id": (F.floor(F.col("at") / window) + 1).cast("long"),
        "window_start": start.over(w.rowsBetween(0, W.unboundedFollowing)),
        "window_end": end.over(w.rowsBetween(W.unboundedPreceding, 0)),
    }).drop("e", "have", "at")


def calendar_windows(dates: DataFrame, test_rows: int = 63, window: int = 7) -> DataFrame:
    """``date, window_id, window_start, window_end`` cut once from the panel's distinct dates, the
    same for every series whatever gaps it has."""
    days = dates.select("date").where(F.col("date").isNotNull()).distinct()
    return holdout_windows(days.withColumn("calendar", F.lit(0)), test_rows, window, ["calendar"]).drop("calendar")


def skipped_windows(
    panel: DataFrame, test_rows: int = 63, window: int = 7, min_train: int = 21, keys: Sequence[str] = ("series",),
) -> DataFrame:
    """Windows that ``naive_last`` leaves out for their few training rows: ``keys, window_id,
    train_rows``."""
    n = panel.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= test_rows)
    ids = F.sequence(F.lit(1).cast("long"), F.lit(test_rows // window).cast("long"))
    trained = n.withColumn("window_id", F.explode(ids)).withColumn(
        "train_rows", F.col("n") - test_rows + (F.col("window_id") - 1) * window)
    return trained.where(F.col("train_rows") < min_train).drop("n")


def window_ranges(windows: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """One row per window with its bounds."""
    return windows.groupBy(*keys, "window_id").agg(
        F.min("date").alias("window_start"), F.max("date").alias("window_end"),
        F.count("*").alias("n_rows"),
    )


def naive_last(
    panel: DataFrame, test_rows: int = 63, window: int = 7, min_train: int = 21,
    keys: Sequence[str] = ("series",), model: str = "naive_last",
) -> DataFrame:
    """Backtest records of the persistence forecast: every window repeats the last non-null
    value before its first day.

    Only the newest ``test_rows`` rows of a series, and as many of its non-null ones and one more,
    go through a shuffle: the last non-null value before the first window is among the latter.
    Rows are counted by aggregation; history is neither sorted nor joined to the windows.
    """
    keys = list(keys)
    tail = newest_rows(panel, test_rows, keys).where(F.col("have") == test_rows).withColumn("at", F.lit(test_rows - 1) - F.col("e"))
    begins = tail.where(F.col("at") == 0).select(*keys, F.col("date").alias("begin"))
    held = newest_rows(panel.where(F.col("value").isNotNull()), test_rows + 1, keys).drop("e", "have")
    before = held.join(begins, keys).where(F.col("date") < F.col("begin")).groupBy(*keys).agg(F.max_by("value", "date").alias("before"))
    n = panel.groupBy(*keys).agg(F.count("*").alias("n"))
    by_date = W.partitionBy(*keys).orderBy("date")
    carried = F.coalesce(F.last("value", ignorenulls=True).over(by_date.rowsBetween(W.unboundedPreceding, -1)), F.col("before"))
    seen = tail.join(before, keys, "left").withColumn("carried", carried)
    # the value carried into a window's first day; once there is one, later days have one too
    base = F.last(F.when(F.col("at") % window == 0, F.col("carried")), ignorenulls=True)
    window_id = (F.floor(F.col("at") / window) + 1).cast("long")
    return (
        seen.withColumn("y_base", base.over(by_date.rowsBetween(W.unboundedPreceding, 0)))
        .where(F.col("at") < (test_rows // window) * window)
        .withColumn("window_id", window_id)
        .join(n, keys)
        .where(F.col("n") - test_rows + (F.col("window_id") - 1) * window >= min_train)
        .where(F.col("y_base").isNotNull())
        .select(
            *keys, F.lit(model).alias("model"), "window_id", "date",
            F.col("value").alias("y_true"), F.col("y_base").alias("y_pred"), "y_base",
        )
    )


def training_rows(
    panel: DataFrame, windows: DataFrame, keys: Sequence[str] = ("series",)
) -> DataFrame:
    """History of every window: the rows before its first day.

    ``windows`` holds a few rows per series, so the join multiplies each row by the number of
    windows only; keys spread the copies over tasks.
    """
    bounds = windows.select(*keys, "window_id", "window_start").distinct()
    return panel.join(bounds, list(keys)).where(F.col("date") < F.col("window_start"))


def grid(values: Mapping[str, Sequence[int]]) -> list[dict[str, int]]:
    """Every combination of the listed values, in list order."""
    combos: list[dict[str, int]] = [{}]
    for name, options in values.items():
        combos = [{**c, name: v} for c in combos for v in dict.fromkeys(options)]
    return combos


def grid_points(targets: DataFrame, values: Mapping[str, Sequence[int]], key: str = "target") -> DataFrame:
    """The grid for every row of ``targets`` by exploding the value lists."""
    out = targets
    for name, options in values.items():
        listed = F.array(*[F.lit(int(v)).cast("long") for v in dict.fromkeys(options)])
        out = out.withColumn(name, F.explode(listed))
    return out
