"""Choosing features and model orders, and the final comparison, from one wide panel.

The newest ``test_rows`` dates of the panel are held out: features, power parameters and grid
points are chosen on earlier dates only, the held-out ones are for the comparison.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricepanel.operators import backtest as bt, features as X, forecast as fc, panel as P, scoring
from pricepanel.session import saved
from pricepanel.sinks.files import write_features
from pricepanel.sources.files import feature_lists, read_features

CALENDAR = ("days_to_monday", "days_since_monday", "month", "half_month", "month_close")


@dataclass(frozen=True)
class Settings:
    threshold: float = 10.0  # of the variance inflation factor
    horizon: int = 7
    n_folds: int = 5
    test_rows: int = 63
    transform: str = "yeojohnson"
    model: str = "regression"
    naive: str = "naive_last"


def prepared(panel: DataFrame) -> DataFrame:
    """Business days with lower-case names and the calendar's features."""
    wide = P.business_days_only(P.lower_names(panel).where(F.col("date").isNotNull()))
    return X.calendar_features(wide)


def choose_features(wide: DataFrame, targets: Sequence[str], candidates: Sequence[str], s: Settings) -> DataFrame:
    """``target, variable, kept, drop_step, vif`` by variance inflation, with the calendar's
    features among the candidates."""
    return X.vif_prune(wide, {t: [*candidates, *CALENDAR] for t in targets}, s.threshold)


def search_grid(rows: DataFrame, orders: Mapping[str, Sequence[fc.Order]], s: Settings) -> DataFrame:
    """Rank of every grid point of every target over rolling folds of ``rows``."""
    folds = bt.rolling_folds(rows.drop("x"), s.horizon, s.n_folds, keys=["target"])
    starts = folds.groupBy("target", "window_id").agg(F.min("date").alias("window_start"))
    windows = folds.withColumnRenamed("y", "y_true").join(starts, ["target", "window_id"])
    return fc.rank_fitted(fc.grid_results(fc.backtest(rows, windows, s.horizon, orders, s.model, s.transform, lambda_from="global")))


def final_records(wide: DataFrame, rows: DataFrame, best: Mapping[str, fc.Order], s: Settings) -> DataFrame:
    """Records of the chosen order and of the last value repeated, over the held-out windows."""
    windows = bt.calendar_windows(wide, s.test_rows, s.horizon)
    held = rows.drop("x").join(F.broadcast(windows), "date").withColumnRenamed("y", "y_true")  # test_rows rows
    fitted = saved(fc.backtest(rows, held, s.horizon, {t: [o] for t, o in best.items()}, s.model, s.transform), "research")
    return fitted.unionByName(fitted.withColumns({"model": F.lit(s.naive), "y_pred": F.col("y_base")}))


def run_research(
    spark: SparkSession, panel: DataFrame, targets: Sequence[str], candidates: Sequence[str],
    orders: Mapping[str, Sequence[fc.Order]], features_path: str, settings: Settings | None = None,
) -> DataFrame:
    """Writes the chosen features as CSV to ``features_path`` and returns one row per target:
    ``target, grid_point, features`` and the accuracy of the naive forecast and of the model.

    ``orders`` lists the grid points of each target.  A target without a grid point fitted in
    every fold, or too short for the folds, is compared with its first one and has a NULL
    ``grid_point``.
    """
    s = settings or Settings()
    targets, candidates = [t.lower() for t in targets], [c.lower() for c in candidates]
    orders = {t.lower(): list(o) for t, o in orders.items()}
    if lost := [t for t in targets if not orders.get(t)]:
        raise ValueError(f"no grid for {', '.join(lost)}")
    wide = saved(prepared(panel).select("date", *dict.fromkeys([*targets, *candidates, *CALENDAR])), "research")
    held_from = bt.calendar_windows(wide, s.test_rows, s.horizon).agg(F.min("window_start")).first()[0]
    if held_from is None:
        raise ValueError(f"the panel has fewer than {s.test_rows} dates")
    before = F.col("date") < F.lit(held_from)

    write_features(choose_features(wide.where(before), targets, candidates, s).where("kept"), features_path)
    chosen = feature_lists(read_features(spark, features_path))
    lists = {t: [] for t in targets} | {r.target: r.variables for r in chosen.collect()}  # names, one row per target

    rows = fc.target_rows(wide, lists)
    ranked = search_grid(rows.where(before), {t: orders[t] for t in targets}, s)
    points = {r.target: r.grid_point for r in ranked.where("rank = 1").select("target", "grid_point").collect()}  # one per target
    best = {t: orders[t][points.get(t, 1) - 1] for t in targets}

    accuracy = scoring.accuracy(final_records(wide, rows, best, s))
    of = lambda model: accuracy.where(F.col("model") == model).drop("model")
    picked = spark.createDataFrame([(t, points.get(t), lists[t]) for t in targets], "target string, grid_point long, features array<string>")
    return picked.join(scoring.compare({s.naive: of(s.naive)}, {s.model: of(s.model)}), "target", "left")
