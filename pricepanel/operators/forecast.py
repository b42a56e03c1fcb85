"""Forecast jobs: one regression per (target, window, grid point) from running sums.

The bundled estimator is least squares on differenced, power-transformed values with
autoregressive, seasonal, covariate and moving-average terms (``running_fit``).  It is not a
state-space likelihood fit: its numbers differ from one.  Forecasts of outside models come in as
tables.

History is shuffled once, by target, and read once, in date order: each fit keeps the sums of
products of its terms, and a backtest solves for a window when the reading comes to its start.
With one power parameter for all windows their fits share the sums; with one per window each has
sums of its own.  No row is copied to windows or grid points, and memory is bounded by the terms
and one Arrow batch.  Windows, inverse transform and scoring are Spark expressions.

``status`` says how a forecast came about: ``covariates``, ``no_covariates``, ``naive`` (only
where a fallback is asked for), ``failed`` (no fit, NULL forecast), ``no_rows`` (the target has
no value, NULL forecast) or, in backtests, ``few_rows`` (window skipped, NULL forecast).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pricepanel.functions.dates import next_business_days
from pricepanel.functions.transforms import inverse
from pricepanel.operators.features import fit_lambda, power_transform
from pricepanel.operators.running_fit import Covariates, Order, RunningFit
from pricepanel.operators.scoring import fold_summary, ljung_box, rank_grid

# ---------------------------------------------------------------- reading series


@dataclass(frozen=True)
class Job:
    """What to fit; travels to the tasks."""

    horizon: int
    orders: Mapping[object, Sequence[Order]]
    default: Sequence[Order]
    transform: str
    method: str
    median_of: str
    fallback: bool
    min_rows: int
    min_train: int


class Series:
    """One target: the windows still to come, and the running fits."""

    def __init__(self, job: Job, target: object, windows: list[tuple[int, int, float, float]], width: int):
        self.job, self.target, self.width = job, target, width
        self.windows = sorted(windows)
        orders = job.orders.get(target, job.default)
        # windows of one power parameter share their sums
        self.fits = {power: [RunningFit(o, width) for o in orders] for power in {w[2:] for w in self.windows}}
        self.context = max((f.terms.context for fits in self.fits.values() for f in fits), default=0) + 1
        self.covariates = Covariates(width, job.method, job.median_of)
        self.y, self.columns, self.rows = np.empty(0), np.empty((0, 2 * width)), 0
        self.out: list[tuple] = []

    def add(self, days: np.ndarray, y: np.ndarray, x: np.ndarray) -> None:
        """Rows in date order; windows that begin on the way are fitted on the rows before them."""
        a = 0
        while a < len(days):
            while self.windows and self.windows[0][0] <= days[a]:
                self._fit(self.windows.pop(0))
            if not self.windows:
                return
            b = int(np.searchsorted(days, self.windows[0][0]))
            self._piece(y[a:b], x[a:b])
            a = b

    def end(self) -> list[tuple]:
        while self.windows:
            self._fit(self.windows.pop(0))
        return self.out

    def _piece(self, y: np.ndarray, x: np.ndarray) -> None:
        old = len(self.y)
        self.y = np.concatenate([self.y, y])
        self.columns = np.vstack([self.columns, self.covariates.columns(x)])
        for (lam, shift), fits in self.fits.items():
            t = power_transform(self.y, self.job.transform, lam, shift)
            for f in fits:
                back = min(old, f.terms.context)
                f.add(t[old - back:], self.columns[old - back:], back)
        self.rows += len(y)
        self.y, self.columns = self.y[-self.context:], self.columns[-self.context:]

    def _fit(self, window: tuple[int, int, float, float]) -> None:
        _, window_id, lam, shift = window
        job, n = self.job, self.rows
        if n and n >= job.min_train:
            centre = self.covariates.centre()
            ahead = self.covariates.next(centre, job.horizon)
            t = power_transform(self.y, job.transform, lam, shift)
            for point, f in enumerate(self.fits[lam, shift]):
                fit, status = self._attempts(f, t, centre, ahead)
                self.out += [(self.target, window_id, point + 1, h + 1, None if np.isnan(v) else float(v), lam, shift, float(self.y[-1]), n,
                              fit["aic"], fit["bic"], status) for h, v in enumerate(fit["path"])]
        if not any(w[2:] == (lam, shift) for w in self.windows):
            del self.fits[lam, shift]

    def _attempts(self, f: RunningFit, t: np.ndarray, centre: np.ndarray, ahead: np.ndarray) -> tuple[dict, str]:
        """The model with its covariates; with ``fallback`` then without them, then the last value
        repeated, which is also all a series of fewer than ``min_rows`` rows gets."""
        job = self.job
        tries = ["covariates"] if self.width else []
        if not self.width or job.fallback:
            tries.append("no_covariates")
        if job.fallback and self.rows < job.min_rows:
            tries = []
        back = min(len(t), f.terms.context + 1)
        for status in tries:
            try:
                return f.forecast(t[-back:], self.columns[-back:], centre, ahead, status == "covariates"), status
            except (ValueError, np.linalg.LinAlgError):
                continue
        path = np.repeat(t[-1] if job.fallback else np.nan, job.horizon)
        return {"path": path, "aic": None, "bic": None}, "naive" if job.fallback else "failed"


FIT_SCHEMA = (
    "window_id long, grid_point long, step long, t_hat double, lam double, shift double, y_base double, train_rows long, "
    "aic double, bic double, status string"
)


def _reader(job: Job, types: list[pa.DataType]) -> Callable:
    """Tasks get, target by target, its windows and then its rows in date order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["target", *[part.split()[0] for part in FIT_SCHEMA.split(", ")]]
        current: Series | None = None
        target, windows, done = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            columns = list(zip(*done)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)
            done.clear()

        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column("target")
            edges = np.flatnonzero(np.r_[True, keys[1:].to_numpy(zero_copy_only=False) != keys[:-1].to_numpy(zero_copy_only=False), True])
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                key, part = keys[lo].as_py(), b.slice(lo, hi - lo)
                if key != target:
                    done += current.end() if current else []
                    target, current, windows = key, None, []
                    if len(done) > 10_000:
                        yield from flush()
                days, of_row = part.column("day").to_numpy(), part.column("is_row").to_numpy()
                first = int(np.searchsorted(of_row, 1))  # windows come before rows
                windows += [tuple(w) for w in zip(days[:first].tolist(), *(part.column(c)[:first].to_pylist() for c in ("window_id", "lam", "shift")))]
                if first == len(days):
                    continue
                x = part.column("x")[first:]
                flat = x.flatten().to_numpy(zero_copy_only=False).astype(float)
                x = flat.reshape(len(days) - first, -1) if len(flat) else np.zeros((len(days) - first, 0))
                if current is None:
                    current = Series(job, target, windows, x.shape[1])
                current.add(days[first:], part.column("y")[first:].to_numpy(), x)
        done += current.end() if current else []
        yield from flush()

    return run


def _fits(rows: DataFrame, windows: DataFrame, job: Job) -> DataFrame:
    """``target`` and ``FIT_SCHEMA`` for ``windows``: ``target, window_id, window_start, lam,
    shift``, one row each."""
    kind = dict(rows.dtypes)["target"]
    day = lambda c: F.datediff(F.col(c), F.lit(dt.date(1970, 1, 1)))
    line = rows.where(F.col("target").isNotNull()).select(
        "target", F.lit(1).alias("is_row"), day("date").alias("day"), F.col("y").cast("double").alias("y"), F.col("x").cast("array<double>").alias("x"),
        F.lit(None).cast("long").alias("window_id"), F.lit(None).cast("double").alias("lam"), F.lit(None).cast("double").alias("shift"))
    none = F.lit(None)
    ahead = windows.where(F.col("target").isNotNull() & F.col("window_start").isNotNull()).select(
        F.col("target").cast(kind).alias("target"), F.lit(0).alias("is_row"), day("window_start").alias("day"), none.cast("double").alias("y"),
        none.cast("array<double>").alias("x"), F.col("window_id").cast("long").alias("window_id"),
        F.coalesce("lam", F.lit(0.0)).alias("lam"), F.coalesce("shift", F.lit(0.0)).alias("shift"))
    # adaptive execution would merge partitions by size, but fits are dear for their bytes
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = line.unionByName(ahead).repartition(n, "target").sortWithinPartitions("target", "is_row", "day")
    schema = f"target {kind}, {FIT_SCHEMA}"
    return line.mapInArrow(_reader(job, _arrow_types(line.sparkSession, schema)), schema)


def _arrow_types(spark, schema: str) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return list(to_arrow_schema(spark.createDataFrame([], schema).schema).types)


# ---------------------------------------------------------------- jobs


def target_rows(wide: DataFrame, features: Mapping[str, Sequence[str]], keep: Sequence[str] = ()) -> DataFrame:
    """``target, date, y, x`` with the covariates of each target as an array, in one scan.

    Rows without a target value are dropped; features the table lacks are skipped (see
    ``features.resolve_features`` to list them).
    """
    structs = [
        F.struct(
            F.lit(t).alias("target"),
            F.col(f"`{t}`").cast("double").alias("y"),
            F.array(*[F.col(f"`{c}`").cast("double") for c in cols if c in wide.columns])
            .cast("array<double>").alias("x"),
        )
        for t, cols in features.items()
    ]
    rows = wide.select("date", *keep, F.explode(F.array(*structs)).alias("r"))
    return rows.select("r.target", "date", *keep, "r.y", "r.x").where(F.col("y").isNotNull())


def _back(transform: str, clipped: bool) -> Column:
    return inverse(F.col("t_hat"), transform, F.col("lam"), F.col("shift"), clipped)


def forecast(
    rows: DataFrame, horizon: int, orders: Mapping[str, Order], model: str, transform: str = "yeojohnson",
    method: str = "last", median_of: str = "raw", default: Order = ((1, 1, 0), (0, 0, 0, 0)),
    fallback: bool = False, min_rows: int | None = None, targets: Sequence[str] | None = None,
) -> DataFrame:
    """``forecast_date, model, target, predicted, status`` for the next business days after the
    newest date with any target value.  ``rows`` as from ``target_rows``.

    ``fallback``: a target that cannot be fitted, or has fewer than ``min_rows`` values (default
    three horizons, at least 20), repeats its last value; otherwise its forecasts are NULL with
    status ``failed``.  ``targets`` lists those that must appear: one without any value gets
    NULL forecasts with status ``no_rows``.
    """
    least = max(20, 3 * horizon) if min_rows is None else min_rows
    job = Job(horizon, {k: [o] for k, o in orders.items()}, [default], transform, method, median_of, fallback, least, 1)
    kind = dict(rows.dtypes)["target"]
    # one window, after the last row
    after = fit_lambda(rows, transform, ["target"], "y").select(
        "target", F.lit(1).alias("window_id"), F.lit(dt.date(9999, 12, 31)).alias("window_start"), "lam", "shift")
    fits = _fits(rows, after, job)
    days = rows.agg(F.max("date").alias("last")).select(
        F.posexplode(next_business_days(F.col("last"), horizon)).alias("i", "forecast_date")
    ).select((F.col("i") + 1).cast("long").alias("step"), "forecast_date")
    if targets is None:
        dated = fits.join(F.broadcast(days), "step")  # horizon rows
    else:
        asked = days.withColumn("target", F.explode(F.array(*[F.lit(t).cast(kind) for t in targets])))
        dated = asked.join(fits, ["target", "step"], "left")
    return dated.select(
        "forecast_date", F.lit(model).alias("model"), "target", _back(transform, False).alias("predicted"),
        F.coalesce("status", F.lit("no_rows")).alias("status"),
    )


def backtest(
    rows: DataFrame, windows: DataFrame, horizon: int, orders: Mapping[str, Sequence[Order]], model: str,
    transform: str = "yeojohnson", method: str = "last", median_of: str = "raw", min_train: int = 21,
    default: Sequence[Order] = (((1, 1, 0), (0, 0, 0, 0)),), lambda_from: str = "window",
    fallback: bool = False, min_rows: int | None = None,
) -> DataFrame:
    """Backtest records of every target, window and grid point.

    ``rows`` as from ``target_rows``; ``windows``: ``target, window_id, window_start, date,
    y_true``, one row per day to predict.  The power parameter comes from the training rows of
    each window, or, with ``lambda_from="global"``, from all rows of the target.  Training rows
    are the rows before the window; the base is the last of them.  A window with fewer than
    ``min_train`` training rows keeps its records, with NULL forecasts and status ``few_rows``.

    Rows are shuffled once, by target, and read once for all its windows and grid points.
    """
    if lambda_from not in ("window", "global"):
        raise ValueError("lambda_from must be 'window' or 'global'")
    least = max(20, 3 * horizon) if min_rows is None else min_rows
    keys = ["target", "window_id", "grid_point"]
    kind = dict(rows.dtypes)["target"]
    counts = F.create_map(*[F.lit(v) for t, o in orders.items() for v in (t, len(o))]) if orders else F.create_map()
    points = F.coalesce(F.try_element_at(counts, F.col("target").cast("string")), F.lit(len(default))) if orders else F.lit(len(default))
    # new column ids: rows and windows usually come from the same table
    names = ["target", "window_id", "window_start"]
    bounds = windows.select(*[F.col(c).alias(c) for c in names]).distinct().withColumn(
        "grid_point", F.explode(F.sequence(F.lit(1).cast("long"), points.cast("long"))))
    starts = bounds.select("target", "window_id", "window_start").distinct()
    if lambda_from == "global":
        found = fit_lambda(rows, transform, ["target"], "y")
        starts = starts.join(found, "target", "left")
    elif transform in ("none", "log"):
        starts = starts.withColumns({"lam": F.lit(0.0), "shift": F.lit(0.0)})
    else:
        past = rows.select("target", "date", "y").join(starts, "target").where(F.col("date") < F.col("window_start"))
        found = fit_lambda(past, transform, ["target", "window_id"], "y")
        starts = starts.join(found, ["target", "window_id"], "left")
    fits = _fits(rows, starts, Job(horizon, dict(orders), default, transform, method, median_of, fallback, least, min_train))
    by_date = W.partitionBy(*keys).orderBy("date")
    steps = windows.select("target", "window_id", "date", "y_true").join(
        bounds.select(*keys), ["target", "window_id"]
    ).withColumn("step", F.row_number().over(by_date).cast("long"))
    return steps.join(fits, [*keys, "step"], "left").select(
        "target", F.lit(model).alias("model"), "grid_point", "window_id", "date", "y_true",
        _back(transform, True).alias("y_pred"), "y_base", "aic", "bic",
        F.coalesce("status", F.lit("few_rows")).alias("status"),
    )


FITTED = ("covariates", "no_covariates")


def grid_results(records: DataFrame, lags: int = 10) -> DataFrame:
    """Fold summary, information criteria and whiteness of every grid point.

    Only windows whose model was fitted count; ``windows`` and ``fitted`` say how many there
    were and how many were fitted.  A point without a fitted window keeps its row, with NULLs.
    """
    by = ["target", "model", "grid_point"]
    ok = F.col("status").isin(*FITTED)
    windows = records.groupBy(*by, "window_id").agg(
        F.max(ok).alias("ok"), F.max(F.when(ok, F.col("aic"))).alias("aic"), F.max(F.when(ok, F.col("bic"))).alias("bic"))
    means = windows.groupBy(*by).agg(
        F.count("*").alias("windows"), F.count_if("ok").alias("fitted"), F.avg("aic").alias("aic_mean"), F.avg("bic").alias("bic_mean"))
    fitted = records.where(ok)
    white = ljung_box(fitted.withColumn("residual", F.col("y_true") - F.col("y_pred")), lags, by=by)
    return means.join(fold_summary(fitted, by), by, "left").join(white.select(*by, "lb_pvalue", "lb_ok"), by, "left")


def rank_fitted(results: DataFrame) -> DataFrame:
    """``rank_grid`` over the points fitted in every window; the others follow without a rank."""
    whole = F.col("fitted") == F.col("windows")
    rest = results.where(~whole).withColumn("rank", F.lit(None).cast("long"))
    return rank_grid(results.where(whole)).unionByName(rest)
