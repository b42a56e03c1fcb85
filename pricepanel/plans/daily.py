"""The daily run: load the panel, forecast, blend, archive, log, check and score.

Plain functions in sequence; whatever schedules jobs calls ``run_daily`` once a day.  Every
step can be repeated for the same day and leaves the same tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricepanel import fixed_values as fv, schema as S
from pricepanel.operators import blend, fill, forecast as fc, panel as P, quality, report, runlog, scoring
from pricepanel.plans.ledger import Ledger
from pricepanel.session import saved
from pricepanel.sinks import tables as K
from pricepanel.sources.files import model_panel, read_panel


@dataclass(frozen=True)
class Tables:
    """Folders of the tables."""

    raw: str
    panel: str
    forecasts: str
    history: str
    errors: str
    quality: str
    run_log: str
    ledger: str | None = None


@dataclass(frozen=True)
class Settings:
    columns: Sequence[str] = tuple(fv.PANEL_COLUMNS)
    watched: Sequence[str] = tuple(fv.WATCHED_COLUMNS)
    targets: Sequence[str] = tuple(fv.TARGETS)
    anchor: str = "petroleo_brent"
    raw_date: str = fv.PANEL_DATE
    alternates: Mapping[str, str] = field(default_factory=lambda: dict(fv.ALTERNATE_NAMES))
    model_a: str = fv.BASE_MODELS[0]
    model_b: str = fv.BASE_MODELS[1]
    mixed: str = fv.MIXED_MODEL
    ensemble: str = fv.ENSEMBLE_MODEL
    logged: Sequence[str] = tuple(fv.LOGGED_MODELS)
    stage_names: Mapping[str, str] = field(default_factory=lambda: dict(fv.STAGE_NAMES))
    orders: Mapping[str, tuple] = field(
        default_factory=lambda: {t: (o, s) for t, (o, s, _) in fv.MODEL_ORDERS.items()}
    )
    transform: str = "yeojohnson"
    horizon: int = fv.HORIZON
    table_name: str = "panel"

    @property
    def models(self) -> list[str]:
        return [self.model_a, self.model_b, self.mixed, self.ensemble]


def raw_rows(spark: SparkSession, t: Tables, s: Settings) -> DataFrame:
    raw = read_panel(spark, t.raw)
    fitted = P.reconcile(raw, S.panel_schema(s.columns, s.raw_date), s.alternates)
    return P.clean_numeric(fitted.withColumnRenamed(s.raw_date, "date"), s.columns)  # NaN is no value


def load_panel(spark: SparkSession, t: Tables, s: Settings) -> tuple[dt.date | None, dt.date | None]:
    """Reload the raw date range into the panel; returns the range, or None if there is none."""
    raw = raw_rows(spark, t, s)
    lo, hi = fill.reload_range(raw, s.anchor).first()  # two dates
    if lo is None:
        return None, None
    batch = P.business_days_only(raw.where(F.col("date").between(F.lit(lo), F.lit(hi))))
    schema = S.stored_panel_schema(s.columns)
    # the fill goes on from the newest row before the range: in its first month, or else in the
    # newest one before that, which partition values alone tell
    table, month = K.read_table(spark, t.panel, schema), F.trunc(F.lit(lo), "MM")
    newest = K.partition_values(spark, t.panel, schema, ["month"]).where(F.col("month") < month).agg(F.max("month")).first()[0]
    months = F.col("month") == month
    if newest is not None:
        months = months | (F.col("month") == F.lit(newest))
    filled = fill.seeded_fill(table.where(months & (F.col("date") < F.lit(lo))), batch, s.columns)
    K.replace_range(spark, t.panel, schema, lo, hi, filled)
    return lo, hi


def stored_panel(spark: SparkSession, t: Tables, s: Settings) -> DataFrame:
    return K.read_table(spark, t.panel, S.stored_panel_schema(s.columns)).drop("month")


def newest_month(spark: SparkSession, t: Tables, s: Settings) -> DataFrame:
    """The panel's newest month with rows, which holds its newest row."""
    schema = S.stored_panel_schema(s.columns)
    newest = K.partition_values(spark, t.panel, schema, ["month"]).agg(F.max("month")).first()[0]
    return K.read_table(spark, t.panel, schema).where(F.col("month") == F.lit(newest)).drop("month")


def forecast_model(spark: SparkSession, t: Tables, s: Settings, features: Mapping[str, Sequence[str]]) -> None:
    """Fit the bundled estimator for all targets and replace its rows.

    Raises ``ValueError``, with the stored rows untouched, where a target has no values or its
    model cannot be fitted.
    """
    lists = {x.lower(): [f.lower() for f in features.get(x, [])] for x in s.targets}
    needed = [*lists, *{f for fs in lists.values() for f in fs}]
    wide = model_panel(stored_panel(spark, t, s), needed)
    rows = fc.target_rows(wide, lists)
    orders = {k.lower(): v for k, v in s.orders.items()}
    long = saved(fc.forecast(rows, s.horizon, orders, s.model_a, s.transform, targets=list(lists)))
    lost = long.where(F.col("predicted").isNull()).select("target", "status").distinct().collect()  # targets
    if lost or not long.take(1):
        raise ValueError("no forecast for " + (", ".join(sorted(f"{r.target} ({r.status})" for r in lost)) or "any target"))
    names = {x.lower(): x for x in s.targets}
    preds = P.to_wide(long, list(names), ["forecast_date", "model"], series="target", value="predicted")
    K.replace_model(spark, t.forecasts, S.forecast_schema(s.targets), s.model_a, preds.withColumnsRenamed(names))


def take_forecasts(spark: SparkSession, t: Tables, s: Settings, model: str, preds: DataFrame) -> None:
    """Forecasts of a model that runs elsewhere, as a wide table."""
    fitted = preds.withColumn("model", F.lit(model))
    K.replace_model(spark, t.forecasts, S.forecast_schema(s.targets), model, fitted)


def blend_and_archive(spark: SparkSession, t: Tables, s: Settings, as_of: dt.date) -> None:
    schema = S.forecast_schema(s.targets)
    derived = [s.mixed, s.ensemble]
    K.delete_models(spark, t.forecasts, schema, derived)
    current = K.read_table(spark, t.forecasts, schema)
    new = blend.derived_forecasts(
        current, newest_month(spark, t, s), s.targets, s.model_a, s.model_b, s.mixed, s.ensemble
    )
    K.replace_rows(spark, t.forecasts, schema, ["model"], F.col("model").isin(derived), new)
    current = K.read_table(spark, t.forecasts, schema)
    K.replace_day(spark, t.history, S.history_schema(s.targets), as_of, blend.snapshot(current, as_of), span="forecast_date")


def write_log(spark: SparkSession, t: Tables, s: Settings, as_of: dt.date, run_ts: dt.datetime) -> None:
    rows = runlog.run_log(
        raw_rows(spark, t, s), stored_panel(spark, t, s),
        K.read_table(spark, t.forecasts, S.forecast_schema(s.targets)),
        K.read_table(spark, t.history, S.history_schema(s.targets)),
        s.logged, as_of, run_ts, s.horizon, s.stage_names,
    )
    K.replace_day(spark, t.run_log, S.RUN_LOG, as_of, rows, sort=["stage", "status"])


def write_quality(spark: SparkSession, t: Tables, s: Settings, as_of: dt.date, run_ts: dt.datetime) -> None:
    watched = P.clean_numeric(stored_panel(spark, t, s).select("date", *s.watched), s.watched)
    rows = quality.all_checks(watched, s.watched, quality.Review(as_of, run_ts, s.table_name))
    K.replace_review(spark, t.quality, S.QUALITY, as_of, s.table_name, rows)


def write_errors(
    spark: SparkSession, t: Tables, s: Settings, as_of: dt.date | None = None, changed_from: dt.date | None = None
) -> None:
    """Score the forecast history into the error table.

    Without dates the whole table is rebuilt.  With ``as_of`` only what a day can change is
    scored again: that day's run, and every run with a forecast for the panel's changed dates
    (``changed_from`` on).  Older rows stay, and still count as earlier publications.
    """
    stored = K.find_table(spark, t.errors, S.ERRORS)
    if as_of is None or stored is None:
        history = K.read_table(spark, t.history, S.history_schema(s.targets))
        actuals = P.to_long(stored_panel(spark, t, s).select("date", *s.targets), s.targets, keep_nulls=False)
        new = scoring.forecast_errors(scoring.predictions(history, s.targets, s.models), actuals)
        runs = [r[0] for r in K.partition_values(spark, t.history, S.history_schema(s.targets), ["run_date"]).collect()]
        if stored is not None:  # runs no longer in the history stay, and count as earlier
            new = scoring.new_publications(new, stored.where(~F.col("run_date").isin(runs)))
    else:
        runs = due_runs(spark, t, as_of, changed_from)
        preds, actuals, stored = due_rows(spark, t, s, runs)
        new = scoring.new_publications(scoring.forecast_errors(preds, actuals), stored)
    K.replace_runs(spark, t.errors, S.ERRORS, runs, new, sort=["model", "target", "forecast_date"], span="forecast_date")


def due_runs(spark: SparkSession, t: Tables, as_of: dt.date, changed_from: dt.date | None) -> list[dt.date]:
    """Run dates whose scores a day can change, from the manifest of the history alone."""
    meeting = K.partitions_meeting(spark, t.history, min(as_of, changed_from) if changed_from else as_of)
    stored = {dt.date.fromisoformat(p[0]) for p in meeting} if changed_from else set()
    return sorted(stored | {as_of})


def due_rows(spark: SparkSession, t: Tables, s: Settings, runs: Sequence[dt.date]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Predictions of the runs, the actuals they meet, and errors of other runs for their dates.

    All three are read by partition: the runs themselves, the months of their forecast dates with
    the newest month before (whose last row, filled forward, holds every target's value before),
    and the runs whose spans meet those dates.
    """
    history = K.read_table(spark, t.history, S.history_schema(s.targets)).where(F.col("run_date").isin(list(runs)))
    preds = scoring.predictions(history, s.targets, s.models)
    panel = K.read_table(spark, t.panel, S.stored_panel_schema(s.columns))
    stored = K.read_table(spark, t.errors, S.ERRORS)
    wanted = {d.isoformat() for d in runs}
    spans = [span for p, span in K.partitions_meeting(spark, t.history, dt.date.min).items() if p[0] in wanted]
    if spans and None not in spans:
        lo, hi = (dt.date.fromisoformat(f(x)) for f, x in ((min, [a for a, _ in spans]), (max, [b for _, b in spans])))
        months = sorted(r[0] for r in K.partition_values(spark, t.panel, S.stored_panel_schema(s.columns), ["month"]).collect())
        first, last = lo.replace(day=1), hi.replace(day=1)
        before = [m for m in months if m < first][-1:]
        panel = panel.where(F.col("month").isin([*before, *(m for m in months if first <= m <= last)]))
        others = [p[0] for p in K.partitions_meeting(spark, t.errors, lo, hi) if p[0] not in wanted]
        stored = stored.where(F.col("run_date").isin([dt.date.fromisoformat(p) for p in others]) if others else F.lit(False))
    else:
        stored = stored.where(~F.col("run_date").isin(list(runs)))
    actuals = P.to_long(panel.select("date", *s.targets), s.targets, keep_nulls=False)
    return preds, actuals, stored


def create_views(spark: SparkSession, t: Tables, s: Settings) -> None:
    """Temporary views ``report_actuals_and_forecasts`` and ``report_summary``."""
    panel = K.read_table(spark, t.panel, S.stored_panel_schema(s.columns))
    history = K.read_table(spark, t.history, S.history_schema(s.targets))
    order = {m: fv.REPORT_ORDER.get(m, fv.UNKNOWN_REPORT_ORDER) for m in s.models}
    report.actuals_and_forecasts(panel, history, s.targets, order).createOrReplaceTempView(
        "report_actuals_and_forecasts"
    )
    report.summary(panel, history, s.targets, s.models).createOrReplaceTempView("report_summary")


def create_published_views(spark: SparkSession, t: Tables, s: Settings) -> None:
    """Temporary views ``published_*`` of all tables and both reports, under the published column
    names.  Needs ``create_views``."""
    forecasts, history = S.forecast_schema(s.targets), S.history_schema(s.targets)
    published = {
        "forecasts": (K.read_table(spark, t.forecasts, forecasts), fv.PUBLISHED_FORECAST_NAMES),
        "history": (K.read_table(spark, t.history, history), fv.PUBLISHED_FORECAST_NAMES),
        "errors": (K.read_table(spark, t.errors, S.ERRORS), fv.PUBLISHED_ERROR_NAMES),
        "quality": (K.read_table(spark, t.quality, S.QUALITY), fv.PUBLISHED_QUALITY_NAMES),
        "run_log": (K.read_table(spark, t.run_log, S.RUN_LOG), fv.PUBLISHED_LOG_NAMES),
        "actuals_and_forecasts": (spark.table("report_actuals_and_forecasts"), fv.PUBLISHED_REPORT_NAMES),
        "summary": (spark.table("report_summary"), fv.PUBLISHED_REPORT_NAMES),
    }
    for name, (table, names) in published.items():
        P.rename(table, names).createOrReplaceTempView(f"published_{name}")


def run_daily(
    spark: SparkSession, t: Tables, as_of: dt.date, run_ts: dt.datetime, features: Mapping[str, Sequence[str]],
    outside: Mapping[str, DataFrame] | None = None, settings: Settings | None = None,
) -> None:
    """One day, in order.  ``outside`` holds wide forecasts of models run elsewhere, by label; if the
    first model is among them, the bundled estimator does not run.

    With ``Tables.ledger`` a run that stopped goes on where it stopped when called again with the
    same day and time.
    """
    s, outside = settings or Settings(), outside or {}
    ledger = Ledger(spark, t.ledger, as_of, run_ts, {n: getattr(t, n) for n in ("panel", "forecasts", "history", "errors", "quality", "run_log")})
    changed_from, _ = ledger.step("load", [], ["panel"], lambda: load_panel(spark, t, s))
    if s.model_a not in outside:
        ledger.step("forecast", ["panel"], ["forecasts"], lambda: forecast_model(spark, t, s, features))
    for model, preds in sorted(outside.items()):
        ledger.step(f"take {model}", [], ["forecasts"], lambda: take_forecasts(spark, t, s, model, preds))  # noqa: B023
    ledger.step("blend", ["panel", "forecasts"], ["forecasts", "history"], lambda: blend_and_archive(spark, t, s, as_of))
    ledger.step("log", ["panel", "forecasts", "history"], ["run_log"], lambda: write_log(spark, t, s, as_of, run_ts))
    ledger.step("quality", ["panel"], ["quality"], lambda: write_quality(spark, t, s, as_of, run_ts))
    ledger.step("errors", ["panel", "history", "errors"], ["errors"], lambda: write_errors(spark, t, s, as_of, changed_from))
    create_views(spark, t, s)
    create_published_views(spark, t, s)
