"""Quality, blend, errors, run log, reports, features, backtests, table writers, the daily run."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import functions as F, types as T

from pricepanel import fixed_values as fv, schema as S
from pricepanel.operators import (
    backtest as bt, blend, features as X, fill, forecast as fc, panel as P, quality as Q, report, runlog,
    scoring as M,
)
from pricepanel.plans import daily, landing, research
from pricepanel.schema import columns_of
from pricepanel.sinks import files as out, tables as K
from pricepanel.sources import files
from workload.inputs import (
    AS_OF, DRIVERS, MODELS, TARGETS, backtest_records, current_long, current_wide, drivers_wide,
    forecast_history, gappy_panel, market_long, market_wide, supplier_forecasts, supplier_panel, supplier_series,
    table, union_long, with_inputs,
)
from workload.registry import q6, query, r6, rounded, scratch

REVIEW = Q.Review(AS_OF, dt.datetime(2001, 8, 6, 12), "panel")
SHOWN = ["review_date", "table_name", "metric_group", "metric", "series", "data_date", "value", "threshold", "status"]


def fact(group: str, metric: str, threshold: float, series: str, data_date: str, value: str, status: str) -> str:
    return (f"SELECT DATE '2001-08-06' AS review_date, 'panel' AS table_name, '{group}' AS metric_group, "
            f"'{metric}' AS metric, CAST({series} AS VARCHAR) AS series, CAST({data_date} AS DATE) AS data_date, "
            f"{q6(f'CAST({value} AS DOUBLE)')} AS value, CAST({threshold} AS DOUBLE) AS threshold, {status} AS status")


def shown(df, detail: bool = False):
    return rounded(df.select(*SHOWN, *(["detail"] if detail else [])), "value")


# ---------------------------------------------------------------- quality

LAST = "(SELECT max(date) FROM {p})"
FRESH = (fact("freshness", "days_lag_vs_expected", 0, "NULL", "last", "greatest(DATE '2001-08-03' - last, 0)",
              "CASE WHEN last >= DATE '2001-08-03' THEN 'ok' ELSE 'error' END"),
         ", 'last_date=' || last || ' | expected_date=2001-08-03' AS detail",
         " FROM (SELECT max(date) AS last FROM market_wide)")
DUP = (fact("duplicates", "duplicate_dates", 0, "NULL", "NULL", "n - d", "CASE WHEN n = d THEN 'ok' ELSE 'error' END"),
       ", 'rows=' || n || ' | dates=' || d AS detail",
       " FROM (SELECT count(*) AS n, count(DISTINCT date) AS d FROM {p})")
MISSING = ("SELECT d.date FROM (SELECT CAST(t AS DATE) AS date FROM (SELECT min(date) AS lo, max(date) AS hi FROM {p}),"
           " unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS g(t)) d"
           " WHERE isodow(d.date) <= 5 AND d.date NOT IN (SELECT date FROM {p})")
GAPS = (fact("gaps", "missing_business_days", 0, "NULL", "NULL", "count(*)",
             "CASE WHEN count(*) = 0 THEN 'ok' ELSE 'error' END"),
        ", coalesce(array_to_string(list_sort(list(CAST(date AS VARCHAR)))[1:10], ', '), 'no gaps') AS detail",
        " FROM missing")
NULLS = (fact("nulls", "pct_nulls_20d", 10, "series", LAST, "100.0 * nulls / n",
              "CASE WHEN 100.0 * nulls / n >= 20 THEN 'error' WHEN 100.0 * nulls / n >= 10 THEN 'warn' ELSE 'ok' END"),
         ", 'nulls=' || nulls || ' | rows=' || n AS detail",
         " FROM (SELECT series, count(*) AS n, count(*) FILTER (value IS NULL) AS nulls FROM {p} WHERE date IN"
         " (SELECT DISTINCT date FROM {p} ORDER BY date DESC LIMIT 20) GROUP BY series)")
LATEST = (fact("nulls", "is_null_latest_date", 0, "series", "date", "CASE WHEN value IS NULL THEN 1 ELSE 0 END",
               "CASE WHEN value IS NULL THEN 'error' ELSE 'ok' END"), "",
          " FROM {p} WHERE date = (SELECT max(date) FROM {p})")
ZED = (fact("outliers", "zscore_latest_30", 3, "series", "date", "z",
            "CASE WHEN z IS NULL THEN 'na' WHEN z >= 3 THEN 'error' WHEN z >= 2 THEN 'warn' ELSE 'ok' END"), "",
       " FROM (SELECT *, abs(value - a) / nullif(s, 0) AS z FROM (SELECT *, avg(value) OVER w AS a,"
       " stddev_samp(value) OVER w AS s FROM {p} WHERE value IS NOT NULL"
       " WINDOW w AS (PARTITION BY series ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)))"
       " WHERE date = (SELECT max(date) FROM {p})")
FLAT = (fact("flatline", "distinct_values_last_5d", 1, "series", LAST, "d",
             "CASE WHEN n < 5 THEN 'na' WHEN d = 1 THEN 'warn' ELSE 'ok' END"),
        ", 'rows=' || n || ' | distinct=' || d AS detail",
        " FROM (SELECT series, count(*) AS n, count(DISTINCT value) AS d FROM (SELECT *, row_number() OVER"
        " (PARTITION BY series ORDER BY date DESC) AS rn FROM {p} WHERE value IS NOT NULL) WHERE rn <= 5 GROUP BY series)")


def check_sql(parts, p: str, detail: bool = True, inputs=None, more=None) -> str:
    body = parts[0] + (parts[1] if detail else "") + parts[2]
    return with_inputs([p] if inputs is None else inputs, body.format(p=p), more)


MORE_GAPS = {"missing": MISSING.format(p="market_wide")}


@query("q0_no_data", with_inputs(["market_wide"], fact("freshness", "no_data_available", 0, "NULL", "NULL", "NULL", "'error'")
       + ", 'the table under review has no row with a valid date' AS detail"
       " FROM (SELECT max(date) AS last FROM market_wide WHERE gold < 0) WHERE last IS NULL"))
def q0(spark, sf):
    return shown(Q.no_data(market_wide(spark, sf).where("gold < 0"), REVIEW), True)


@query("q1_freshness", check_sql(FRESH, "market_wide"))
def q1(spark, sf):
    return shown(Q.freshness(market_wide(spark, sf), REVIEW), True)


@query("q2_duplicates", check_sql(DUP, "orders_days", inputs=[],
       more={"orders_days": "SELECT CAST(o_orderdate AS DATE) AS date FROM orders"}))
def q2(spark, sf):
    return shown(Q.duplicate_dates(table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")), REVIEW), True)


def urgent_days(spark, sf):
    """Days with urgent orders: a series with gaps."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return table(spark, sf, "orders").where(urgent).select(F.to_date("o_orderdate").alias("date"))


@query("q3_gaps", check_sql(GAPS, "thin", inputs=[], more={
    "thin": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderpriority = '1-URGENT'", "missing": MISSING.format(p="thin")}))
def q3(spark, sf):
    return shown(Q.gaps(urgent_days(spark, sf), REVIEW), True)


@query("q3b_missing_days", with_inputs([], "SELECT date FROM missing", {
    "thin": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderpriority = '1-URGENT'", "missing": MISSING.format(p="thin")}))
def q3b(spark, sf):
    return Q.missing_days(urgent_days(spark, sf))


@query("q4b_newest_dates", "SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem ORDER BY date DESC LIMIT 20")
def q4b(spark, sf):
    return Q.newest_dates(table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date")), 20)


@query("q4_null_share", check_sql(NULLS, "gappy_panel"))
def q4(spark, sf):
    return shown(Q.null_share(gappy_panel(spark, sf), REVIEW), True)


@query("q5_latest_null", check_sql(LATEST, "gappy_panel"))
def q5(spark, sf):
    return shown(Q.latest_null(gappy_panel(spark, sf), REVIEW))


@query("q6_zscore", check_sql(ZED, "market_long"))
def q6_(spark, sf):
    return shown(Q.outliers(market_long(spark, sf), REVIEW))


@query("q6b_zscore_suppliers", check_sql(ZED, "supplier_panel"))
def q6b(spark, sf):
    return shown(Q.outliers(supplier_panel(spark, sf), REVIEW))


@query("q7_flatline", check_sql(FLAT, "gappy_panel"))
def q7(spark, sf):
    return shown(Q.flatline(gappy_panel(spark, sf), REVIEW), True)


ALL = " UNION ALL ".join(
    (x[0] + x[2]).format(p=p) for x, p in
    [(FRESH, ""), (DUP, "market_wide"), (GAPS, ""), (NULLS, "market_long"), (LATEST, "market_long"),
     (ZED, "market_long"), (FLAT, "market_long")])


@query("q8_all_checks", with_inputs(["market_wide", "market_long"], ALL, MORE_GAPS))
def q8(spark, sf):
    return shown(Q.all_checks(market_wide(spark, sf), TARGETS, REVIEW))


# ---------------------------------------------------------------- blend

PAIRS = """SELECT forecast_date, target, max(CASE WHEN model = 'trend' THEN predicted END) AS a,
    max(CASE WHEN model = 'level' THEN predicted END) AS b, last_actual
    FROM {src} LEFT JOIN anchors USING (target) GROUP BY forecast_date, target, last_actual
    HAVING count(*) FILTER (model = 'trend') > 0 AND count(*) FILTER (model = 'level') > 0"""
ANCHORS = "SELECT series AS target, max_by(value, date) AS last_actual FROM supplier_panel GROUP BY series"
SIZE = "coalesce(abs((b.b - {b}) / nullif({b}, 0)), 0)"
MOVE = ("CASE WHEN b.a > {a} THEN {m} * (1 + {size}) WHEN b.a < {a} THEN CASE WHEN {m} IS NULL THEN NULL "
        "ELSE greatest({m} * (1 - {size}), 0) END ELSE {m} END")
MIX = {
    "ordered": "SELECT *, row_number() OVER (PARTITION BY target ORDER BY forecast_date) AS rn FROM pairs",
    "mix": "SELECT b.target, b.forecast_date, b.rn, b.a, b.b, "
           + MOVE.format(a="b.last_actual", m="b.last_actual", size=SIZE.format(b="b.last_actual"))
           + " AS mixed FROM ordered b WHERE rn = 1 UNION ALL SELECT b.target, b.forecast_date, b.rn, b.a, b.b, "
           + MOVE.format(a="m.a", m="m.mixed", size=SIZE.format(b="m.b"))
           + " FROM ordered b JOIN mix m ON b.target = m.target AND b.rn = m.rn + 1",
}
SUPPLIER_PAIRS = {"anchors": ANCHORS, "pairs": PAIRS.format(src="current_long")}
MARKET_PAIRS = {
    "anchors": union_long("(SELECT * FROM market_wide ORDER BY date DESC LIMIT 1)", TARGETS, "date", "target", "last_actual"),
    "preds": union_long("current_wide", TARGETS, "forecast_date, model", "target", "predicted"),
    "pairs": PAIRS.format(src="preds"),
}


def supplier_pairs(spark, sf):
    anchors = blend.last_actual_by_target(supplier_panel(spark, sf))
    return blend.pair_models(current_long(spark, sf), anchors, "trend", "level")


@query("b0_last_actual", with_inputs(["market_wide"], "SELECT target, last_actual FROM anchors",
                                     {"anchors": MARKET_PAIRS["anchors"]}))
def b0(spark, sf):
    return blend.last_actual(market_wide(spark, sf), TARGETS)


@query("b1_pairs", with_inputs(["current_long"], "SELECT forecast_date, target, a, b, last_actual FROM pairs", SUPPLIER_PAIRS))
def b1(spark, sf):
    return supplier_pairs(spark, sf)


@query("b2_mixed", with_inputs(["current_long"], f"SELECT target, forecast_date, {q6('mixed')} AS predicted FROM mix",
                               {**SUPPLIER_PAIRS, **MIX}))
def b2(spark, sf):
    return rounded(blend.mixed_path(supplier_pairs(spark, sf)), "predicted")


@query("b3_ensemble", with_inputs(["current_long"], f"SELECT target, forecast_date, {q6('(a + b) / 2')} AS predicted FROM pairs",
                                  SUPPLIER_PAIRS))
def b3(spark, sf):
    return rounded(blend.ensemble(supplier_pairs(spark, sf)), "predicted")


def _wide(value: str) -> str:
    return ", ".join(f"{q6(f'max(CASE WHEN target = {chr(39)}{t}{chr(39)} THEN {value} END)')} AS {t}" for t in TARGETS)


B4 = (f"SELECT forecast_date, 'mixed' AS model, {_wide('mixed')} FROM mix GROUP BY forecast_date UNION ALL "
      f"SELECT forecast_date, 'mean' AS model, {_wide('(a + b) / 2')} FROM pairs GROUP BY forecast_date")
CUR = "SELECT forecast_date, model, " + ", ".join(f"{q6(t)} AS {t}" for t in TARGETS) + " FROM current_wide"


def with_derived(spark, sf):
    cur = current_wide(spark, sf)
    new = blend.derived_forecasts(cur, market_wide(spark, sf), TARGETS, "trend", "level", "mixed", "mean")
    return rounded(blend.with_derived(cur, new, ["mixed", "mean"]), *TARGETS)


@query("b4_derived", with_inputs(["current_wide", "market_wide"], f"{CUR} UNION ALL {B4}", {**MARKET_PAIRS, **MIX}))
def b4(spark, sf):
    return with_derived(spark, sf)


@query("b5_snapshot", with_inputs(["current_wide", "market_wide"],
       f"SELECT *, DATE '2001-08-06' AS run_date FROM ({CUR} UNION ALL {B4})", {**MARKET_PAIRS, **MIX}))
def b5(spark, sf):
    return blend.snapshot(with_derived(spark, sf), AS_OF)


# ---------------------------------------------------------------- run log


@query("l1_l3_run_log", with_inputs(["market_wide", "drivers_wide", "current_wide", "forecast_history"], """
    SELECT DATE '2001-07-30' AS run_date, stage,
      CASE WHEN expected_rows IS NULL THEN CASE WHEN n_rows > 0 THEN 'ok' ELSE 'error' END
           WHEN n_rows = expected_rows THEN 'ok' WHEN n_rows BETWEEN 1 AND expected_rows - 1 THEN 'warn'
           WHEN n_rows = 0 THEN 'error' ELSE 'warn' END AS status,
      table_name, n_rows, min_date, max_date, expected_rows,
      'rows=' || n_rows || ' | range=' || min_date || ' to ' || max_date AS detail
    FROM (
      SELECT 'RAW_EXTERNAL' AS stage, 'raw_panel' AS table_name, count(*) AS n_rows, min(date) AS min_date,
             max(date) AS max_date, CAST(NULL AS BIGINT) AS expected_rows FROM drivers_wide
      UNION ALL SELECT 'DATA_PROC', 'panel', count(*), min(date), max(date), NULL FROM market_wide
      UNION ALL SELECT 'PRED_' || CASE model WHEN 'trend' THEN 'MODEL_A' ELSE upper(model) END, 'forecasts', count(*),
             min(forecast_date), max(forecast_date), 10 FROM current_wide WHERE model IN ('trend', 'level') GROUP BY model
      UNION ALL SELECT 'HIST_' || CASE model WHEN 'trend' THEN 'MODEL_A' ELSE upper(model) END || '_HOY',
             'forecast_history', count(*), min(forecast_date), max(forecast_date), 10
             FROM forecast_history WHERE model IN ('trend', 'level') AND run_date = DATE '2001-07-30' GROUP BY model)"""))
def l1(spark, sf):
    log = runlog.run_log(
        drivers_wide(spark, sf), market_wide(spark, sf), current_wide(spark, sf), forecast_history(spark, sf),
        MODELS, dt.date(2001, 7, 30), dt.datetime(2001, 7, 30, 12), 10, {"trend": "MODEL_A"})
    return log.drop("run_ts")


# ---------------------------------------------------------------- errors

ACTUALS = ("SELECT series AS target, date, value AS actual, lag(value) OVER (PARTITION BY series ORDER BY date) "
           "AS previous_actual FROM {p} WHERE value IS NOT NULL")
DIR = "CASE WHEN previous_actual IS NULL THEN NULL WHEN {v} > previous_actual THEN 1 WHEN {v} < previous_actual THEN -1 ELSE 0 END"
SCORED = f"""
    SELECT run_date, forecast_date, model, p.target, previous_actual, actual, predicted,
      abs(actual - predicted) AS abs_error, abs(actual - predicted) / nullif(abs(actual), 0) AS ape,
      CAST({DIR.format(v='predicted')} AS BIGINT) AS predicted_direction,
      CAST({DIR.format(v='actual')} AS BIGINT) AS actual_direction,
      CAST(CASE WHEN previous_actual IS NULL THEN NULL WHEN ({DIR.format(v='predicted')}) = ({DIR.format(v='actual')})
           THEN 1 ELSE 0 END AS BIGINT) AS direction_hit
    FROM preds p JOIN actuals a ON a.target = p.target AND a.date = p.forecast_date"""
COLS = [f.name for f in S.ERRORS]
SHOW_ERRORS = ", ".join(f"{q6(c)} AS {c}" if c in ("abs_error", "ape", "predicted") else c for c in COLS)
FIRST = """SELECT t.* FROM scored t WHERE NOT EXISTS (SELECT 1 FROM scored x WHERE x.forecast_date = t.forecast_date
    AND x.model = t.model AND x.target = t.target AND x.predicted = t.predicted AND x.run_date < t.run_date)"""
S_STEPS = {
    "preds": "SELECT DISTINCT run_date, forecast_date, model, target, predicted FROM supplier_forecasts",
    "actuals": ACTUALS.format(p="supplier_panel"), "scored": SCORED, "first_made": FIRST,
}
M_STEPS = {
    "preds": "SELECT * FROM (" + union_long("forecast_history", TARGETS, "run_date, forecast_date, model", "target", "predicted")
             + ") WHERE predicted IS NOT NULL",
    "actuals": ACTUALS.format(p="market_long"), "scored": SCORED, "first_made": FIRST,
}


def _upto(steps: dict, last: str) -> dict:
    keep = list(steps)[: list(steps).index(last) + 1]
    return {k: steps[k] for k in keep}


def show_errors(df):
    return rounded(df, "abs_error", "ape", "predicted")


@query("m1_predictions", with_inputs(["forecast_history"], "SELECT run_date, forecast_date, model, target, predicted FROM preds",
                                     _upto(M_STEPS, "preds")))
def m1(spark, sf):
    # every row twice: repeated loads must not show
    h = forecast_history(spark, sf)
    return M.predictions(h.unionByName(h), TARGETS, MODELS)


@query("m2_actuals", with_inputs(["gappy_panel"], "SELECT target, date, actual, previous_actual FROM actuals",
                                 {"actuals": ACTUALS.format(p="gappy_panel")}))
def m2(spark, sf):
    return M.actuals_with_previous(gappy_panel(spark, sf))


@query("m3_score", with_inputs(["supplier_forecasts"], f"SELECT {SHOW_ERRORS} FROM scored", _upto(S_STEPS, "scored")))
def m3(spark, sf):
    preds = M.one_prediction(supplier_forecasts(spark, sf))
    return show_errors(M.score(preds, M.actuals_with_previous(supplier_series(spark, sf))))


@query("m4_first_publication", with_inputs(["supplier_forecasts"], f"SELECT {SHOW_ERRORS} FROM first_made", S_STEPS))
def m4(spark, sf):
    preds = M.one_prediction(supplier_forecasts(spark, sf))
    return show_errors(M.forecast_errors(preds, supplier_series(spark, sf)))


@query("m5_error_fact", with_inputs(["forecast_history", "market_long"], f"SELECT {SHOW_ERRORS} FROM first_made", M_STEPS))
def m5(spark, sf):
    preds = M.predictions(forecast_history(spark, sf), TARGETS, MODELS)
    return show_errors(M.forecast_errors(preds, market_long(spark, sf)))


# ---------------------------------------------------------------- reports

NEWEST = ("SELECT h.* FROM forecast_history h JOIN (SELECT model, max(run_date) AS run_date FROM forecast_history "
          "GROUP BY model) USING (model, run_date)")


@query("v1_actuals_and_forecasts", with_inputs(["market_long", "forecast_history"], """
    SELECT date, series AS target, value, 'real' AS source, CAST(1 AS BIGINT) AS source_order FROM market_long
    WHERE value IS NOT NULL AND date >= (SELECT CAST(max(date) - INTERVAL 2 YEAR AS DATE) FROM market_long)
    UNION ALL SELECT forecast_date, target, value, model, CASE model WHEN 'trend' THEN 2 ELSE 3 END FROM ("""
    + union_long("newest", TARGETS, "forecast_date, model", "target") + ") WHERE value IS NOT NULL", {"newest": NEWEST}))
def v1(spark, sf):
    return report.actuals_and_forecasts(
        market_wide(spark, sf), forecast_history(spark, sf), TARGETS, {"trend": 2, "level": 3}, years=2)


@query("v2_summary", with_inputs(["market_long", "forecast_history"], """
    SELECT date, series AS target, value, m.model AS source, CAST(1 AS BIGINT) AS source_order, 'real' AS kind
    FROM market_long, (VALUES ('trend'), ('level')) AS m(model)
    WHERE value IS NOT NULL AND date >= (SELECT max(date) - 30 FROM market_long)
    UNION ALL SELECT forecast_date, target, value, model, 2, 'prediccion' FROM ("""
    + union_long("newest", TARGETS, "forecast_date, model", "target") + ") WHERE value IS NOT NULL", {"newest": NEWEST}))
def v2(spark, sf):
    return report.summary(market_wide(spark, sf), forecast_history(spark, sf), TARGETS, MODELS)


@query("v3_newest_run", with_inputs(["supplier_forecasts"], """
    SELECT h.model, h.run_date, h.forecast_date, h.target, h.predicted FROM supplier_forecasts h
    JOIN (SELECT model, max(run_date) AS run_date FROM supplier_forecasts GROUP BY model) USING (model, run_date)"""))
def v3(spark, sf):
    return report.newest_run(supplier_forecasts(spark, sf), MODELS)


# ---------------------------------------------------------------- features


@query("x1_calendar", with_inputs(["market_wide"], """
    SELECT date, CAST((8 - isodow(date)) % 7 AS BIGINT) AS days_to_monday, CAST(isodow(date) - 1 AS BIGINT) AS days_since_monday,
      CAST(month(date) AS BIGINT) AS month, CAST(CASE WHEN day(date) <= 15 THEN 1 ELSE 2 END AS BIGINT) AS half_month,
      CAST(CASE WHEN lead(month(date)) OVER (ORDER BY date) IS DISTINCT FROM month(date) THEN 1 ELSE 0 END AS BIGINT) AS month_close
    FROM market_wide"""))
def x1(spark, sf):
    return X.calendar_features(market_wide(spark, sf).select("date"))


@query("x2_drop_constant", """
    SELECT o_custkey AS series, CAST(o_orderdate AS DATE) AS date, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS value
    FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey
      HAVING count(DISTINCT substr(o_orderpriority, 1, 1)) > 1)""")
def x2(spark, sf):
    return X.drop_constant(table(spark, sf, "orders").select(
        F.col("o_custkey").alias("series"), F.to_date("o_orderdate").alias("date"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("value")))


def _pair(a: str, b: str) -> str:
    return (f"SELECT '{a}' AS a, '{b}' AS b, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n, "
            f"{q6(f'corr({a}, {b})')} AS corr FROM drivers_wide")


@query("x3_correlations", with_inputs(["drivers_wide"], " UNION ALL ".join(
    _pair(a, b) for i, a in enumerate(DRIVERS) for b in DRIVERS[i:])))
def x3(spark, sf):
    return rounded(X.correlations(drivers_wide(spark, sf), DRIVERS), "corr")


def _walk_sql(threshold: float) -> tuple[str, dict[str, str]]:
    """One step per driver: kept unless it is too close to a kept one before it."""
    pairs = [(i, j) for j in range(len(DRIVERS)) for i in range(j)]
    steps = {"w0": "SELECT " + ", ".join(f"coalesce(abs(corr({DRIVERS[i]}, {DRIVERS[j]})), 0) AS r{i}{j}" for i, j in pairs)
             + " FROM drivers_wide"}
    for j in range(len(DRIVERS)):
        near = " OR ".join(f"(k{i} AND r{i}{j} >= {threshold})" for i in range(j)) or "FALSE"
        steps[f"w{j + 1}"] = f"SELECT *, NOT ({near}) AS k{j} FROM w{j}"
    body = " UNION ALL ".join(f"SELECT '{c}' AS variable, CAST({i + 1} AS BIGINT) AS position FROM w{len(DRIVERS)} WHERE k{i}"
                              for i, c in enumerate(DRIVERS))
    return body, steps


@query("x3b_correlation_prune", with_inputs(["drivers_wide"], *_walk_sql(0.02)))
def x3b(spark, sf):
    return X.correlation_prune(drivers_wide(spark, sf), DRIVERS, 0.02)


THREE = ["af_px", "nf_px", "rf_px"]


CORR_THREE = {
    "r": "SELECT corr(af_px, nf_px) AS r12, corr(af_px, rf_px) AS r13, corr(nf_px, rf_px) AS r23 FROM drivers_wide "
         "WHERE af_px IS NOT NULL AND nf_px IS NOT NULL AND rf_px IS NOT NULL",
    "m": "SELECT *, 1 + 2 * r12 * r13 * r23 - r12 * r12 - r13 * r13 - r23 * r23 AS det FROM r",
    "v": "SELECT 'af_px' AS variable, (1 - r23 * r23) / det AS vif, r23 AS rest FROM m UNION ALL "
         "SELECT 'nf_px', (1 - r13 * r13) / det, r13 FROM m UNION ALL SELECT 'rf_px', (1 - r12 * r12) / det, r12 FROM m",
}


@query("x4_vif", with_inputs(["drivers_wide"], f"SELECT variable, {q6('vif')} AS vif FROM v", CORR_THREE))
def x4(spark, sf):
    return rounded(X.vif_table(drivers_wide(spark, sf).dropna(subset=THREE), THREE), "vif")


@query("x5c_vif_prune_three", with_inputs(["drivers_wide"], f"""
    SELECT 't' AS target, variable, variable <> worst AS kept, CASE WHEN variable = worst THEN CAST(1 AS BIGINT) END AS drop_step,
           {q6('CASE WHEN variable = worst THEN vif ELSE 1 / (1 - rest2 * rest2) END')} AS vif
    FROM v, (SELECT arg_max(variable, vif) AS worst, arg_max(rest, vif) AS rest2 FROM v)""", CORR_THREE))
def x5c(spark, sf):
    """One step of pruning, any factor above 1 being too high."""
    wide = drivers_wide(spark, sf).dropna(subset=THREE)
    return rounded(X.vif_prune(wide, {"t": THREE}, 1.0, min_features=2), "vif")


def covariates(spark, sf):
    """Market and driver columns on market dates, without gaps, with derived near copies."""
    wide = P.left_align(market_wide(spark, sf), [drivers_wide(spark, sf)])
    cols = [*TARGETS, *DRIVERS]
    full = P.to_wide(fill.median_fill(P.to_long(wide, cols, keep_nulls=True)), cols, ["date"])
    return full.withColumn("twin", F.col("af_px") + F.col("ao_px") * 0.001)


@query("x5_vif_prune")
def x5(spark, sf):
    names = [*TARGETS, *DRIVERS, "twin"]
    lists = {t: [c for c in names if c != t] for t in TARGETS}
    return rounded(X.vif_prune(covariates(spark, sf), lists, 5.0), "vif")


@query("x5b_vif_prune_raw")
def x5b(spark, sf):
    return X.vif_prune_raw(covariates(spark, sf), [*DRIVERS, "twin"], 10.0)


@query("x6_resolve_features", """
    SELECT p_brand AS target, p_name AS variable, p_partkey AS position, p_name IN ('red ring', 'small bolt') AS found,
    row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) <= 20 AS chosen FROM part""")
def x6(spark, sf):
    config = table(spark, sf, "part").select(
        F.col("p_brand").alias("target"), F.col("p_name").alias("variable"), F.col("p_partkey").alias("position"))
    return X.resolve_features(config, ["red ring", "small bolt"], 20)


YJ = ("CASE WHEN {y} >= 0 THEN (pow({y} + 1, {l}) - 1) / {l} ELSE -(pow(1 - ({y}), 2 - {l}) - 1) / (2 - {l}) END")


@query("x7_transforms", with_inputs(["supplier_panel"], f"""
    SELECT series, date, {q6(YJ.format(y='(value - 30)', l='0.4'))} AS yj, {q6('(pow(value + 2, 0.3) - 1) / 0.3')} AS bc,
           {q6('ln(value)')} AS lg FROM supplier_panel"""))
def x7(spark, sf):
    from pricepanel.functions.transforms import forward

    v = F.col("value")
    return supplier_panel(spark, sf).select(
        "series", "date", r6(forward(v - 30, "yeojohnson", 0.4), "yj"), r6(forward(v, "boxcox", 0.3, 2.0), "bc"),
        r6(forward(v, "log"), "lg"))


@query("x8_inverse", with_inputs(["supplier_panel"], f"""
    SELECT series, date, value - 30 AS yj, {q6('CASE WHEN t >= 0 THEN pow(greatest(0.5 * t + 1, 1e-12), 2) - 1 '
    'ELSE 1 - pow(greatest(1 - 1.5 * t, 1e-12), 1 / CAST(1.5 AS DOUBLE)) END')} AS yj_half,
    {q6('CASE WHEN t >= 0 THEN 1 / (1 - least(t, 1 - 1e-10)) - 1 ELSE 1 - pow(1 - 3 * t, 1 / CAST(3 AS DOUBLE)) END')} AS yj_clipped
    FROM (SELECT *, (value - 30) / 64 AS t FROM supplier_panel)"""))
def x8(spark, sf):
    from pricepanel.functions.transforms import forward, inverse

    v, t = F.col("value") - 30, (F.col("value") - 30) / 64
    # t stays below 1 for lambda -1 after clipping; the result there grows to 1e10
    return supplier_panel(spark, sf).select(
        "series", "date", r6(inverse(forward(v, "yeojohnson", 0.4), "yeojohnson", 0.4), "yj"),
        r6(inverse(t, "yeojohnson", 0.5), "yj_half"), r6(inverse(t, "yeojohnson", -1.0, clipped=True), "yj_clipped"))


def _lambda_sql() -> str:
    """A grid search from -12 to 24, one step per round."""
    y, pts = "value", 37
    steps = {"g0": "SELECT DISTINCT series, CAST(-12 AS DOUBLE) AS f, CAST(1 AS DOUBLE) AS s FROM supplier_panel"}
    yj = ("CASE WHEN abs(lam) < 1e-12 THEN ln(1 + value) ELSE (pow(value + 1, lam) - 1) / lam END")
    for r in range(4):
        steps[f"l{r}"] = (
            f"SELECT series, f, s, i, -n / 2 * ln(nullif(v, 0)) + (lam - 1) * slope AS ll FROM ("
            f"SELECT series, f, s, i, lam, count(*) AS n, var_pop({yj}) AS v, sum(ln(1 + value)) AS slope FROM ("
            f"SELECT p.series, p.value, f, s, i, f + s * i AS lam FROM supplier_panel p JOIN g{r} USING (series), range({pts}) AS k(i)"
            f") GROUP BY series, f, s, i, lam)")
        if r < 3:
            steps[f"g{r + 1}"] = (
                f"SELECT series, f + s * (b - 1) AS f, s * 2 / {pts - 1} AS s FROM ("
                f"SELECT series, any_value(f) AS f, any_value(s) AS s, arg_max(i, ll) AS b FROM l{r} GROUP BY series)")
    steps["top"] = "SELECT series, any_value(f) AS f, any_value(s) AS s, arg_max(i, ll) AS b FROM l3 GROUP BY series"
    steps["three"] = ("SELECT t.series, t.f, t.s, t.b, max(ll) FILTER (i = b - 1) AS y0, max(ll) FILTER (i = b) AS y1, "
                      "max(ll) FILTER (i = b + 1) AS y2 FROM top t JOIN l3 USING (series) GROUP BY ALL")
    return with_inputs(["supplier_panel"],
                       "SELECT series, round(f + s * (b + (y0 - y2) / (2 * (y0 - 2 * y1 + y2))), 3) AS lam FROM three", steps)


@query("x9_lambda", _lambda_sql())
def x9(spark, sf):
    return X.fit_lambda(supplier_panel(spark, sf)).select("series", F.round("lam", 3).alias("lam"))


@query("x10_sequences", with_inputs(["supplier_panel"], """
    SELECT series, date, x[1] AS x_first, x[28] AS x_last, list_sum(x) AS x_sum, y[1] AS y_first, y[7] AS y_last,
           list_sum(y) AS y_sum FROM (
      SELECT series, date, list(value) OVER (PARTITION BY series ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS x,
             list(value) OVER (PARTITION BY series ORDER BY date ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) AS y
      FROM supplier_panel) WHERE len(x) = 28 AND len(y) = 7"""))
def x10(spark, sf):
    s = X.sequences(supplier_panel(spark, sf), ["value"], ["value"])
    total = lambda c: F.aggregate(F.flatten(c), F.lit(0.0), lambda a, v: a + v)
    return s.select(
        "series", "date", F.get(F.get("x", F.lit(0)), F.lit(0)).alias("x_first"),
        F.get(F.get("x", F.lit(27)), F.lit(0)).alias("x_last"), total("x").alias("x_sum"),
        F.get(F.get("y", F.lit(0)), F.lit(0)).alias("y_first"), F.get(F.get("y", F.lit(6)), F.lit(0)).alias("y_last"),
        total("y").alias("y_sum"))


@query("x11_standardize", with_inputs(["supplier_panel"], f"""
    SELECT series, date, {q6('(value - m) / CASE WHEN s = 0 THEN 1 ELSE s END')} AS value FROM supplier_panel
    JOIN (SELECT series, avg(value) AS m, stddev_pop(value) AS s FROM supplier_panel WHERE date < DATE '2000-01-01'
          GROUP BY series) USING (series)"""))
def x11(spark, sf):
    p = supplier_panel(spark, sf)
    stats = X.train_statistics(p.where(F.col("date") < F.lit(dt.date(2000, 1, 1))))
    return rounded(X.standardize(p, stats), "value")


@query("x11b_unstandardize", with_inputs(["supplier_panel"], "SELECT series, date, value FROM supplier_panel"))
def x11b(spark, sf):
    p = supplier_panel(spark, sf)
    stats = X.train_statistics(p)
    return rounded(X.unstandardize(X.standardize(p, stats), stats), "value")


# ---------------------------------------------------------------- backtests


@query("e1_folds", with_inputs(["from_end"], """
    SELECT series, date, value, 5 - e // 7 AS window_id, n - (e // 7 + 1) * 7 AS train_rows
    FROM from_end WHERE n > 40 AND e < 35"""))
def e1(spark, sf):
    return bt.rolling_folds(supplier_panel(spark, sf))


@query("e2_windows", with_inputs(["holdout"], """
    SELECT series, date, value, window_id, min(date) OVER w AS window_start, max(date) OVER w AS window_end
    FROM holdout WINDOW w AS (PARTITION BY series, window_id)"""))
def e2(spark, sf):
    return bt.holdout_windows(supplier_panel(spark, sf))


@query("e2b_window_ranges", with_inputs(["holdout"], """
    SELECT series, window_id, min(date) AS window_start, max(date) AS window_end, count(*) AS n_rows
    FROM holdout GROUP BY series, window_id"""))
def e2b(spark, sf):
    return bt.window_ranges(bt.holdout_windows(supplier_panel(spark, sf)))


@query("e2c_too_short", with_inputs(["supplier_panel"], """
    SELECT series, count(*) AS n_rows FROM supplier_panel GROUP BY series HAVING count(*) < 530"""))
def e2c(spark, sf):
    return bt.too_short(supplier_panel(spark, sf), 530)


@query("e2d_training_rows", with_inputs(["holdout"], """
    SELECT p.series, p.date, p.value, w.window_id, w.window_start FROM supplier_panel p
    JOIN (SELECT series, window_id, min(date) AS window_start FROM holdout GROUP BY series, window_id) w
      ON p.series = w.series AND p.date < w.window_start"""))
def e2d(spark, sf):
    p = supplier_panel(spark, sf)
    return bt.training_rows(p, bt.holdout_windows(p))


@query("e3_naive", with_inputs(["naive"], "SELECT target AS series, model, window_id, date, y_true, y_pred, y_base FROM naive"))
def e3(spark, sf):
    return bt.naive_last(supplier_series(spark, sf))


ACC = (f"{q6('avg(CASE WHEN sign(y_true - y_base) = sign(y_pred - y_base) THEN CAST(1 AS DOUBLE) ELSE 0 END) * 100')} AS direction_pct, "
       f"{q6('avg(abs(y_true - y_pred) / greatest(abs(y_true), 1e-9)) * 100')} AS mape_pct, "
       f"{q6('sqrt(avg((y_true - y_pred) * (y_true - y_pred)))')} AS rmse")
ACC_COLS = ["direction_pct", "mape_pct", "rmse"]


@query("e7_e8_accuracy", with_inputs(["backtest_records"], f"SELECT target, model, {ACC} FROM backtest_records GROUP BY target, model"))
def e7(spark, sf):
    return rounded(M.accuracy(backtest_records(spark, sf)), *ACC_COLS)


@query("e16_accuracy_by_group", with_inputs(["backtest_records"],
       f"SELECT target, model, window_id, {ACC} FROM backtest_records GROUP BY target, model, window_id"))
def e16(spark, sf):
    return rounded(M.accuracy(backtest_records(spark, sf), ["target", "model", "window_id"]), *ACC_COLS)


@query("e9_direction_previous", with_inputs(["backtest_records"], f"""
    SELECT target, model, {q6('avg(CASE WHEN sign(y_true - y_prev) = sign(y_pred - y_prev) THEN CAST(1 AS DOUBLE) ELSE 0 END) * 100')}
      AS direction_pct FROM (SELECT *, lag(y_true) OVER (PARTITION BY target, model ORDER BY date) AS y_prev FROM backtest_records)
    WHERE y_prev IS NOT NULL GROUP BY target, model"""))
def e9(spark, sf):
    return rounded(M.direction_vs_previous(backtest_records(spark, sf)), "direction_pct")


FOLDS = ("SELECT target, model, window_id, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse, "
         "avg(abs(y_true - y_pred) / greatest(abs(y_true), 1e-9)) * 100 AS mape, "
         "avg(CASE WHEN sign(y_true - y_base) = sign(y_pred - y_base) THEN CAST(1 AS DOUBLE) ELSE 0 END) AS direction "
         "FROM backtest_records GROUP BY target, model, window_id")
SUMMARY_COLS = [f"{c}_{k}" for c in ("rmse", "mape", "direction") for k in ("mean", "std")]
SUMMARY = "SELECT target, model, " + ", ".join(
    f"{q6(f'{f}({c})')} AS {c}_{k}" for c in ("rmse", "mape", "direction")
    for k, f in (("mean", "avg"), ("std", "stddev_pop"))) + " FROM folds GROUP BY target, model"


@query("e10_fold_summary", with_inputs(["backtest_records"], SUMMARY, {"folds": FOLDS}))
def e10(spark, sf):
    return rounded(M.fold_summary(backtest_records(spark, sf)), *SUMMARY_COLS)


LB = {
    "res": "SELECT target, model, date, r - avg(r) OVER (PARTITION BY target, model) AS e FROM "
           "(SELECT *, y_true - y_pred AS r FROM backtest_records)",
    "lagged": "SELECT *, " + ", ".join(f"e * lag(e, {k}) OVER w AS p{k}" for k in range(1, 11))
              + " FROM res WINDOW w AS (PARTITION BY target, model ORDER BY date)",
    "sums": "SELECT target, model, count(*) AS n, sum(e * e) AS s0, " + ", ".join(f"sum(p{k}) AS s{k}" for k in range(1, 11))
            + " FROM lagged GROUP BY target, model",
    "stat": "SELECT target, model, n, CASE WHEN n > 11 THEN n * (n + 2) * ("
            + " + ".join(f"pow(s{k} / nullif(s0, 0), 2) / (n - {k})" for k in range(1, 11)) + ") END AS q FROM sums",
}
TAIL = "exp(-q / 2) * (1 + q / 2 + pow(q / 2, 2) / 2 + pow(q / 2, 3) / 6 + pow(q / 2, 4) / 24)"


@query("e11_ljung_box", with_inputs(["backtest_records"], f"""
    SELECT target, model, n, {q6('q')} AS lb_stat, {q6(TAIL)} AS lb_pvalue, {TAIL} > 0.05 AS lb_ok FROM stat""", LB))
def e11(spark, sf):
    r = backtest_records(spark, sf).withColumn("residual", F.col("y_true") - F.col("y_pred"))
    return rounded(M.ljung_box(r), "lb_stat", "lb_pvalue")


@query("e12_grid", """
    SELECT s_suppkey AS target, CAST(p AS BIGINT) AS p, CAST(d AS BIGINT) AS d, CAST(q AS BIGINT) AS q,
      CAST(sp AS BIGINT) AS sp, CAST(sd AS BIGINT) AS sd, CAST(sq AS BIGINT) AS sq, CAST(s AS BIGINT) AS s FROM supplier, (VALUES (1)) AS a(p), (VALUES (1)) AS b(d),
      (VALUES (1), (2)) AS c(q), (VALUES (1), (2)) AS e(sp), (VALUES (0)) AS f(sd), (VALUES (0), (1)) AS g(sq),
      (VALUES (5)) AS h(s)""")
def e12(spark, sf):
    values = dict(zip(("p", "d", "q", "sp", "sd", "sq", "s"), fv.GRID["plata"].values()))
    targets = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("target"))
    return bt.grid_points(targets, values)


@query("e13_rank", with_inputs(["backtest_records"], """
    SELECT target, model, mape_mean, direction_mean, row_number() OVER (PARTITION BY target
      ORDER BY direction_mean DESC, mape_mean DESC, model) AS rank FROM summary""",
       {"folds": FOLDS, "summary": SUMMARY}))
def e13(spark, sf):
    s = rounded(M.fold_summary(backtest_records(spark, sf)), *SUMMARY_COLS)
    return M.rank_grid(s.select("target", "model", "mape_mean", "direction_mean"))


@query("e14_best", with_inputs(["backtest_records"], """
    SELECT target, mape_pct, model, direction_pct, rmse FROM acc
    QUALIFY row_number() OVER (PARTITION BY target ORDER BY mape_pct, model) = 1""",
       {"acc": f"SELECT target, model, {ACC} FROM backtest_records GROUP BY target, model"}))
def e14(spark, sf):
    return M.best_by_mape(rounded(M.accuracy(backtest_records(spark, sf)), *ACC_COLS))


@query("e15_compare", with_inputs(["backtest_records"], "SELECT target, " + ", ".join(
    f"n.{c} AS naive_{c}" for c in ACC_COLS) + ", " + ", ".join(f"h.{c} AS half_{c}" for c in ACC_COLS)
    + """ FROM (SELECT * FROM acc WHERE model = 'naive_last') n LEFT JOIN
    (SELECT acc.* FROM acc JOIN supplier ON s_suppkey = target WHERE model = 'half_way' AND s_nationkey < 12) h USING (target)""",
    {"acc": f"SELECT target, model, {ACC} FROM backtest_records GROUP BY target, model"}))
def e15(spark, sf):
    acc = rounded(M.accuracy(backtest_records(spark, sf)), *ACC_COLS)
    naive = acc.where("model = 'naive_last'").drop("model")
    # a model that runs for the suppliers of some nations only
    covered = table(spark, sf, "supplier").where("s_nationkey < 12").select(F.col("s_suppkey").alias("target"))
    half = acc.where("model = 'half_way'").drop("model").join(covered, "target", "left_semi")
    return M.compare({"naive": naive}, {"half": half})


def market_rows(spark, sf):
    wide = P.business_days_only(P.left_align(market_wide(spark, sf), [drivers_wide(spark, sf)]))
    return wide, fc.target_rows(wide, {t: DRIVERS for t in TARGETS})


ORDERS = {t: fv.MODEL_ORDERS[k][:2] for t, k in zip(TARGETS, fv.TARGETS)}


@query("e4_forecast")
def e4(spark, sf):
    _, rows = market_rows(spark, sf)
    return rounded(fc.forecast(rows, 10, ORDERS, "regression"), "predicted")


def _slope_steps(source: str, before: str = "TRUE") -> dict[str, str]:
    """The default model in closed form, from ``key, date, y`` rows: one autoregressive term on
    first differences without intercept is a ratio of two sums, its path a geometric sum."""
    return {
        "z0": f"SELECT *, y - lag(y) OVER (PARTITION BY key ORDER BY date) AS z FROM {source} WHERE {before}",
        "z1": "SELECT *, lag(z) OVER (PARTITION BY key ORDER BY date) AS zp FROM z0",
        "fit": "SELECT key, count(*) AS n, max_by(y, date) AS y0, max_by(z, date) AS z0, coalesce(sum(z * zp) / nullif(sum("
               "CASE WHEN z IS NOT NULL AND zp IS NOT NULL THEN zp * zp END), 0), 0) AS phi FROM z1 GROUP BY key",
    }


PATH = "y0 + z0 * list_sum(list_transform(range(1, step + 1), lambda i: pow(phi, i)))"
NEXT_DAYS = ("SELECT row_number() OVER (ORDER BY d) AS step, d AS forecast_date FROM (SELECT CAST(last + CAST(i AS INTEGER) AS DATE) AS d "
             "FROM (SELECT max(date) AS last FROM src), range(1, 40) AS k(i)) WHERE isodow(d) <= 5")


@query("e4b_forecast_suppliers", with_inputs(["supplier_panel"], f"""
    SELECT forecast_date, 'regression' AS model, key AS target, CASE WHEN n >= 5 THEN {q6(PATH)} END AS predicted,
           CASE WHEN n >= 5 THEN 'no_covariates' ELSE 'failed' END AS status FROM fit, next_days WHERE step <= 10""",
       {"src": "SELECT series AS key, date, value AS y FROM supplier_panel WHERE value IS NOT NULL", **_slope_steps("src"),
        "next_days": NEXT_DAYS}))
def e4b(spark, sf):
    """One model per supplier, no covariates."""
    return rounded(fc.forecast(supplier_rows(spark, sf), 10, {}, "regression", "none"), "predicted")


def supplier_rows(spark, sf):
    return supplier_panel(spark, sf).select(
        F.col("series").alias("target"), "date", F.col("value").alias("y"), F.array().cast("array<double>").alias("x"))


@query("e5_fallback", with_inputs([], f"""
    SELECT forecast_date, 'regression' AS model, key AS target, CASE WHEN n >= 20 THEN {q6(PATH)} ELSE round(y0, 6) END AS predicted,
           CASE WHEN n >= 20 THEN 'no_covariates' ELSE 'naive' END AS status FROM fit, next_days WHERE step <= 5""",
       {"src": "SELECT o_custkey AS key, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS y FROM orders GROUP BY ALL",
        **_slope_steps("src"), "next_days": NEXT_DAYS}))
def e5(spark, sf):
    """Series of customers are often too short to fit: those fall back to the last value."""
    rows = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("target"), F.to_date("o_orderdate").alias("date")).agg(
        F.max("o_totalprice").alias("y")).withColumn("x", F.array().cast("array<double>"))
    return rounded(fc.forecast(rows, 5, {}, "regression", "none", fallback=True), "predicted")


def market_windows(spark, sf):
    """Target rows, and the windows of the panel's own calendar for every target."""
    wide, rows = market_rows(spark, sf)
    windows = bt.calendar_windows(wide)
    held = rows.drop("x").join(F.broadcast(windows), "date")  # 63 rows
    return rows, held.withColumnRenamed("y", "y_true")


@query("e6_backtest")
def e6(spark, sf):
    rows, windows = market_windows(spark, sf)
    return rounded(fc.backtest(rows, windows, 7, {t: [o] for t, o in ORDERS.items()}, "regression"),
                   "y_pred", "aic", "bic")


WINDOW_ROWS = ("SELECT {{'series': p.series, 'window_id': w.window_id}} AS key, p.date, p.value AS y FROM supplier_panel p JOIN "
               "(SELECT series, window_id, min(date) AS start FROM holdout GROUP BY ALL) w ON p.series = w.series AND p.date < w.start")


@query("e6c_backtest_suppliers", with_inputs(["holdout"], f"""
    SELECT series AS target, 'regression' AS model, CAST(1 AS BIGINT) AS grid_point, window_id, date, value AS y_true,
           CASE WHEN n >= 21 THEN {q6(PATH)} END AS y_pred, CASE WHEN n >= 21 THEN round(y0, 6) END AS y_base,
           CASE WHEN n >= 21 THEN 'no_covariates' ELSE 'few_rows' END AS status
    FROM (SELECT series, window_id, date, value, row_number() OVER (PARTITION BY series, window_id ORDER BY date) AS step FROM holdout) h
    LEFT JOIN fit ON fit.key = {{'series': h.series, 'window_id': h.window_id}}""",
       {"src": WINDOW_ROWS.format(), **_slope_steps("src")}))
def e6c(spark, sf):
    """The default model for every supplier in every window."""
    windows = bt.holdout_windows(supplier_panel(spark, sf)).withColumnsRenamed({"series": "target", "value": "y_true"})
    records = fc.backtest(supplier_rows(spark, sf), windows, 7, {}, "regression", "none")
    return rounded(records.drop("aic", "bic"), "y_pred", "y_base")


def _covariate_steps(source: str) -> dict[str, str]:
    """One autoregressive term on first differences and one differenced covariate, by the normal
    equations of two unknowns; the covariate stays at its last value, so it adds nothing ahead."""
    line = "OVER (PARTITION BY key ORDER BY date)"
    return {
        "c0": f"SELECT *, y - lag(y) {line} AS z, x - lag(x) {line} AS u FROM {source}",
        "c1": f"SELECT *, lag(z) {line} AS zp FROM c0",
        "c2": "SELECT key, count(*) AS n, max_by(y, date) AS y0, max_by(z, date) AS z0, sum(zp * zp) FILTER (z IS NOT NULL) AS a, sum(zp * u) AS b, "
              "sum(u * u) FILTER (zp IS NOT NULL) AS c, sum(zp * z) AS d, sum(u * z) FILTER (zp IS NOT NULL) AS e FROM c1 GROUP BY key",
        "fit": "SELECT *, (c * d - b * e) / (a * c - b * b) AS phi FROM c2",
    }


PRICED = "SELECT l_suppkey AS series, CAST(l_shipdate AS DATE) AS date, sum(l_extendedprice) / 1000 AS x FROM lineitem GROUP BY ALL"
PRICED_ROWS = ("SELECT {{'series': p.series, 'window_id': w.window_id}} AS key, p.date, p.value AS y, x FROM supplier_panel p JOIN priced USING (series, date) JOIN "
               "(SELECT series, window_id, min(date) AS start FROM holdout GROUP BY ALL) w ON p.series = w.series AND p.date < w.start")


@query("e6d_backtest_covariate", with_inputs(["holdout"], f"""
    SELECT series AS target, 'regression' AS model, CAST(1 AS BIGINT) AS grid_point, window_id, date, value AS y_true,
           CASE WHEN n >= 21 THEN {q6(PATH)} END AS y_pred, CASE WHEN n >= 21 THEN round(y0, 6) END AS y_base,
           CASE WHEN n >= 21 THEN 'covariates' ELSE 'few_rows' END AS status
    FROM (SELECT series, window_id, date, value, row_number() OVER (PARTITION BY series, window_id ORDER BY date) AS step FROM holdout) h
    LEFT JOIN fit ON fit.key = {{'series': h.series, 'window_id': h.window_id}}""",
       {"priced": PRICED, "src": PRICED_ROWS.format(), **_covariate_steps("src")}))
def e6d(spark, sf):
    """Every supplier in every window, with what it was paid as a covariate."""
    windows = bt.holdout_windows(supplier_panel(spark, sf)).withColumnsRenamed({"series": "target", "value": "y_true"})
    paid = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("target"), F.to_date("l_shipdate").alias("date")).agg(
        (F.sum("l_extendedprice") / 1000).alias("paid"))
    rows = supplier_rows(spark, sf).drop("x").join(paid, ["target", "date"]).select("target", "date", "y", F.array("paid").alias("x"))
    return rounded(fc.backtest(rows, windows, 7, {}, "regression", "none").drop("aic", "bic"), "y_pred", "y_base")


@query("e6b_grid_search")
def e6b(spark, sf):
    """Five folds for every grid point of every target, summarised and ranked, on the panel
    before the dates held out for the final test."""
    wide, rows = market_rows(spark, sf)
    held = bt.calendar_windows(wide).agg(F.min("window_start")).scalar()
    rows = rows.where(F.col("date") < held)
    folds = bt.rolling_folds(rows.drop("x"), keys=["target"])
    windows = folds.withColumnRenamed("y", "y_true").join(
        folds.groupBy("target", "window_id").agg(F.min("date").alias("window_start")), ["target", "window_id"])
    orders = {
        t: [((g["p"], g["d"], g["q"]), (g["P"], g["D"], g["Q"], g["s"])) for g in bt.grid(fv.GRID[k])]
        for t, k in zip(TARGETS, fv.TARGETS)}
    records = fc.backtest(rows, windows, 7, orders, "regression", lambda_from="global")
    return fc.rank_fitted(rounded(fc.grid_results(records), *SUMMARY_COLS, "aic_mean", "bic_mean", "lb_pvalue"))


@query("r6_research")
def r6_research(spark, sf):
    """Features, grid search before the held-out dates, and the comparison on them."""
    panel = P.left_align(market_wide(spark, sf), [drivers_wide(spark, sf)])
    orders = {t: [o, ((1, 1, 0), (0, 0, 0, 0))] for t, o in ORDERS.items()}
    found = research.run_research(spark, panel, TARGETS, DRIVERS, orders, scratch(spark, "features"))
    measures = [c for c, kind in found.dtypes if kind == "double"]
    return rounded(found.withColumn("features", F.array_join("features", ",")), *measures)


# ---------------------------------------------------------------- table writers

CURRENT = columns_of("forecast_date date, model string, target bigint, predicted double")


def _stored(spark, sf):
    path = scratch(spark)
    K.write_table(spark, path, CURRENT, ["model"], current_long(spark, sf))
    return path


@query("k1_replace_model", with_inputs(["current_long"], """
    SELECT forecast_date, model, target, predicted FROM current_long WHERE model = 'level'
    UNION ALL SELECT forecast_date, model, target, predicted + 1 FROM current_long WHERE model = 'trend' AND target % 2 = 0"""))
def k1(spark, sf):
    path = _stored(spark, sf)
    new = current_long(spark, sf).where("model = 'trend' AND target % 2 = 0").withColumn("predicted", F.col("predicted") + 1)
    K.replace_model(spark, path, CURRENT, "trend", new)
    return K.read_table(spark, path, CURRENT)


@query("k2_delete_models", with_inputs(["current_long"], """
    SELECT forecast_date, model, target, predicted FROM current_long WHERE model = 'trend'"""))
def k2(spark, sf):
    path = _stored(spark, sf)
    K.delete_models(spark, path, CURRENT, ["level", "unknown"])
    return K.read_table(spark, path, CURRENT)


SERIES_TABLE = columns_of("series bigint, date date, value double, month date")


@query("k3_replace_range", with_inputs(["supplier_panel"], """
    SELECT series, date, value FROM supplier_panel WHERE date NOT BETWEEN DATE '1999-03-10' AND DATE '1999-05-20'
    UNION ALL SELECT series, date, value + 1 FROM supplier_panel
    WHERE date BETWEEN DATE '1999-03-10' AND DATE '1999-05-20' AND isodow(date) <= 5 AND month(date) <> 4"""))
def k3(spark, sf):
    path = scratch(spark)
    p = supplier_panel(spark, sf)
    K.write_table(spark, path, SERIES_TABLE, ["month"], p.withColumn("month", F.trunc("date", "MM")))
    lo, hi = dt.date(1999, 3, 10), dt.date(1999, 5, 20)
    new = P.business_days_only(p.where(F.col("date").between(F.lit(lo), F.lit(hi)) & (F.month("date") != 4)))
    K.replace_range(spark, path, SERIES_TABLE, lo, hi, new.withColumn("value", F.col("value") + 1))
    return K.read_table(spark, path, SERIES_TABLE).drop("month")


@query("k4_replace_day", with_inputs(["current_long"], """
    SELECT forecast_date, model, target, predicted, DATE '2001-08-03' AS run_date FROM current_long
    UNION ALL SELECT forecast_date, model, target, predicted, DATE '2001-08-06' FROM current_long WHERE model = 'trend'"""))
def k4(spark, sf):
    path = scratch(spark)
    cur = current_long(spark, sf)
    both = blend.snapshot(cur, dt.date(2001, 8, 3)).unionByName(blend.snapshot(cur, AS_OF))
    schema = T.StructType([*CURRENT.fields, T.StructField("run_date", T.DateType())])
    K.write_table(spark, path, schema, ["run_date"], both)
    K.replace_day(spark, path, schema, AS_OF, blend.snapshot(cur.where("model = 'trend'"), AS_OF))
    return K.read_table(spark, path, schema)


@query("k5_replace_review", with_inputs(["gappy_panel"], "SELECT 'quality' AS t, * FROM ("
       + (NULLS[0] + NULLS[1] + NULLS[2]).format(p="gappy_panel") + ") UNION ALL SELECT 'quality', * REPLACE ('other' AS table_name) FROM ("
       + (FLAT[0] + FLAT[1] + FLAT[2]).format(p="gappy_panel") + ")"))
def k5(spark, sf):
    path = scratch(spark)
    g = gappy_panel(spark, sf)
    other = Q.Review(AS_OF, REVIEW.run_ts, "other")
    first = Q.flatline(g, REVIEW).unionByName(Q.flatline(g, other))
    K.write_table(spark, path, S.QUALITY, ["review_date", "table_name"], first)
    K.replace_review(spark, path, S.QUALITY, AS_OF, "panel", Q.null_share(g, REVIEW))
    return shown(K.read_table(spark, path, S.QUALITY), True).withColumn("t", F.lit("quality"))


MONTHLY = columns_of("run_date date, series bigint, date date, value double")


@query("k6_replace_runs", with_inputs(["supplier_panel"], """
    SELECT run_date, series, date, value FROM m WHERE year(run_date) <> 2000
    UNION ALL SELECT run_date, series, date, value * 2 FROM m WHERE year(run_date) = 2000 AND month(run_date) <> 7
      AND series % 2 = 1""", {"m": "SELECT CAST(date_trunc('month', date) AS DATE) AS run_date, series, date, value FROM supplier_panel"}))
def k6(spark, sf):
    path = scratch(spark)
    p = supplier_panel(spark, sf).withColumn("run_date", F.trunc("date", "MM"))
    K.write_table(spark, path, MONTHLY, ["run_date"], p)
    year = p.where(F.year("run_date") == 2000)
    new = year.where((F.month("run_date") != 7) & (F.col("series") % 2 == 1)).withColumn("value", F.col("value") * 2)
    K.replace_runs(spark, path, MONTHLY, year, new)
    return K.read_table(spark, path, MONTHLY)


# ---------------------------------------------------------------- daily run


def daily_settings() -> daily.Settings:
    columns = [*TARGETS, *DRIVERS]
    return daily.Settings(
        columns=columns, watched=columns, targets=TARGETS, anchor="brent", alternates={}, model_a="regression",
        model_b="outside", mixed="mixed", ensemble="mean", logged=["regression", "outside", "mixed"], stage_names={},
        orders=ORDERS)


def _loads_sql() -> tuple[str, dict[str, str]]:
    """What two loads leave: both ranges with an anchor value, the later one in place of the
    earlier, working days only, carried forward."""
    columns = [*TARGETS, *DRIVERS]
    steps = {
        "raw": "SELECT * FROM market_wide LEFT JOIN drivers_wide USING (date)",
        "spans": "SELECT min(date) FILTER (date < DATE '2001-07-20') AS lo1, max(date) FILTER (date < DATE '2001-07-20') AS hi1, "
                 "min(date) FILTER (date >= DATE '2001-07-10') AS lo2, max(date) FILTER (date >= DATE '2001-07-10') AS hi2 "
                 "FROM raw WHERE brent IS NOT NULL",
        "loaded": "SELECT raw.* FROM raw, spans WHERE isodow(date) <= 5 AND (date BETWEEN lo1 AND hi1 OR date BETWEEN lo2 AND hi2)",
    }
    filled = ", ".join(q6(f"last_value({c} IGNORE NULLS) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING)") + f" AS {c}" for c in columns)
    return f"SELECT date, {filled} FROM loaded", steps


def _loaded_twice(spark, sf, then):
    """A first load, then a reload of the last days; ``then`` runs after each."""
    base = scratch(spark)
    t = daily.Tables(*[f"{base}/{n}" for n in ("raw", "panel", "forecasts", "history", "errors", "quality", "run_log", "ledger")])
    wide = P.left_align(market_wide(spark, sf), [drivers_wide(spark, sf)])
    for as_of, raw in ((dt.date(2001, 7, 23), wide.where("date < '2001-07-20'")),
                       (AS_OF, wide.where("date >= '2001-07-10'"))):
        out.write_panel(raw, t.raw)
        then(t, as_of)
    return t


@query("r2_loaded_panel", with_inputs(["market_wide", "drivers_wide"], *_loads_sql()))
def r2(spark, sf):
    """The stored panel after two loads."""
    s = daily_settings()
    t = _loaded_twice(spark, sf, lambda t, as_of: daily.load_panel(spark, t, s))
    return rounded(daily.stored_panel(spark, t, s), *TARGETS, *DRIVERS)


def _best_price(name: str, priority: str) -> str:
    return f"max(o_totalprice) FILTER (o_orderpriority = '{priority}') AS {name}"


LANDED_ON = dt.date(2001, 1, 6)  # the look-back holds a 31 December, the date of yearly values
LANDED = {"gold": "1-URGENT", "silver": "2-HIGH", "vix": "3-MEDIUM", "rate": "4-NOT SPECIFIED", "oil": "5-LOW"}


@query("r5_landed_panel", with_inputs([], f"""
    SELECT date AS "Date", {", ".join(LANDED)}, money_1, money_2, CAST(NULL AS DOUBLE) AS gas
    FROM days LEFT JOIN money USING (date) WHERE gold IS NOT NULL OR silver IS NOT NULL""", {
    "days": "SELECT CAST(o_orderdate AS DATE) AS date, " + ", ".join(_best_price(n, p) for n, p in LANDED.items())
            + " FROM orders WHERE o_orderdate >= DATE '2000-11-27' AND o_orderdate < DATE '2001-01-06' GROUP BY 1",
    "money": "SELECT make_date(CAST(year(o_orderdate) AS INTEGER), 12, 31) AS date, "
             "max(o_totalprice) FILTER (n_name = 'NATION_1') AS money_1, max(o_totalprice) FILTER (n_name = 'NATION_2') AS money_2 "
             "FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"}))
def r5(spark, sf):
    """Orders as landed documents, one each, of four kinds; one asked energy series never came."""
    o = table(spark, sf, "orders")
    name = F.element_at(F.create_map(*[F.lit(x) for n, p in LANDED.items() for x in (p, n)]), F.col("o_orderpriority"))
    day = F.to_date("o_orderdate")
    points = o.select(name.alias("name"), day.alias("day"), F.col("o_totalprice").alias("price"))
    result = F.struct(F.array(F.unix_seconds(F.col("day").cast("timestamp"))).alias("timestamp"),
                      F.struct(F.array(F.struct(F.array("price").alias("close"))).alias("quote")).alias("indicators"))
    charts = points.where(F.col("name").isin("gold", "silver", "vix")).select(
        "name", F.to_json(F.struct(F.struct(F.array(result).alias("result")).alias("chart"))).alias("payload"))
    data = F.array(F.struct(F.col("day").cast("string").alias("period"), F.col("price").cast("string").alias("value")))
    energy = points.where("name = 'oil'").select(
        "name", F.to_json(F.struct(F.struct(data.alias("data")).alias("response"))).alias("payload"))
    macro = points.where("name = 'rate'").select(
        F.col("name").alias("code"), F.col("day").cast("string").alias("date"), F.col("price").cast("string").alias("value"))
    best = (
        o.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.year("o_orderdate").cast("string").alias("date"), F.col("n_name").alias("countryiso3code"))
        .agg(F.max("o_totalprice").alias("value")))
    money = best.select(F.concat("countryiso3code", "date").alias("name"), F.concat(
        F.lit('[{"page": 1}, '), F.to_json(F.array(F.struct("date", "countryiso3code", "value"))), F.lit("]")).alias("payload"))
    names = landing.Names(
        {"gold": "gold", "silver": "silver"}, {"vix": "vix"}, {"rate": "rate"}, {"oil": "oil", "gas": "gas"},
        {"NATION_1": "money_1", "NATION_2": "money_2"})
    path = scratch(spark)
    landing.land(landing.Landed(charts, macro, energy, money), LANDED_ON, path, names, days=40)
    return files.read_panel(spark, path)


@query("r4_daily_run")
def r4(spark, sf):
    """Two daily runs over the market panel: a first load, then a reload of its last days.
    Returns the report view's rows."""
    s, outside = daily_settings(), current_wide(spark, sf).where("model = 'level'")
    _loaded_twice(spark, sf, lambda t, as_of: daily.run_daily(
        spark, t, as_of, dt.datetime.combine(as_of, dt.time(9)), {x: DRIVERS for x in TARGETS}, {"outside": outside}, s))
    return rounded(spark.table("report_actuals_and_forecasts"), "value")


def _blended_sql() -> tuple[str, dict[str, str]]:
    """The history's rows of the second day: the two models as they came, and both derived ones from
    the newest row of the panel that two loads leave."""
    panel, steps = _loads_sql()
    pairs = {k: v.replace("market_wide", "panel_twice") for k, v in MARKET_PAIRS.items()}
    return (f"SELECT *, DATE '{AS_OF.isoformat()}' AS run_date FROM ({CUR} UNION ALL {B4})", {**steps, "panel_twice": panel, **pairs, **MIX})


@query("r4c_daily_outside", with_inputs(["market_wide", "drivers_wide", "current_wide"], *_blended_sql()))
def r4c(spark, sf):
    """Two whole days with both models from outside and a ledger: load, take, blend, archive, log, check
    and score; the second day's archived forecasts."""
    s = dataclasses.replace(daily_settings(), model_a="trend", model_b="level", logged=["trend", "level", "mixed"])
    outside = {m: current_wide(spark, sf).where(F.col("model") == m) for m in ("trend", "level")}
    t = _loaded_twice(spark, sf, lambda t, as_of: daily.run_daily(
        spark, t, as_of, dt.datetime.combine(as_of, dt.time(9)), {}, outside, s))
    history = K.read_table(spark, t.history, S.history_schema(TARGETS)).where(F.col("run_date") == F.lit(AS_OF))
    return rounded(history, *TARGETS).select("forecast_date", "model", *TARGETS, "run_date")
