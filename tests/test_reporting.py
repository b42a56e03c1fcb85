import datetime as dt

from pricepanel.operators import report, runlog
from tests.conftest import day, rows

AS_OF, TS = dt.date(2024, 1, 15), dt.datetime(2024, 1, 15, 9)


def forecasts(spark, **n):
    pts = [(day(i), 1.0, m) for m, k in n.items() for i in range(k)]
    return spark.createDataFrame(pts, "forecast_date date, a double, model string")


def test_run_log_statuses_and_absent_models(spark):
    from pyspark.sql import functions as F

    panel = spark.createDataFrame([(day(0),), (day(3),), (None,)], "date date")
    cur = forecasts(spark, full=10, part=4, over=12, other=1)
    hist = cur.withColumn("run_date", F.lit(AS_OF)).unionByName(
        forecasts(spark, full=10).withColumn("run_date", F.lit(day(0))))
    models = ["full", "part", "over", "gone"]
    log = runlog.run_log(panel.where("false"), panel, cur, hist, models, AS_OF, TS, names={"full": "BEST"})
    got = {r.stage: (r.status, r.n_rows, r.expected_rows) for r in log.collect()}
    assert got == {
        "RAW_EXTERNAL": ("error", 0, None), "DATA_PROC": ("ok", 2, None),
        "PRED_BEST": ("ok", 10, 10), "PRED_PART": ("warn", 4, 10), "PRED_OVER": ("warn", 12, 10),
        "HIST_BEST_HOY": ("ok", 10, 10), "HIST_PART_HOY": ("warn", 4, 10), "HIST_OVER_HOY": ("warn", 12, 10)}
    detail = {r.stage: r.detail for r in log.collect()}
    assert detail["DATA_PROC"] == "rows=2 | range=2024-01-01 to 2024-01-04" and detail["RAW_EXTERNAL"] is None
    every = runlog.run_log(panel, panel, cur, hist, models, AS_OF, TS, expect_all=True)
    zero = {r.stage: r.status for r in every.where("n_rows = 0").collect()}
    assert zero == {"PRED_GONE": "error", "HIST_GONE_HOY": "error"}


def test_views(spark):
    panel = spark.createDataFrame([(dt.date(2014, 1, 14), 1.0), (dt.date(2014, 1, 15), 2.0), (AS_OF, None),
                                   (dt.date(2024, 1, 2), 3.0)], "date date, a double")
    hist = spark.createDataFrame(
        [(day(30), 5.0, "m", day(0)), (day(31), 6.0, "m", day(1)), (day(31), None, "k", day(0)),
         (day(32), 7.0, "k", day(0)), (day(33), 8.0, "zz", day(9))],
        "forecast_date date, a double, model string, run_date date")
    got = rows(report.actuals_and_forecasts(panel, hist, ["a"], {"m": 2, "k": 3}), "date")
    assert got == [(dt.date(2014, 1, 15), "a", 2.0, "real", 1), (dt.date(2024, 1, 2), "a", 3.0, "real", 1),
                   (day(31), "a", 6.0, "m", 2), (day(32), "a", 7.0, "k", 3)]
    out = rows(report.summary(panel, hist, ["a"], ["m", "k"]), "date", "source")
    assert [(r[0], r[3], r[4], r[5]) for r in out] == [
        (dt.date(2024, 1, 2), "k", 1, "real"), (dt.date(2024, 1, 2), "m", 1, "real"),
        (day(31), "m", 2, "prediccion"), (day(32), "k", 2, "prediccion")]
