"""What the plans must look like to hold at size: pruned scans, cuts before shuffles, no
single-task or cross-product steps on data."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from pricepanel import schema as S
from pricepanel.plans import daily
from pricepanel.operators import backtest as bt, fill, panel as P, quality as Q, scoring as M
from pricepanel.sinks import tables as K
from tests.conftest import day
from workload import inputs

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def as_if_large(spark):
    """No table is small enough to broadcast unless the code says so."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"[-+ ]Exchange ", text))


def test_scan_reads_only_the_needed_columns(spark):
    text = plan(inputs.supplier_panel(spark, SF))
    assert re.search(r"ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp(_ntz)?>", text)
    assert exchanges(text) == 1 and "partial_sum" in text


def test_wide_to_long_is_one_scan(spark):
    assert plan(P.to_long(inputs.market_wide(spark, SF), inputs.TARGETS, keep_nulls=True)).count("FileScan") == 1


def test_rank_limits_cut_before_the_shuffle(spark):
    p = inputs.supplier_panel(spark, SF)
    for df in (bt.newest_rows(p, 63), bt.holdout_windows(p)):
        text = plan(df)
        partial = text.index("Partial")  # below (after) the exchange it feeds
        assert text.count("WindowGroupLimit") >= 2 and "Exchange hashpartitioning(series" in text[:partial]


def test_value_checks_never_shuffle_history(spark, tmp_path):
    path = str(tmp_path / "panel")
    inputs.supplier_panel(spark, SF).write.parquet(path)
    text = plan(Q.newest_observations(spark.read.parquet(path), 31))
    first = text.rindex("Exchange ")  # the lowest one
    assert "WindowGroupLimit [series" in text[first:] and "Partial" in text[first:]


def test_scoring_ends_without_another_shuffle(spark):
    preds = M.one_prediction(inputs.supplier_forecasts(spark, SF))
    text = plan(M.forecast_errors(preds, inputs.supplier_panel(spark, SF)))
    assert "Exchange" not in text[: text.index("SortMergeJoin")]


def test_sliced_fill_shuffles_rows_by_slice(spark):
    p = inputs.hourly_panel(spark, SF)
    text = plan(fill.forward_fill_sliced(p, F.datediff("ts", F.lit(dt.date(1970, 1, 1))), order="ts"))
    first = re.search(r"Exchange hashpartitioning\(([^)]*)\)", text).group(1)
    assert "slice" in first and "Join" not in text


def test_no_cross_products_beyond_single_rows(spark):
    wide = inputs.market_wide(spark, SF)
    text = plan(Q.all_checks(wide, inputs.TARGETS, Q.Review(dt.date(2001, 8, 6))))
    assert "CartesianProduct" not in text
    # every window is partitioned
    assert not re.search(r"Window \[[^\n]*\], \[\], ", text) and " Window [" in text


def test_slices_read_only_their_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(day(i), float(i)) for i in range(100)], "date date, a double")
    K.replace_range(spark, path, S.stored_panel_schema(["a"]), day(0), day(99), df)
    one = K.read_table(spark, path, S.stored_panel_schema(["a"])).where(F.col("month") == F.lit(dt.date(2024, 2, 1)))
    assert "PartitionFilters: [isnotnull(month" in plan(one)


def test_a_day_is_scored_from_its_partitions(spark, tmp_path):
    """History, panel and errors are read by the partitions that meet the changed dates."""
    names = ["raw", "panel", "forecasts", "history", "errors", "quality", "run_log"]
    t = daily.Tables(*[str(tmp_path / n) for n in names])
    s = daily.Settings(columns=["a"], watched=["a"], targets=["a"], anchor="a", model_a="m", model_b="n")
    panel = spark.createDataFrame([(day(i), float(i)) for i in range(300)], "date date, a double")
    K.replace_range(spark, t.panel, S.stored_panel_schema(["a"]), day(0), day(299), panel)
    for run in (40, 100, 250, 280):
        ahead = spark.createDataFrame([(day(run + i), 5.0, "m", day(run)) for i in range(10)], "forecast_date date, a double, model string, run_date date")
        K.replace_day(spark, t.history, S.history_schema(["a"]), day(run), ahead, span="forecast_date")
    daily.write_errors(spark, t, s)
    whole = sorted(map(str, K.read_table(spark, t.errors, S.ERRORS).collect()))
    assert daily.due_runs(spark, t, day(281), day(255)) == [day(250), day(280), day(281)]
    preds, actuals, stored = daily.due_rows(spark, t, s, [day(250)])
    for df, column in ((preds, "run_date"), (actuals, "month")):
        filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan(df))
        assert filters and all(column in f for f in filters), column
    assert actuals.count() == 61 and preds.count() == 10  # two months of 300 days
    assert stored.count() == 0 and "FileScan" not in plan(stored)
    _, _, stored = daily.due_rows(spark, t, s, [day(281), day(280)])
    assert stored.count() == 0
    K.replace_day(spark, t.history, S.history_schema(["a"]), day(281), ahead.withColumn("run_date", F.lit(day(281))), span="forecast_date")
    _, _, stored = daily.due_rows(spark, t, s, [day(281)])
    assert re.search(r"PartitionFilters: \[[^\]]*run_date", plan(stored)) and {r.run_date for r in stored.select("run_date").distinct().collect()} == {day(280)}
    for _ in range(2):
        daily.write_errors(spark, t, s, day(281), day(255))
        assert sorted(map(str, K.read_table(spark, t.errors, S.ERRORS).collect())) == whole  # an earlier run said the same
    # a run that is no longer in the history still counts as earlier in a rebuild
    K.replace_day(spark, t.history, S.history_schema(["a"]), day(280), ahead.where("false"), span="forecast_date")
    daily.write_errors(spark, t, s)
    assert sorted(map(str, K.read_table(spark, t.errors, S.ERRORS).collect())) == whole


def test_all_checks_read_the_table_twice_and_keep_no_history(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "panel")
    inputs.market_wide(spark, SF).repartition(3).write.parquet(path)
    table, kept = spark.read.parquet(path), []
    save = Q.saved
    monkeypatch.setattr(Q, "saved", lambda df, name: kept.append(df) or save(df, name))
    text = plan(Q.all_checks(table, inputs.TARGETS, Q.Review(dt.date(2001, 8, 6))))
    scans = lambda t: len(re.findall(r"FileScan[^\n]*" + re.escape(path), t))
    assert scans(text) == 0 and [scans(plan(df)) for df in kept] == [1, 1]
    dates, state = (plan(df) for df in kept)
    assert "ReadSchema: struct<date:date>" in dates
    first = state.rindex("Exchange ")  # rows are cut before the only shuffle of values
    assert "WindowGroupLimit [series" in state[first:]
    assert kept[1].count() <= 3 * 2 * 31 * len(inputs.TARGETS) < table.count() * len(inputs.TARGETS)


def test_forecasts_of_whole_series_go_to_as_many_tasks_as_rows_ask_for(spark, monkeypatch):
    rows = inputs.table(spark, SF, "lineitem").count()
    monkeypatch.setattr(P, "TASK_ROWS", 100)
    spark.conf.set("spark.sql.adaptive.enabled", "true")  # a few MB, which it would put into one task
    tasks = lambda df: df.select(F.spark_partition_id()).rdd.getNumPartitions()
    df = P.to_wide(inputs.supplier_forecasts(spark, SF), inputs.MODELS, ["run_date", "forecast_date", "target"], "model", "predicted")
    assert tasks(df) == -(-rows // 100)
    assert P.by_series(df.limit(0), 0, ["target"]).count() == 0


def test_repeated_forecasts_are_dropped_before_the_join_to_actuals(spark):
    preds = M.one_prediction(inputs.supplier_forecasts(spark, SF))
    text = plan(M.forecast_errors(preds, inputs.supplier_series(spark, SF)))
    assert "Aggregate" not in text[: text.index("SortMergeJoin")]  # no aggregate over all columns of an error


def test_backtest_records_of_a_series_are_made_in_one_task_of_bounded_rows(spark, monkeypatch):
    rows = inputs.table(spark, SF, "lineitem").count()
    monkeypatch.setattr(P, "TASK_ROWS", 100)
    records = inputs.backtest_records(spark, SF)
    assert records.select(F.spark_partition_id()).rdd.getNumPartitions() == -(-rows // 100)
    text = plan(M.accuracy(records))
    assert "Union" not in text and exchanges(text) == text.count("REPARTITION_BY_NUM") * 2  # only those of the panel


def test_naive_forecasts_sort_no_history(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(s, day(i), float(i)) for s in "ab" for i in range(200)], "series string, date date, value double").write.parquet(path)
    text = plan(bt.naive_last(spark.read.parquet(path)))
    # below every exchange of rows stand a rank limit or a partial aggregate
    for part in re.split(r"[-+ ]Exchange ", text)[1:]:
        below = part[: part.find("FileScan")] if "FileScan" in part else part
        assert "WindowGroupLimit" in below or "partial_" in below or "FileScan" not in part
    assert text.count("WindowGroupLimit") >= 4


def test_published_views_have_the_published_names(spark, tmp_path):
    from pricepanel import fixed_values as fv

    names = ["raw", "panel", "forecasts", "history", "errors", "quality", "run_log"]
    t = daily.Tables(*[str(tmp_path / n) for n in names])
    s = daily.Settings(columns=["a"], watched=["a"], targets=["a"], anchor="a")
    K.replace_range(spark, t.panel, S.stored_panel_schema(["a"]), day(0), day(1), spark.createDataFrame([(day(0), 1.0)], "date date, a double"))
    daily.create_views(spark, t, s)
    daily.create_published_views(spark, t, s)
    columns = lambda name: set(spark.table(f"published_{name}").columns)
    assert columns("history") == {"a", *fv.PUBLISHED_FORECAST_NAMES.values()} and columns("forecasts") == {"a", "fecha_prediccion", "modelo"}
    for name, published in (("errors", fv.PUBLISHED_ERROR_NAMES), ("quality", fv.PUBLISHED_QUALITY_NAMES), ("run_log", fv.PUBLISHED_LOG_NAMES), ("summary", fv.PUBLISHED_REPORT_NAMES)):
        assert columns(name) == set(published.values()), name
    assert spark.table("published_summary").where("RESUMEN = 'real'").count() == 4
