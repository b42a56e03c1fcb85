import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pricepanel import schema as S
from pricepanel.operators.blend import snapshot
from pricepanel.operators.panel import keep_last
from pricepanel.plans import daily
from pricepanel.sinks import files as out, tables as K
from pricepanel.sources import files, payloads
from tests.conftest import day, rows

FORECASTS = S.forecast_schema(["a"])


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def preds(spark, model, *values, start=0):
    return spark.createDataFrame([(day(start + i), v, model) for i, v in enumerate(values)],
                                 "forecast_date date, a double, model string")


def test_replace_model_first_write_rerun_and_empty(spark, path):
    for _ in range(2):  # a rerun changes nothing
        K.replace_model(spark, path, FORECASTS, "m 1/x", preds(spark, "m 1/x", 1.0, 2.0))
        K.replace_model(spark, path, FORECASTS, "2001", preds(spark, "2001", 9.0))
    read = lambda: rows(K.read_table(spark, path, FORECASTS), "model", "forecast_date")
    assert read() == [(day(0), 9.0, "2001"), (day(0), 1.0, "m 1/x"), (day(1), 2.0, "m 1/x")]
    K.replace_model(spark, path, FORECASTS, "m 1/x", preds(spark, "m 1/x").where("false"))
    assert read() == [(day(0), 9.0, "2001")]
    K.delete_models(spark, path, FORECASTS, ["2001", "gone"])
    assert read() == []
    K.replace_model(spark, path, FORECASTS, "z", preds(spark, "z", 3.0))
    assert read() == [(day(0), 3.0, "z")]


def test_read_of_a_table_never_written(spark, path):
    assert K.read_table(spark, path, FORECASTS).count() == 0


PANEL = S.stored_panel_schema(["a"])


def test_replace_range_removes_what_the_load_does_not_bring(spark, path):
    def wide(*ns, v=1.0):
        return spark.createDataFrame([(day(n), v) for n in ns], "date date, a double")

    K.replace_range(spark, path, PANEL, day(0), day(100), wide(*range(0, 100)))
    K.replace_range(spark, path, PANEL, day(20), day(65), wide(20, 61, v=2.0))
    got = {r.date: r.a for r in K.read_table(spark, path, PANEL).collect()}
    want = {day(n): 1.0 for n in range(100) if not 20 <= n <= 65} | {day(20): 2.0, day(61): 2.0}
    assert got == want  # February has no row any more
    K.replace_range(spark, path, PANEL, None, None, wide(1))
    assert K.read_table(spark, path, PANEL).count() == len(want)
    K.replace_range(spark, path, PANEL, day(0), day(100), wide(1).where("false"))
    assert K.read_table(spark, path, PANEL).count() == 0


def test_only_touched_partitions_are_rewritten(spark, path):
    wide = spark.createDataFrame([(day(n), 1.0) for n in range(90)], "date date, a double")
    K.replace_range(spark, path, PANEL, day(0), day(89), wide)
    before = set(K.read_table(spark, path, PANEL).inputFiles())
    K.replace_range(spark, path, PANEL, day(32), day(33), wide.where("false"))
    after = set(K.read_table(spark, path, PANEL).inputFiles())
    assert len(before - after) == 1 and len(after - before) == 1


def test_replace_day_review_and_runs(spark, tmp_path):
    hist = S.history_schema(["a"])
    p = str(tmp_path / "h")
    for d in (day(0), day(1), day(1)):
        K.replace_day(spark, p, hist, d, snapshot(preds(spark, "m", 1.0, 2.0), d))
    assert K.read_table(spark, p, hist).count() == 4
    runs = spark.createDataFrame([(day(0),), (day(1),), (day(7),)], "run_date date")
    K.replace_runs(spark, p, hist, runs, snapshot(preds(spark, "m", 5.0), day(1)))
    assert rows(K.read_table(spark, p, hist)) == [(day(0), 5.0, "m", day(1))]

    q = str(tmp_path / "q")
    fact = spark.createDataFrame([(day(0), "t"), (day(0), "u"), (day(1), "t")], "review_date date, table_name string")
    full = fact.select(*[F.col(f.name) if f.name in fact.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in S.QUALITY])
    for d, t in ((day(0), "t"), (day(0), "u"), (day(1), "t")):
        K.replace_review(spark, q, S.QUALITY, d, t, full.where((F.col("review_date") == F.lit(d)) & (F.col("table_name") == t)))
    K.replace_review(spark, q, S.QUALITY, day(0), "t", full.where("false"))
    assert rows(K.read_table(spark, q, S.QUALITY).select("review_date", "table_name"), "review_date") == [
        (day(0), "u"), (day(1), "t")]


# ---------------------------------------------------------------- sources


def chart(ts, close):
    return json.dumps({"chart": {"result": [{"timestamp": ts, "indicators": {"quote": [{"close": close}]}}]}})


def test_charts_from_landed_files(spark, tmp_path):
    base = 1704110400  # 2024-01-01 12:00 UTC
    d = 86400
    docs = {"GC=F": chart([base, base + 60, base + d, base + 2 * d, base + 3 * d], [1.0, 2.0, None, 3.0, 9.0]),
            "^VIX": json.dumps({"chart": {"result": []}}), "a+b %41": "no json", "NG=F": chart([], [])}
    for name, text in docs.items():
        (tmp_path / f"{name}.json").write_text(text)
    landed = payloads.read_payloads(spark, str(tmp_path))
    assert {r.name for r in landed.collect()} == set(docs)
    got = payloads.parse_charts(landed, {"GC=F": "oro", "^VIX": "vix", "NG=F": "gas"}, day(3))
    assert rows(got, "date") == [("oro", day(0), 2.0), ("oro", day(2), 3.0)]
    assert payloads.lookback(got, day(3), 2).count() == 1


def test_energy_periods(spark):
    doc = json.dumps({"response": {"data": [
        {"period": "2024-01-05", "value": "7"}, {"period": "2024-02", "value": 8.5}, {"period": "x", "value": "1"},
        {"period": "2024-01-05", "value": "9"}]}})
    landed = spark.createDataFrame([("P", doc), ("Q", json.dumps({"error": 1}))], "name string, payload string")
    assert rows(payloads.parse_energy(landed, {"P": "oil", "Q": "gas"}), "date") == [
        ("oil", day(4), 9.0), ("oil", dt.date(2024, 2, 1), 8.5)]


def test_country_years_take_the_first_value(spark):
    doc = json.dumps([{"page": 1}, [
        {"date": "2020", "countryiso3code": "usa", "value": None}, {"date": "2020", "countryiso3code": "USA", "value": 5},
        {"date": "2020", "countryiso3code": "USA", "value": 6}, {"date": "x", "countryiso3code": "USA", "value": 1},
        {"date": "2021", "countryiso3code": "CHN", "value": 2.5}, {"date": "2021", "countryiso3code": "", "value": 1}]])
    landed = spark.createDataFrame([("wb", doc)], "name string, payload string")
    got = payloads.parse_country_years(landed, {"CHN": "china", "USA": "eeuu"})
    assert got.columns == ["date", "china", "eeuu"]
    assert rows(got, "date") == [(dt.date(2020, 12, 31), None, 5.0), (dt.date(2021, 12, 31), 2.5, None)]


def test_named_series(spark):
    landed = spark.createDataFrame([("D", "2024-01-02", "1"), ("D", "2023-01-02", "1"), ("E", "2024-01-02", "1"),
                                    ("D", "2024-01-03", ".")], "code string, date string, value string")
    assert rows(payloads.named_series(landed, {"D": "rate"}, day(0)), "date") == [
        ("rate", day(1), 1.0), ("rate", day(2), None)]


def test_features_file_keeps_order_and_flags(spark, tmp_path):
    f = tmp_path / "f.csv"
    f.write_text(" Commodity ,Variable,USADA\n Oro,ZZ ,1\noro, aa,1\noro,off,0\noro,none,\nplata,q,1.0\n,x,1\n")
    got = rows(files.feature_lists(files.read_features(spark, str(f))), "target")
    assert got == [("oro", ["zz", "aa"]), ("plata", ["q"])]
    g = tmp_path / "g.csv"
    g.write_text("commodity,variable\noro,b\noro,a\n")
    assert rows(files.feature_lists(files.read_features(spark, str(g)))) == [("oro", ["b", "a"])]
    (tmp_path / "h.csv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError):
        files.read_features(spark, str(tmp_path / "h.csv"))


def test_melted_features_and_csv_round_trip(spark, tmp_path):
    wide = spark.createDataFrame([("Oro ", "b", "a"), ("plata", None, "c")], "asset string, v1 string, v2 string")
    long = files.melt_features(wide)
    assert rows(files.feature_lists(long), "target") == [("oro", ["b", "a"]), ("plata", ["c"])]
    with pytest.raises(ValueError):
        files.melt_features(wide.drop("asset"))
    out.write_features(long, str(tmp_path / "o"))
    assert spark.read.csv(str(tmp_path / "o"), header=True).count() == 3


def test_model_panel_and_panel_file(spark, path):
    raw = spark.createDataFrame(
        [("2024-01-01", "1"), ("2024-01-01", "3"), ("2024-01-06", "5"), ("bad", "7"), ("2024-01-02", "NaN")],
        "Date string, GOLD string")
    assert rows(files.model_panel(raw), "date") == [(day(0), 3.0), (day(1), None)]
    with pytest.raises(ValueError):
        files.model_panel(raw.drop("Date"))
    out.write_panel(raw, path, date="Date")
    assert files.read_panel(spark, path).dtypes[0] == ("Date", "date") and files.read_panel(spark, path).count() == 4


# ---------------------------------------------------------------- daily run


def test_daily_run_twice_leaves_the_same_tables(spark, tmp_path):
    names = ["raw", "panel", "forecasts", "history", "errors", "quality", "run_log"]
    t = daily.Tables(*[str(tmp_path / n) for n in names])
    s = daily.Settings(columns=["Brent", "gold", "vix"], watched=["Brent", "gold", "vix"], targets=["Brent", "gold"],
                       anchor="Brent", alternates={"vix": "v-i-x"}, model_a="reg", model_b="ext", mixed="mix",
                       ensemble="mean", logged=["reg", "ext", "mix"], stage_names={}, orders={"Brent": ((1, 1, 1), (0, 0, 0, 0))})
    import math

    def raw(lo, hi):
        pts = [(day(i), 50 + 10 * math.sin(i / 5) + i % 3, None if i % 4 else 100.0 + i, float(i % 7)) for i in range(lo, hi)]
        out.write_panel(spark.createDataFrame(pts, "Date date, BRENT double, gold double, `v-i-x` double"), t.raw, date="Date")

    def run(as_of, ext_from):
        ahead = [d for d in (day(ext_from + i) for i in range(14)) if d.weekday() < 5][:10]
        ext = spark.createDataFrame([(d, 55.0 + i, 120.0) for i, d in enumerate(ahead)],
                                    "forecast_date date, Brent double, gold double")
        daily.run_daily(spark, t, as_of, dt.datetime.combine(as_of, dt.time(9)), {"Brent": ["VIX", "gold"], "gold": []},
                        {"ext": ext}, s)

    raw(0, 90)
    run(day(91), 91)
    assert K.read_table(spark, t.panel, S.stored_panel_schema(s.columns)).where("dayofweek(date) IN (1, 7)").count() == 0
    raw(85, 105)
    tables = {"panel": S.stored_panel_schema(s.columns), "forecasts": S.forecast_schema(s.targets),
              "history": S.history_schema(s.targets), "errors": S.ERRORS, "quality": S.QUALITY, "run_log": S.RUN_LOG}
    seen = []
    for _ in range(2):
        run(day(106), 105)
        seen.append({n: sorted(map(str, K.read_table(spark, getattr(t, n), sch).collect())) for n, sch in tables.items()})
    assert seen[0] == seen[1]
    panel = K.read_table(spark, t.panel, tables["panel"])
    assert panel.where("gold IS NULL").count() == 0 and panel.count() == panel.select("date").distinct().count() == 75
    assert {r.model: r["count"] for r in K.read_table(spark, t.forecasts, tables["forecasts"]).groupBy("model").count().collect()} == {
        "reg": 10, "ext": 10, "mix": 10, "mean": 10}
    # scoring a day at a time ends in the table a full rebuild gives
    daily.write_errors(spark, t, s)
    assert sorted(map(str, K.read_table(spark, t.errors, S.ERRORS).collect())) == seen[1]["errors"]
    # the first run's forecasts meet the actuals of the reload, each target and model
    errors = K.read_table(spark, t.errors, S.ERRORS)
    assert errors.where(F.col("run_date") == F.lit(day(91))).select("model", "target").distinct().count() == 8
    assert K.read_table(spark, t.run_log, S.RUN_LOG).where("status <> 'ok'").count() == 0
    assert spark.table("report_summary").where("kind = 'prediccion'").count() == 80
    # a value that is no number counts as none; a target that cannot be forecast stops the run
    before = sorted(map(str, K.read_table(spark, t.forecasts, tables["forecasts"]).collect()))
    out.write_panel(spark.createDataFrame(
        [(day(105), 50.0, float("nan"), 1.0), (day(106), 51.0, None, 2.0)], "Date date, BRENT double, gold double, `v-i-x` double"),
        t.raw, date="Date")
    daily.load_panel(spark, t, s)
    last = K.read_table(spark, t.panel, tables["panel"]).orderBy("date").collect()[-3:]
    assert [r["date"] for r in last[1:]] == [day(105), day(106)]
    assert len({r["gold"] for r in last}) == 1 and not any(r["gold"] != r["gold"] for r in last)
    short = daily.Settings(**{**s.__dict__, "orders": {"Brent": ((200, 1, 0), (0, 0, 0, 0))}})
    with pytest.raises(ValueError, match=r"brent \(failed\)"):
        daily.forecast_model(spark, t, short, {})
    assert sorted(map(str, K.read_table(spark, t.forecasts, tables["forecasts"]).collect())) == before
