"""A day that dies after each of its steps, and goes on."""

import datetime as dt

import pytest

from pricepanel import schema as S
from pricepanel.plans import daily, ledger as L
from pricepanel.sinks import files as out, manifest as M, tables as K
from tests.conftest import day

NAMES = ["panel", "forecasts", "history", "errors", "quality", "run_log"]


class Died(Exception):
    pass


def test_a_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    s = daily.Settings(columns=["a", "b"], watched=["a"], targets=["a"], anchor="a", alternates={}, model_a="x", model_b="y", mixed="mix", ensemble="mean",
                       logged=["x", "y"], stage_names={})
    schemas = {"panel": S.stored_panel_schema(s.columns), "forecasts": S.forecast_schema(s.targets), "history": S.history_schema(s.targets),
               "errors": S.ERRORS, "quality": S.QUALITY, "run_log": S.RUN_LOG}
    run_ts = dt.datetime(2024, 3, 1, 9)
    outside = {m: spark.createDataFrame([(day(58 + i), 50.0 + i + k) for i in range(4)], "forecast_date date, a double") for k, m in enumerate("xy")}

    def tables(name, ledger=True):
        t = daily.Tables(*[str(tmp_path / name / n) for n in ["raw", *NAMES]], ledger=str(tmp_path / name / "ledger") if ledger else None)
        out.write_panel(spark.createDataFrame([(day(i), 40.0 + i % 9, 1.0) for i in range(60)], "Date date, a double, b double"), t.raw, date="Date")
        return t

    def read(t):
        return {n: sorted(map(str, K.read_table(spark, getattr(t, n), sch).collect())) for n, sch in schemas.items()}

    plain, broken = tables("plain", ledger=False), tables("broken")
    daily.run_daily(spark, plain, day(60), run_ts, {}, outside, s)
    put, deaths = M.put_text, 0

    def put_and_die(spark_, path, text):
        put(spark_, path, text)
        if "/ledger/" in path:
            raise Died

    monkeypatch.setattr(M, "put_text", put_and_die)
    for _ in range(20):
        try:
            daily.run_daily(spark, broken, day(60), run_ts, {}, outside, s)
            break
        except Died:
            deaths += 1
    assert deaths == 7 and read(broken) == read(plain)
    found = {r.step: r for r in L.records(spark, broken.ledger).collect()}
    assert [found[x].place for x in ("load", "take x", "take y", "blend", "log", "quality", "errors")] == list(range(1, 8))
    assert found["blend"].read == {"panel": 1, "forecasts": 2} and found["blend"].wrote["history"] == 1
    # nothing was done twice: each step wrote its versions once
    assert {n: K.version(spark, getattr(broken, n)) for n in NAMES} == {n: K.version(spark, getattr(plain, n)) for n in NAMES}
    daily.run_daily(spark, broken, day(60), run_ts, {}, outside, s)  # all recorded: no step runs
    assert {n: K.version(spark, getattr(broken, n)) for n in NAMES} == {n: K.version(spark, getattr(plain, n)) for n in NAMES}
    with pytest.raises(ValueError, match="step 2"):
        daily.run_daily(spark, broken, day(60), run_ts, {}, {**outside, "other": outside["x"]}, s)
