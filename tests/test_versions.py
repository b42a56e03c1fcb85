"""Tables as versions: what readers see when writers die, meet or are undone."""

import pytest
from pyspark.sql import functions as F

from pricepanel import schema as S
from pricepanel.sinks import manifest as M, tables as K
from tests.conftest import day, rows

PANEL = S.stored_panel_schema(["a"])
FORECASTS = S.forecast_schema(["a"])


def wide(spark, *ns, v=1.0):
    return spark.createDataFrame([(day(n), v) for n in ns], "date date, a double")


def preds(spark, model, *values):
    return spark.createDataFrame([(day(i), v, model) for i, v in enumerate(values)], "forecast_date date, a double, model string")


def read(spark, path, number=None):
    return {r.date: r.a for r in K.read_table(spark, path, PANEL, number).collect()}


def die(*_):
    raise RuntimeError("driver lost")


@pytest.mark.parametrize("step", ["publish", "write"])
def test_a_writer_that_dies_leaves_the_old_rows(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    K.replace_range(spark, path, PANEL, day(0), day(89), wide(spark, *range(90)))
    before, seen = read(spark, path), K.read_table(spark, path, PANEL)
    with monkeypatch.context() as m:
        if step == "publish":
            m.setattr(M, "publish", die)
        else:
            m.setattr(K, "_write", lambda *a: (_write(*a), die()))
        with pytest.raises(RuntimeError):
            K.replace_range(spark, path, PANEL, day(20), day(65), wide(spark, 21, v=2.0))
    assert read(spark, path) == before and K.version(spark, path) == 1
    K.replace_range(spark, path, PANEL, day(20), day(65), wide(spark, 21, v=2.0))  # just run again
    assert read(spark, path) == {d: v for d, v in before.items() if not day(20) <= d <= day(65)} | {day(21): 2.0}
    assert {r.date for r in seen.collect()} == set(before)  # a reader of the old version goes on with it
    assert read(spark, path, 1) == before


_write = K._write


def test_writers_of_other_partitions_meet(spark, tmp_path, monkeypatch):
    path, calls = str(tmp_path / "t"), []
    K.replace_model(spark, path, FORECASTS, "a", preds(spark, "a", 1.0))

    def write(*args):
        calls.append(1)
        out = _write(*args)
        if len(calls) == 1:  # another writer is first
            with monkeypatch.context() as m:
                m.setattr(K, "_write", _write)
                K.replace_model(spark, path, FORECASTS, "b", preds(spark, "b", 2.0))
        return out

    monkeypatch.setattr(K, "_write", write)
    assert K.replace_model(spark, path, FORECASTS, "a", preds(spark, "a", 3.0)) == 3
    assert len(calls) == 1  # nothing is written twice
    assert rows(K.read_table(spark, path, FORECASTS), "model") == [(day(0), 3.0, "a"), (day(0), 2.0, "b")]


def test_writers_of_one_partition_meet(spark, tmp_path, monkeypatch):
    path, calls = str(tmp_path / "t"), []
    K.replace_range(spark, path, PANEL, day(0), day(9), wide(spark, *range(10)))

    def write(*args):
        calls.append(1)
        out = _write(*args)
        if len(calls) == 1:
            with monkeypatch.context() as m:
                m.setattr(K, "_write", _write)
                K.replace_range(spark, path, PANEL, day(0), day(1), wide(spark, 0, v=5.0))
        return out

    monkeypatch.setattr(K, "_write", write)
    K.replace_range(spark, path, PANEL, day(5), day(9), wide(spark, 9, v=7.0))
    assert len(calls) == 2  # the rows that stay had changed
    assert read(spark, path) == {day(0): 5.0, **{day(n): 1.0 for n in range(2, 5)}, day(9): 7.0}


def test_a_number_is_published_once(spark, tmp_path):
    path = str(tmp_path / "t")
    one = M.NOTHING.replaced([], {("x",): "version=1/m=x"})
    M.publish(spark, path, one)
    with pytest.raises(M.Conflict):
        M.publish(spark, path, one)
    assert M.newest(spark, path) == one and M.numbers(spark, path) == [1]
    assert [p.name for p in (tmp_path / "t" / M.MANIFESTS).iterdir() if not p.name.endswith(".crc")] == ["000000000001.json"]


def test_emptied_partitions_need_no_job(spark, tmp_path):
    path = str(tmp_path / "t")
    K.write_table(spark, path, FORECASTS, ["model"], preds(spark, "a", 1.0).unionByName(preds(spark, None, 2.0)).unionByName(preds(spark, "b/ %", 3.0)))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    K.delete_models(spark, path, FORECASTS, ["a", "b/ %"])
    assert rows(K.read_table(spark, path, FORECASTS)) == [(day(0), 2.0, None)]
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - jobs < 12  # not one per partition and more
    assert [tuple(r) for r in K.partition_values(spark, path, FORECASTS, ["model"]).collect()] == [(None,)]


def test_rows_of_other_partitions_are_added(spark, tmp_path):
    path = str(tmp_path / "t")
    K.write_table(spark, path, FORECASTS, ["model"], preds(spark, "a", 1.0))
    K.replace_model(spark, path, FORECASTS, "b", preds(spark, "b", 2.0).unionByName(preds(spark, "a", 4.0)))
    assert sorted(rows(K.read_table(spark, path, FORECASTS))) == [(day(0), 1.0, "a"), (day(0), 2.0, "b"), (day(0), 4.0, "a")]


def test_old_versions_expire(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in (1.0, 2.0, 3.0):
        K.replace_model(spark, path, FORECASTS, "a", preds(spark, "a", v))
    K.replace_model(spark, path, FORECASTS, "b", preds(spark, "b", 9.0))
    preds(spark, "x", 0.0).write.parquet(f"{path}/version=running")
    folders = lambda: {p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("version=")}
    assert len(folders()) == 5
    assert len(M.expire(spark, path, keep=1)) == 2 and len(folders()) == 3
    assert sorted(r.a for r in K.read_table(spark, path, FORECASTS).collect()) == [3.0, 9.0] and M.numbers(spark, path) == [4]
    assert M.expire(spark, path, keep=1, orphan_hours=0) == ["version=running"]
    assert sorted(r.a for r in K.read_table(spark, path, FORECASTS).collect()) == [3.0, 9.0]


def test_reads_are_pruned_by_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    K.write_table(spark, path, PANEL, ["month"], wide(spark, *range(90)).withColumn("month", F.trunc("date", "MM")))
    one = K.read_table(spark, path, PANEL).where(F.col("month") == F.lit(day(31)))
    assert one.columns == [f.name for f in PANEL] and one.count() == 29
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().executedPlan().toString()


def test_spans_of_partitions(spark, tmp_path):
    path, schema = str(tmp_path / "t"), S.history_schema(["a"])
    for run, lo in ((day(0), 0), (day(1), 40), (day(2), 80)):
        new = spark.createDataFrame([(day(lo + i), 1.0, "m", run) for i in range(5)], "forecast_date date, a double, model string, run_date date")
        K.replace_day(spark, path, schema, run, new, span=None if run == day(2) else "forecast_date")
    text = lambda n: day(n).isoformat()
    got = K.partitions_meeting(spark, path, day(42))
    assert got == {(text(1),): (text(40), text(44)), (text(2),): None}  # not known: may hold any date
    assert set(K.partitions_meeting(spark, path, day(5), day(39))) == {(text(2),)}
    K.replace_day(spark, path, schema, day(1), new.where("false"), span="forecast_date")
    assert set(K.partitions_meeting(spark, path, day(0))) == {(text(0),), (text(2),)}
