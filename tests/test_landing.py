import datetime as dt
import json

import pytest

from pricepanel.plans import landing
from pricepanel.sources.files import read_panel

AS_OF = dt.date(2024, 1, 4)


def chart(points):
    stamps = [int(dt.datetime.combine(d, dt.time(12), dt.timezone.utc).timestamp()) for d, _ in points]
    return json.dumps({"chart": {"result": [{"timestamp": stamps, "indicators": {"quote": [{"close": [v for _, v in points]}]}}]}})


def put(folder, documents):
    folder.mkdir()
    for name, text in documents.items():
        (folder / name).write_text(text)
    return str(folder)


def folders(base):
    dec30, jan2, jan3 = dt.date(2023, 12, 30), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    charts = put(base / "charts", {
        "GC=F.json": chart([(dt.date(2023, 12, 1), 9.0), (dt.date(2023, 12, 31), 1.0), (jan2, 2.0), (AS_OF, 5.0)]),
        "SI=F.json": chart([(jan3, 3.0)]),
        "^VIX.json": chart([(dec30, 7.0), (jan2, 8.0)]),
        "unknown.json": chart([(jan2, 1.0)]),
    })
    macro = put(base / "macro", {"a.csv": "code,date,value\nDGS10,2024-01-02,4.5\nDGS10,2024-01-03,.\nOTHER,2024-01-02,1\n"})
    energy = put(base / "energy", {"NG.N9070US2.M.json": json.dumps({"response": {"data": [{"period": "2024-01", "value": "6"}]}})})
    money = put(base / "money", {"p.json": json.dumps([{}, [{"date": "2023", "countryiso3code": "USA", "value": 11.0}]])})
    return charts, macro, energy, money


def test_documents_become_the_raw_panel(spark, tmp_path):
    landed = landing.read_landed(spark, *folders(tmp_path))
    path = str(tmp_path / "raw")
    landing.land(landed, AS_OF, path)
    panel = read_panel(spark, path)
    got = {r["Date"]: r for r in panel.collect()}
    # the targets' dates of the look-back, without the running day
    assert sorted(got) == [dt.date(2023, 12, 31), dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    first, second, third = (got[d] for d in sorted(got))
    assert (first.oro, first.vix, first.tasa_10y) == (1.0, None, None)
    assert first["DINERO_CIRCULANTE_EEUU_M2_APROX_LCU"] == 11.0
    assert (second.oro, second.plata, second.vix, second.tasa_10y) == (2.0, None, 8.0, 4.5)
    assert (third.oro, third.plata, third.vix, third.tasa_10y) == (None, 3.0, None, None)
    n = landing.Names()
    asked = [c for m in (n.targets, n.charts, n.macro, n.energy, n.money) for c in m.values()]
    assert sorted(panel.columns) == sorted({"Date", *asked})


def test_sources_that_brought_nothing_are_columns_of_nulls(spark, tmp_path):
    landed = landing.read_landed(spark, folders(tmp_path)[0])
    panel = landing.raw_panel(landed, AS_OF)
    assert panel.where("tasa_10y IS NOT NULL OR produccion_gas_usa IS NOT NULL").count() == 0 and panel.count() == 3


def test_nothing_is_written_without_target_prices(spark, tmp_path):
    landed = landing.read_landed(spark, folders(tmp_path)[0])
    path = str(tmp_path / "raw")
    landing.land(landed, AS_OF, path)
    with pytest.raises(ValueError):
        landing.land(landed, dt.date(2025, 1, 1), path)
    assert read_panel(spark, path).count() == 3
