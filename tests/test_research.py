import math

import numpy as np
import pytest

from pricepanel.operators import scoring
from pricepanel.plans import research
from pricepanel.sources.files import read_features
from tests.conftest import day

AR1, FLAT = ((1, 1, 0), (0, 0, 0, 0)), ((0, 1, 0), (0, 0, 0, 0))


def panel(spark, n=400):
    """A target whose changes carry on, a driver, its twin, and a target of a constant."""
    r = np.random.default_rng(3)
    z, y, d = 0.0, 100.0, 50.0
    out = []
    for i in range(n):
        z = 0.9 * z + r.normal(0, 0.3)
        y, d = y + z, d + r.normal()
        out.append((day(i), float(y), 5.0, float(d), float(2 * d + 1), None))
    return spark.createDataFrame(out, "date date, Up double, still double, drv double, twin double, extra string")


def test_research_chooses_before_the_held_out_dates(spark, tmp_path):
    s = research.Settings(test_rows=21, transform="none")
    wide, path = panel(spark), str(tmp_path / "features")
    got = {r.target: r for r in research.run_research(spark, wide, ["UP", "still"], ["drv", "twin"], {"up": [FLAT, AR1], "still": [FLAT]}, path, s).collect()}
    chosen = {(r.target, r.variable) for r in read_features(spark, path).collect()}
    assert {t for t, _ in chosen} == {"up", "still"} and len(chosen & {("up", "drv"), ("up", "twin")}) == 1
    assert got["up"].features == sorted(v for t, v in chosen if t == "up")

    # the naive side, by hand: windows of the last 21 business days
    days = [r for r in wide.orderBy("date").collect() if r.date.weekday() < 5]
    hold, start = days[-21:], len(days) - 21
    errors = [abs(x.Up - days[start + 7 * (i // 7) - 1].Up) for i, x in enumerate(hold)]
    assert math.isclose(got["up"].naive_last_rmse, math.sqrt(np.mean(np.square(errors))), rel_tol=1e-9)
    assert math.isclose(got["up"].naive_last_mape_pct, 100 * np.mean([e / abs(x.Up) for e, x in zip(errors, hold)]), rel_tol=1e-9)
    assert got["still"].naive_last_rmse == 0

    # what the held-out dates hold does not move the choice
    changed = wide.withColumn("Up", scoring.F.when(scoring.F.col("date") >= scoring.F.lit(hold[0].date), scoring.F.col("Up") * 7).otherwise(scoring.F.col("Up")))
    again = {r.target: r for r in research.run_research(spark, changed, ["UP", "still"], ["drv", "twin"], {"up": [FLAT, AR1], "still": [FLAT]}, str(tmp_path / "two"), s).collect()}
    assert again["up"].grid_point == got["up"].grid_point and again["up"].features == got["up"].features


def test_research_refuses_what_it_cannot_do(spark, tmp_path):
    with pytest.raises(ValueError, match="no grid for still"):
        research.run_research(spark, panel(spark, 60), ["up", "still"], [], {"up": [AR1]}, str(tmp_path / "a"))
    with pytest.raises(ValueError, match="fewer than 63 dates"):
        research.run_research(spark, panel(spark, 60), ["up"], ["drv"], {"up": [AR1]}, str(tmp_path / "b"))
