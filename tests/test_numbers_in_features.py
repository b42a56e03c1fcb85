"""Numbers that are none, and covariates with gaps."""

import numpy as np

from pricepanel.operators import features
from pricepanel.operators.running_fit import Covariates


def _covariates(x, horizon, method, median_of):
    c = Covariates(x.shape[1], method, median_of)
    columns = np.split(c.columns(x), 2, axis=1)
    centre = c.centre()
    return columns[0] + columns[1] * centre, c.next(centre, horizon)


def test_pair_sums_leave_out_what_is_no_number(spark):
    rows = [(float(i), float(i * i % 7), 1.0) for i in range(50)] + [(float("inf"), 1.0, 1.0), (1.0, float("nan"), 1.0)]
    got = {(r.a, r.b): r for r in features.pair_sums(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    assert got["a", "b"].n == 50 and got["a", "c"].n == 51
    x = np.array(rows[:50])
    r = got["a", "b"]
    want = np.corrcoef(x[:, 0], x[:, 1])[0, 1]
    cov, va, vb = r.sab - r.sa * r.sb / r.n, r.saa - r.sa**2 / r.n, r.sbb - r.sb**2 / r.n
    assert abs(cov / np.sqrt(va * vb) - want) < 1e-9


def test_covariates_are_filled_and_continued():
    x = np.array([[np.nan, 1.0, np.nan], [2.0, np.inf, np.nan], [np.nan, 3.0, np.nan], [4.0, 3.0, np.nan]])
    past, ahead = _covariates(x, 2, "last", "raw")
    assert past.tolist() == [[3.0, 1.0, 0.0], [2.0, 1.0, 0.0], [2.0, 3.0, 0.0], [4.0, 3.0, 0.0]] and ahead.tolist() == [[4.0, 3.0, 0.0]] * 2
    assert _covariates(x, 1, "median", "filled")[1].tolist() == [[2.0, 2.0, 0.0]]
    assert _covariates(x, 1, "mode", "raw")[1].tolist() == [[2.0, 1.0, 0.0]]
