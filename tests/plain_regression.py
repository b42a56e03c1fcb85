"""The regression on whole arrays, the brute-force version of the running one."""

import numpy as np

from pricepanel.operators.features import power_transform
from pricepanel.operators.running_fit import Order


def _difference(v: np.ndarray, lag: int) -> np.ndarray:
    return v[lag:] - v[:-lag]


def _design(y: np.ndarray, e: np.ndarray, x: np.ndarray, ar: list[int], ma: list[int], start: int) -> np.ndarray:
    cols = [y[start - k: len(y) - k] for k in ar] + [e[start - k: len(y) - k] for k in ma]
    cols += [x[start:, j] for j in range(x.shape[1])]
    return np.column_stack(cols) if cols else np.zeros((len(y) - start, 0))


def fit_and_forecast(y: np.ndarray, x: np.ndarray, x_next: np.ndarray, order: Order) -> dict:
    """Forecast ``len(x_next)`` steps; ``x``/``x_next`` may have no columns.

    Returns the path and the Gaussian AIC and BIC of the regression.  Raises ``ValueError``
    where there are too few rows for the terms.  The long autoregression behind moving-average
    terms has as many lags as the longest term of the model and five more.
    """
    (p, d, q), (sp, sd, sq, s) = order
    lags = [1] * d + [s] * (sd if s else 0)
    ar = sorted({*range(1, p + 1), *(s * i for i in range(1, sp + 1) if s)})
    ma = sorted({*range(1, q + 1), *(s * i for i in range(1, sq + 1) if s)})

    levels, z = [], y
    xs = np.vstack([x, x_next])
    for lag in lags:  # covariates are differenced like the series
        levels.append(z)
        z, xs = _difference(z, lag), _difference(xs, lag)
    xz, xf = xs[: len(z)], xs[len(z):]
    keep = np.ptp(xz, axis=0) > 0 if len(xz) else np.zeros(xz.shape[1], bool)
    xz, xf = xz[:, keep], xf[:, keep]

    e = np.zeros(len(z))
    if ma:
        m = max(ma + ar) + 5
        if len(z) - m <= m + xz.shape[1]:
            raise ValueError(f"{len(z)} rows for {m} lags")
        long_ar = _design(z, e, xz, list(range(1, m + 1)), [], m)
        e[m:] = z[m:] - long_ar @ np.linalg.lstsq(long_ar, z[m:], rcond=None)[0]
        start = m + max(ma)
    else:
        start = 0
    start = max([start, *ar, *ma]) if ar or ma else start
    design = _design(z, e, xz, ar, ma, start)
    n, k = design.shape
    if n <= k + 1:
        raise ValueError(f"{n} rows for {k} terms")
    beta = np.linalg.lstsq(design, z[start:], rcond=None)[0]
    sse = float(np.sum((z[start:] - design @ beta) ** 2))
    fit = n * np.log(max(sse / n, 1e-300))

    path, shocks = list(z), list(e)
    for h in range(len(xf)):
        row = [path[-j] for j in ar] + [shocks[-j] for j in ma] + list(xf[h])
        path.append(float(np.dot(row, beta)) if row else 0.0)
        shocks.append(0.0)
    out = np.asarray(path[len(z):])
    for lag, level in zip(reversed(lags), reversed(levels)):
        full = list(level)
        for step in out:
            full.append(full[-lag] + step)
        out = np.asarray(full[len(level):])
    if not np.isfinite(out).all():
        raise ValueError("forecast is not finite")
    return {"path": out, "aic": fit + 2 * (k + 1), "bic": fit + np.log(n) * (k + 1)}


def _most_common(column: np.ndarray) -> float:
    """Most frequent number, the lowest on a tie."""
    values, times = np.unique(column, return_counts=True)
    return values[times.argmax()]


def covariates(x: np.ndarray, horizon: int, method: str, median_of: str) -> tuple[np.ndarray, np.ndarray]:
    """Covariate history without gaps, and what stands for each covariate over the horizon.

    A gap takes the newest number before it, a gap at the start the column's median (0 for a
    column without numbers).
    """
    seen = np.isfinite(x)
    newest = np.maximum.accumulate(np.where(seen, np.arange(len(x))[:, None], -1), axis=0)
    held = newest >= 0
    carried = np.take_along_axis(x, np.maximum(newest, 0), axis=0)
    known = seen if median_of == "raw" else held
    centre = np.array([np.median(carried[k, j]) if k.any() else 0.0 for j, k in enumerate(known.T)])
    past = np.where(held, carried, centre)
    row = {"median": lambda: centre, "mode": lambda: np.array([_most_common(c) for c in past.T]), "last": lambda: past[-1]}[method]()
    return past, np.tile(row, (horizon, 1))


def attempts(y, x, horizon, order, method, median_of, fallback, min_rows) -> tuple[dict, str]:
    """The model with its covariates; with ``fallback`` then without them, then the last value
    repeated, which is also all a series of fewer than ``min_rows`` rows gets."""
    none = np.zeros((len(y), 0))
    tries = [("no_covariates", none, np.zeros((horizon, 0)))]
    if x.shape[1]:
        with_x = ("covariates", *covariates(x, horizon, method, median_of))
        tries = [with_x, *tries] if fallback else [with_x]
    if fallback and len(y) < min_rows:
        tries = []
    for status, past, ahead in tries:
        try:
            return fit_and_forecast(y, past, ahead, order), status
        except (ValueError, np.linalg.LinAlgError):
            continue
    path = np.repeat(y[-1] if fallback else np.nan, horizon)
    return {"path": path, "aic": None, "bic": None}, "naive" if fallback else "failed"


def best_lambda(y: np.ndarray, kind: str, low: float = -8.0, high: float = 10.0) -> tuple[float, float]:
    """Parameter with the highest profile likelihood, and the shift that makes values positive.

    A coarse grid finds the hill, a golden-section search its top.  ``low`` and ``high`` are
    where the search starts, not limits: a side on which the likelihood still rises is moved out
    until it falls or is no longer a number.
    """
    if kind not in ("yeojohnson", "boxcox"):
        return 0.0, 0.0
    shift = 0.0
    if kind == "boxcox" and y.min() <= 0:
        shift = 1e-6 - float(y.min())
    if np.ptp(y) == 0:
        return 1.0, shift  # constant series: nothing to fit
    n = len(y)
    values, times = np.unique(y, return_counts=True)  # repeated values are transformed once
    one_sided = kind == "boxcox" or values[0] >= 0
    if one_sided:
        # over the geometric mean: the same likelihood but for a constant, and nothing overflows
        logs = np.log(np.maximum(values + shift, 1e-12)) if kind == "boxcox" else np.log1p(values)
        logs = logs - times @ logs / n
        slope = 0.0
    else:
        slope = float(times @ (np.sign(values) * np.log1p(np.abs(values))))

    def likelihood(lam: float) -> float:
        with np.errstate(all="ignore"):
            if not one_sided:
                t = power_transform(values, kind, lam, shift)
            else:
                t = logs if abs(lam) < 1e-12 else np.expm1(lam * logs) / lam
            var = float(times @ (t - times @ t / n) ** 2 / n)
        if not np.isfinite(var) or var <= 0:
            return -np.inf
        return -n / 2 * np.log(var) + (lam - 1) * slope

    while True:
        grid = np.linspace(low, high, 37)
        tries = [likelihood(x) for x in grid]
        if not np.isfinite(max(tries)):
            return 1.0, shift
        i = int(np.argmax(tries))
        if 0 < i < len(grid) - 1:
            break
        low, high = (low - (high - low), high) if i == 0 else (low, high + (high - low))
    a, b = grid[i - 1], grid[i + 1]
    ratio = (np.sqrt(5) - 1) / 2
    c, d = b - ratio * (b - a), a + ratio * (b - a)
    fc, fd = likelihood(c), likelihood(d)
    while b - a > 1e-7:
        if fc > fd:
            b, d, fd = d, c, fc
            c = b - ratio * (b - a)
            fc = likelihood(c)
        else:
            a, c, fc = c, d, fd
            d = a + ratio * (b - a)
            fd = likelihood(d)
    return float((a + b) / 2), shift
