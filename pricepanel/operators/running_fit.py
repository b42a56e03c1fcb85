"""A regression on lagged differences from running sums of products.

The model is least squares on differenced values with autoregressive, seasonal, covariate and
moving-average terms; the last use the residuals of a long autoregression (the two-stage method of
Hannan and Rissanen).  Residuals are linear in lagged values and covariates, so everything the
fit needs is one matrix of sums of products of those (two with moving-average terms), which grows
with the terms and not with the rows.  A series is read once, in pieces of any size; the fit can
be asked for after any of them, which is what a backtest does at the start of each window.

A covariate's rows before its first number count with the median of the numbers seen so far, which
is only known when the fit is asked for.  Each covariate therefore has two columns, its numbers
with 0 in that gap, and 1 in the gap: what stands in the gap is their linear combination.

Columns are scaled before the normal equations are solved; directions of less than ``RANK`` of
the largest are left out.
"""

from __future__ import annotations

import numpy as np

# (p, d, q), (P, D, Q, s)
Order = tuple[tuple[int, int, int], tuple[int, int, int, int]]
RANK = 1e-11


def difference(v: np.ndarray, lags: list[int]) -> np.ndarray:
    for lag in lags:
        v = v[lag:] - v[:-lag] if lag < len(v) else v[:0]
    return v


def solve(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least squares from sums of products."""
    scale = np.sqrt(np.maximum(np.diag(gram), 1e-300))
    value, vector = np.linalg.eigh(gram / np.outer(scale, scale))
    good = value > RANK * max(1.0, value[-1]) if len(value) else value > 0
    v = vector[:, good]
    return (v @ ((v.T @ (right / scale)) / value[good])) / scale


class Terms:
    """Lags of a model and where its rows begin."""

    def __init__(self, order: Order):
        (p, d, q), (sp, sd, sq, s) = order
        self.diffs = [1] * d + [s] * (sd if s else 0)
        self.ar = sorted({*range(1, p + 1), *(s * i for i in range(1, sp + 1) if s)})
        self.ma = sorted({*range(1, q + 1), *(s * i for i in range(1, sq + 1) if s)})
        self.lost = sum(self.diffs)
        #: lags of the long autoregression
        self.long = max(self.ma + self.ar) + 5 if self.ma else 0
        reach = max(self.ma, default=0)
        self.start = self.long + reach if self.ma else max(self.ar, default=0)
        self.z_lags = self.long + reach if self.ma else max(self.ar, default=0)
        self.x_lags = reach
        #: rows before a piece that its own rows look back on
        self.context = self.lost + max(self.z_lags, self.x_lags)


class RunningFit:
    """Sums of one series for one model.  ``width`` covariates have ``2 * width`` columns."""

    def __init__(self, order: Order, width: int):
        self.terms, self.width = Terms(order), width
        t = self.terms
        # columns: value and its lags, then the covariates' columns for lag 0, 1, ...
        k = 1 + t.z_lags + 2 * width * (t.x_lags + 1)
        self.gram = np.zeros((k, k))
        self.first = np.zeros((1 + t.long + 2 * width,) * 2)  # of the long autoregression
        self.rows = 0
        self.low, self.high = np.full(2 * width, np.inf), np.full(2 * width, -np.inf)

    def add(self, y: np.ndarray, x: np.ndarray, old: int) -> None:
        """More rows: transformed values and covariate columns, after ``old`` rows that were
        added before (at least ``terms.context`` of them, or all)."""
        t = self.terms
        z, xz = difference(y, t.diffs), difference(x, t.diffs)
        before = self.rows
        self.rows += len(y) - old
        if not len(z):
            return
        at = np.arange(len(z)) + before - old  # place of each difference in the series
        new = at + t.lost >= before
        if self.width and new.any():
            self.low, self.high = np.minimum(self.low, xz[new].min(0)), np.maximum(self.high, xz[new].max(0))

        def shifted(v: np.ndarray, k: int, pick: np.ndarray) -> np.ndarray:
            return v[pick - k]

        pick = np.flatnonzero(new & (at >= t.start))
        if len(pick):
            u = np.column_stack([*(shifted(z, k, pick) for k in range(t.z_lags + 1)), *(shifted(xz, k, pick) for k in range(t.x_lags + 1))])
            self.gram += u.T @ u
        if t.ma:
            pick = np.flatnonzero(new & (at >= t.long))
            if len(pick):
                u = np.column_stack([*(shifted(z, k, pick) for k in range(t.long + 1)), xz[pick]])
                self.first += u.T @ u

    def forecast(self, y: np.ndarray, x: np.ndarray, gap_value: np.ndarray, ahead: np.ndarray, covariates: bool = True) -> dict:
        """Path of ``len(ahead)`` steps and the Gaussian AIC and BIC.

        ``y``, ``x``: the newest ``terms.context + 1`` rows (or all); ``gap_value``: what stands in
        each covariate's gap; ``ahead``: covariates over the horizon.  Raises ``ValueError`` where
        there are too few rows for the terms.
        """
        t, w = self.terms, self.width
        n = self.rows - t.lost
        moves = (self.low < self.high)[:w] | (self.low < self.high)[w:]
        keep = np.flatnonzero(moves) if covariates and n > 0 else np.empty(0, int)
        kx = len(keep)

        def mixed(first: int, lags: int) -> np.ndarray:
            """From columns as summed to values, lags and covariates of the model."""
            out = np.zeros((first + 2 * w * lags, first + kx * lags))
            out[:first, :first] = np.eye(first)
            for k in range(lags):
                for c, j in enumerate(keep):
                    out[first + 2 * w * k + j, first + kx * k + c] = 1
                    out[first + 2 * w * k + w + j, first + kx * k + c] = gap_value[j]
            return out

        b = mixed(1 + t.z_lags, t.x_lags + 1)
        gram = b.T @ self.gram @ b
        past = x[:, :w] + x[:, w:] * gap_value if w else x[:, :0]
        z = difference(y, t.diffs)
        xs = difference(np.vstack([past, ahead]) if w else np.zeros((len(past) + len(ahead), 0)), t.diffs)[:, keep]
        xz, xf = xs[:len(xs) - len(ahead)], xs[len(xs) - len(ahead):]
        size = gram.shape[0]
        unit = np.eye(size)
        columns = [unit[k] for k in t.ar]
        e = np.zeros(len(z))
        if t.ma:
            if n - t.long <= t.long + kx:
                raise ValueError(f"{n} rows for {t.long} lags")
            b = mixed(1 + t.long, 1)
            long = b.T @ self.first @ b
            beta = solve(long[1:, 1:], long[1:, 0])
            for k in t.ma:  # a lagged residual in terms of lagged values and covariates
                r = np.zeros(size)
                r[k] = 1
                r[k + 1:k + 1 + t.long] -= beta[:t.long]
                r[1 + t.z_lags + kx * k:1 + t.z_lags + kx * (k + 1)] -= beta[t.long:]
                columns.append(r)
            for i in range(max(t.long, len(z) - max(t.ma)), len(z)):
                e[i] = z[i] - z[i - t.long:i][::-1] @ beta[:t.long] - xz[i] @ beta[t.long:]
        columns += [unit[1 + t.z_lags + j] for j in range(kx)]
        m = np.array(columns).reshape(len(columns), size)
        rows, k = n - t.start, len(columns)
        if rows <= k + 1:
            raise ValueError(f"{rows} rows for {k} terms")
        inner, right = m @ gram @ m.T, m @ gram[:, 0]
        beta = solve(inner, right)
        sse = max(0.0, float(gram[0, 0] - 2 * beta @ right + beta @ inner @ beta))
        fit = rows * np.log(max(sse / rows, 1e-300))

        path, shocks = list(z), list(e)
        for step in xf if kx else np.zeros((len(ahead), 0)):
            row = [path[-j] for j in t.ar] + [shocks[-j] for j in t.ma] + list(step)
            path.append(float(np.dot(row, beta)) if row else 0.0)
            shocks.append(0.0)
        out = np.asarray(path[len(z):])
        levels, v = [], y
        for lag in t.diffs:
            levels.append(v)
            v = v[lag:] - v[:-lag]
        for lag, level in zip(reversed(t.diffs), reversed(levels)):
            full = list(level)
            for step in out:
                full.append(full[-lag] + step)
            out = np.asarray(full[len(level):])
        if not np.isfinite(out).all():
            raise ValueError("forecast is not finite")
        return {"path": out, "aic": fit + 2 * (k + 1), "bic": fit + np.log(rows) * (k + 1)}


class Covariates:
    """Gap-free covariates of a series read in pieces: the newest number carried on, and what
    stands for the gap at the start and for the days ahead.

    Values are kept only where a median or mode will be asked of them: with another method than
    ``last``, or where a covariate lacks the first row.
    """

    def __init__(self, width: int, method: str, median_of: str):
        self.width, self.method, self.median_of = width, method, median_of
        self.newest = np.full(width, np.nan)
        self.keep: bool | None = None
        self.raw: list[np.ndarray] = []
        self.filled: list[np.ndarray] = []

    def columns(self, x: np.ndarray) -> np.ndarray:
        """Two columns for each covariate: numbers, 0 in the gap; 1 in the gap."""
        x = np.where(np.isfinite(x), x, np.nan)
        full = np.vstack([self.newest, x])
        place = np.maximum.accumulate(np.where(np.isnan(full), 0, np.arange(len(full))[:, None]), axis=0)
        carried = np.take_along_axis(full, place, axis=0)[1:]
        if len(x):
            self.newest = carried[-1]
            if self.keep is None:
                self.keep = self.method != "last" or bool(np.isnan(x[0]).any())
            if self.keep:
                if self.median_of == "raw":
                    self.raw.append(x)
                if self.median_of != "raw" or self.method == "mode":
                    self.filled.append(carried)
        gap = np.isnan(carried)
        return np.hstack([np.where(gap, 0.0, carried), gap.astype(float)])

    def centre(self) -> np.ndarray:
        """Median of each covariate's numbers, 0 where it has none."""
        out = np.zeros(self.width)
        held = self.raw if self.median_of == "raw" else self.filled
        if held and self.width:
            every = np.vstack(held)
            for j in range(self.width):
                v = every[~np.isnan(every[:, j]), j]
                if len(v):
                    out[j] = np.median(v)
        return out

    def next(self, centre: np.ndarray, horizon: int) -> np.ndarray:
        if self.method == "median":
            row = centre
        elif self.method == "last":
            row = np.where(np.isnan(self.newest), centre, self.newest)
        else:  # the most frequent number, the lowest on a tie, the gap included
            row = np.empty(self.width)
            every = np.vstack(self.filled)
            for j in range(self.width):
                values, times = np.unique(np.where(np.isnan(every[:, j]), centre[j], every[:, j]), return_counts=True)
                row[j] = values[times.argmax()]
        return np.tile(row, (horizon, 1))
