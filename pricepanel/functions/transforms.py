"""Power transforms and their inverses as column expressions.

``lam`` and ``shift`` may be plain numbers or columns, so one plan can transform every
series with its own parameter.
"""

from __future__ import annotations

import math
import sys

from pyspark.sql import Column, functions as F

TINY = 1e-12
LOG_MAX = math.log(sys.float_info.max)
KINDS = ("none", "log", "boxcox", "yeojohnson")


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def _near(x: Column, target: float) -> Column:
    return F.abs(x - target) < TINY


def _guarded(base: Column) -> Column:
    return F.greatest(base, F.lit(TINY))


def _inv(x: Column) -> Column:
    """``1 / x``, NULL at zero (a plain division would fail under ANSI rules)."""
    return F.try_divide(F.lit(1.0), x)


def box_cox(y: Column, lam, shift=0.0) -> Column:
    lam = _col(lam)
    pos = _guarded(y + _col(shift))
    out = F.when(_near(lam, 0.0), F.log(pos)).otherwise(F.try_divide(F.pow(pos, lam) - 1, lam))
    return F.when(y.isNotNull(), out)


def yeo_johnson(y: Column, lam) -> Column:
    lam = _col(lam)
    k = 2 - lam
    up = F.when(_near(lam, 0.0), F.log1p(y)).otherwise(F.try_divide(F.pow(y + 1, lam) - 1, lam))
    down = F.when(_near(lam, 2.0), -F.log1p(-y)).otherwise(-F.try_divide(F.pow(1 - y, k) - 1, k))
    return F.when(y >= 0, up).when(y < 0, down)


def box_cox_inverse(t: Column, lam, shift=0.0) -> Column:
    lam = _col(lam)
    out = F.when(_near(lam, 0.0), F.exp(t)).otherwise(F.pow(lam * t + 1, _inv(lam)))
    return out - _col(shift)


def yeo_johnson_inverse(t: Column, lam) -> Column:
    """Inverse with the power base clamped to a tiny positive number."""
    lam = _col(lam)
    k = 2 - lam
    up = F.when(_near(lam, 0.0), F.expm1(t)).otherwise(
        F.pow(_guarded(lam * t + 1), _inv(lam)) - 1
    )
    down = F.when(_near(lam, 2.0), 1 - F.exp(-t)).otherwise(
        1 - F.pow(_guarded(1 - k * t), _inv(k))
    )
    return F.when(t >= 0, up).when(t < 0, down)


def yeo_johnson_inverse_clipped(t: Column, lam, eps: float = 1e-10) -> Column:
    """Inverse that first clips ``t`` to the range the forward transform can reach."""
    lam = _col(lam)
    k = 2 - lam
    hi = F.when(lam < 0, -_inv(lam) - eps)  # range is bounded above when lam < 0
    lo = F.when(k < 0, _inv(k) + eps)  # and below when lam > 2
    t_up = F.when(lam < 0, F.least(t, hi)).otherwise(t)
    t_down = F.when(k < 0, F.greatest(t, lo)).otherwise(t)
    up = F.when(_near(lam, 0.0), F.expm1(F.least(t, F.lit(LOG_MAX)))).otherwise(
        F.pow(F.greatest(lam * t_up + 1, F.lit(eps)), _inv(lam)) - 1
    )
    down = F.when(_near(k, 0.0), 1 - F.exp(F.least(-t, F.lit(LOG_MAX)))).otherwise(
        1 - F.pow(F.greatest(1 - k * t_down, F.lit(eps)), _inv(k))
    )
    return F.when(t >= 0, up).when(t < 0, down)


def forward(y: Column, kind: str | None, lam=0.0, shift=0.0) -> Column:
    kind = (kind or "none").lower()
    if kind == "none":
        return y
    if kind == "log":
        return F.when(y.isNotNull(), F.log(_guarded(y)))
    if kind == "boxcox":
        return box_cox(y, lam, shift)
    if kind == "yeojohnson":
        return yeo_johnson(y, lam)
    raise ValueError(f"unknown transform {kind!r}; use one of {KINDS}")


def inverse(t: Column, kind: str | None, lam=0.0, shift=0.0, clipped: bool = False) -> Column:
    kind = (kind or "none").lower()
    if kind == "none":
        return t
    if kind == "log":
        return F.exp(t)
    if kind == "boxcox":
        return box_cox_inverse(t, lam, shift)
    if kind == "yeojohnson":
        return yeo_johnson_inverse_clipped(t, lam) if clipped else yeo_johnson_inverse(t, lam)
    raise ValueError(f"unknown transform {kind!r}; use one of {KINDS}")
