"""Statistics from sums: Pearson r and least-squares line.

Both are computed from the one-row moment sums (n, Σx, Σy, Σx², Σy², Σxy), so
the heavy part is a single partial+final aggregate. Division uses
``try_divide``: zero variance gives NULL instead of a DIVIDE_BY_ZERO error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment_sums(x: str | Column, y: str | Column) -> list[Column]:
    """Aggregate expressions n, sx, sy, sxx, syy, sxy (doubles, so Σx² cannot overflow)."""
    xd, yd = _c(x).cast("double"), _c(y).cast("double")
    both = xd.isNotNull() & yd.isNotNull()
    xv = F.when(both, xd)
    yv = F.when(both, yd)
    return [
        F.count(xv).alias("n"),
        F.sum(xv).alias("sx"),
        F.sum(yv).alias("sy"),
        F.sum(xv * xv).alias("sxx"),
        F.sum(yv * yv).alias("syy"),
        F.sum(xv * yv).alias("sxy"),
    ]


def pearson(x: str | Column, y: str | Column) -> Column:
    """Aggregate r = covariance / (σx · σy) over complete pairs, from mergeable central moments.

    Large values don't cancel as they do in raw moment sums; zero variance gives NULL.
    """
    xd, yd = _c(x).cast("double"), _c(y).cast("double")
    both = xd.isNotNull() & yd.isNotNull()
    xv, yv = F.when(both, xd), F.when(both, yd)
    return F.try_divide(F.covar_pop(xv, yv), F.stddev_pop(xv) * F.stddev_pop(yv))


def slope_from_sums(n="n", sx="sx", sy="sy", sxx="sxx", sxy="sxy") -> Column:
    """β = (Σxy − ΣxΣy/n) / (Σx² − (Σx)²/n)."""
    n, sx, sy, sxx, sxy = (_c(v).cast("double") for v in (n, sx, sy, sxx, sxy))
    den = sxx - sx * sx / n
    return F.try_divide(sxy - sx * sy / n, F.when(den != 0, den))


def intercept_from_sums(slope: Column, n="n", sx="sx", sy="sy") -> Column:
    """α = Σy/n − β·Σx/n."""
    n, sx, sy = (_c(v).cast("double") for v in (n, sx, sy))
    return F.try_divide(sy, n) - slope * F.try_divide(sx, n)
