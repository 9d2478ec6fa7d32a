"""Simple regression as aggregate expressions, and the p-value of its slope."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def regression(y: str, x: str) -> list[Column]:
    """n, intercept, slope and R² of y on x; the slope is NULL for a constant x."""
    a, b = F.col(f"`{y}`"), F.col(f"`{x}`")
    return [
        F.regr_count(a, b).alias("N"), F.regr_intercept(a, b).alias("Intercept"),
        F.regr_slope(a, b).alias("Slope"), F.regr_r2(a, b).alias("R2"),
    ]


def adjusted_r2(n: Column, r2: Column) -> Column:
    return F.when(n > 2, 1 - (1 - r2) * (n - 1) / (n - 2))


def slope_p_value():
    """Vectorised p-value of a simple regression from R² and n; for one row per fitted group.

    It is the regularised incomplete beta function of 1 − R² at ((n − 2) / 2, 1 / 2).
    """

    def p_values(r2: pd.Series, n: pd.Series) -> pd.Series:
        import math

        import numpy as np

        lgamma = np.vectorize(math.lgamma, otypes=[float])

        def beta_fraction(a, b, x):
            """Continued fraction of the incomplete beta function, evaluated forwards."""
            guard = lambda v: np.where(np.abs(v) < 1e-300, 1e-300, v)
            c, d = np.ones_like(x), 1 / guard(1 - (a + b) * x / (a + 1))
            value = d
            for m in range(1, 20_000):
                even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
                odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
                for term in (even, odd):
                    d, c = 1 / guard(1 + term * d), guard(1 + term / c)
                    value = value * c * d
                if np.all(np.abs(c * d - 1) < 1e-14):
                    break
            return value

        def lower_tail(a, b, x, y):
            scale = np.exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * np.log(x) + b * np.log(y))
            return scale * beta_fraction(a, b, x) / a

        fit = r2.to_numpy(dtype=float, na_value=np.nan)
        df = n.to_numpy(dtype=float, na_value=np.nan) - 2
        p = np.full(len(fit), np.nan)
        valid = (df > 0) & np.isfinite(fit)
        p[valid & (fit >= 1)] = 0.0
        p[valid & (fit <= 0)] = 1.0
        valid &= (fit > 0) & (fit < 1)
        x, a, b = 1 - fit, df / 2, np.full(len(fit), 0.5)
        # Each side of the switching point uses the fraction that converges there.
        low = valid & (x < (a + 1) / (a + b + 2))
        high = valid & ~low
        if low.any():
            p[low] = lower_tail(a[low], b[low], x[low], fit[low])
        if high.any():
            p[high] = 1 - lower_tail(b[high], a[high], fit[high], x[high])
        return pd.Series(p).astype(object).where(~np.isnan(p), None)

    return F.pandas_udf(p_values, T.DoubleType())
