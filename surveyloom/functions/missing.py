"""Statistical-language semantics of missing values, rounding and matching."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ABS_TOL, REL_TOL = 1.5e-8, 1e-9


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_even(c: Column | str, digits: int = 0) -> Column:
    return F.bround(col(c), digits)


def signif(c: Column | str, digits: int) -> Column:
    """Round half-even to ``digits`` significant digits."""
    x = col(c)
    power = F.lit(digits - 1) - F.floor(F.log10(F.abs(x)))
    scale = F.pow(F.lit(10.0), power.cast("double"))
    return F.when(x == 0, F.lit(0.0)).when(
        power >= 0, F.bround(x * scale, 0) / scale
    ).otherwise(F.bround(x / F.pow(F.lit(10.0), -power.cast("double")), 0) * F.pow(F.lit(10.0), -power.cast("double")))


def sum_na_rm(c: Column | str) -> Column:
    """Sum of the non-missing values; 0 when there are none."""
    return F.coalesce(F.sum(col(c)), F.lit(0.0))


def sum_strict(c: Column | str) -> Column:
    """Sum that is missing as soon as one value is missing."""
    x = col(c)
    return F.when(F.count(x) == F.count(F.lit(1)), F.sum(x))


def strict(c: Column | str, measure: Callable[[Column], Column]) -> Column:
    """A mean, largest value or deviation that is missing as soon as one value is missing."""
    x = col(c)
    return F.when(F.count(x) == F.count(F.lit(1)), measure(x))


def mean_strict(c: Column | str) -> Column:
    return strict(c, F.avg)


def max_strict(c: Column | str) -> Column:
    return strict(c, F.max)


def in_set(c: Column | str, values: Iterable) -> Column:
    """Membership that is false, not NULL, for a missing value."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def not_in(c: Column | str, values: Iterable) -> Column:
    """Non-membership that keeps missing values."""
    return ~in_set(c, values)


def paste(*parts: Column | str, sep: str = " ") -> Column:
    """Concatenate as text, a missing part reading ``NA``."""
    return F.concat_ws(sep, *[F.coalesce(col(p).cast("string"), F.lit("NA")) for p in parts])


def near(a: Column | str, b: Column | str) -> Column:
    """Equality within 1.5e-8 absolute or 1e-9 relative, whichever is looser."""
    x, y = col(a), col(b)
    slack = F.greatest(F.lit(ABS_TOL), F.lit(REL_TOL) * F.greatest(F.abs(x), F.abs(y)))
    return F.abs(x - y) < slack


def row_sum(columns: Iterable[str]) -> Column:
    """Row-wise sum over a block of columns; missing if any is missing."""
    return reduce(lambda a, b: a + b, [F.col(f"`{c}`") for c in columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating-point column."""
    floats = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`"), F.lit(None).cast("double")) for c in floats}) if floats else df


def level(c: Column | str, levels: Iterable[str]) -> Column:
    """Ordered category: values outside the levels become NULL."""
    x = col(c)
    return F.when(x.isin(list(levels)), x)


def level_order(c: Column | str, levels: Iterable[str]) -> Column:
    """1-based position of a value in its level list; NULL outside it."""
    position = F.array_position(F.array(*[F.lit(v) for v in levels]), col(c))
    return F.when(position > 0, position.cast("int"))
