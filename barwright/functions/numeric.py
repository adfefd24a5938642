"""Rounding, exact means and NaN-aware arithmetic."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from barwright.schema import DECIMALS

_SCALE = 10**DECIMALS
# Beyond this a value times 100 does not fit a decimal of 38 digits. Prices are further from it than from infinity.
_DECIMAL_LIMIT = 1e33


def round2(x: Column, rounding: str = "half_even") -> Column:
    """Round a double to two decimals in binary; NaN and infinities pass through.

    Spark's own ``round`` works on the decimal text (1.005 -> 1.01); this one
    scales first (1.005 -> 1.0).
    """
    scaled = x * _SCALE
    whole = F.rint(scaled) if rounding == "half_even" else F.round(scaled, 0)
    return whole / _SCALE


def mean2(x: Column, rounding: str = "half_even") -> Column:
    """Aggregate: two-decimal mean of values that already have two decimals.

    The sum runs over whole cents of 38 digits, so the result does not depend on the
    order in which partitions are merged. Groups with NaN or infinite values
    fall back to a plain average.
    """
    cents = F.when(F.abs(x) < _DECIMAL_LIMIT, F.rint(x * _SCALE).cast("decimal(38,0)"))
    n, n_exact = F.count(x), F.count(cents)
    exact = F.when((n > 0) & (n == n_exact), F.try_sum(cents).cast("double") / n)
    whole = F.rint(exact) if rounding == "half_even" else F.round(exact, 0)
    return F.coalesce(whole / _SCALE, round2(F.avg(x), rounding))


def min_number(x: Column) -> Column:
    """Aggregate: minimum that ignores NaN unless all values are NaN."""
    return F.min(x)  # Spark orders NaN after every number


def max_number(x: Column) -> Column:
    """Aggregate: maximum that ignores NaN unless all values are NaN."""
    return F.coalesce(F.max(F.when(~F.isnan(x), x)), F.max(x))


def pct_change(start: Column, end: Column) -> Column:
    """``(end - start) / start * 100`` with IEEE division, whatever the ANSI mode.

    A zero start gives an infinity or NaN, never an error or a null.
    """
    return F.when(start != 0, (end - start) / start * 100).otherwise(
        (end - start) * F.pow(start, F.lit(-1.0))
    )
