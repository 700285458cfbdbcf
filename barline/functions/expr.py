"""Column expressions shared by the operators.

All of them are built-in JVM expressions: no UDF, and no value-dependent error
under ANSI mode (``x / 0`` and ``sqrt`` of a rounding residue give NULL or 0).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRADING_DAYS = 252

# A variance below this share of the second moment is rounding noise.
VARIANCE_NOISE = 1e-12


def safe_div(num: Column, den: Column) -> Column:
    """``num / den`` with NULL for a zero divisor."""
    return F.try_divide(num, den)


def null_if_nan(col: Column) -> Column:
    """NaN as NULL: ``avg`` skips NULL but not NaN."""
    return F.nanvl(col, F.lit(None).cast("double"))


def population_std(m1: Column, m2: Column) -> Column:
    """Population standard deviation from the first two moments.

    ``m2 - m1^2`` of a constant series may come out as a tiny non-zero value;
    it counts as zero.
    """
    var = m2 - m1 * m1
    noise = F.lit(VARIANCE_NOISE) * F.greatest(m2, F.lit(1e-300))
    return F.when(var <= noise, F.lit(0.0)).otherwise(F.sqrt(var))


def prefix_length(n: Column, tenths: int = 8) -> Column:
    """``tenths``/10 of ``n``, rounded down.

    ``n * 8 / 10`` is either whole or at least 0.1 away from a whole number, so
    the floor is exact where ``n * 0.8`` could slip below.
    """
    return F.floor(n * F.lit(tenths) / F.lit(10))


def argmax3(low: Column, mid: Column, high: Column) -> Column:
    """-1, 0 or 1 for the largest of three scores; the first one wins a tie."""
    return (
        F.when((low >= mid) & (low >= high), F.lit(-1))
        .when((mid > low) & (mid >= high), F.lit(0))
        .when((high > low) & (high > mid), F.lit(1))
    )


def daily_rate(annual: float | Column) -> Column:
    return (annual if isinstance(annual, Column) else F.lit(annual)) / F.lit(TRADING_DAYS)


def order_key(major: Column, minor: Column) -> Column:
    """Two non-negative longs as one sortable ``decimal(38,0)`` (``minor`` < 10^18).

    ``min_by`` / ``max_by`` over a struct falls back to sort-based aggregation; a
    fixed-width key keeps it in the hash path with map-side combine.
    """
    shift = F.lit(10**18).cast("decimal(19,0)")
    return (major.cast("decimal(18,0)") * shift + minor.cast("decimal(18,0)")).cast("decimal(38,0)")
