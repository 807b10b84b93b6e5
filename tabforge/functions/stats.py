"""Column-expression building blocks for statistics (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pearson(x: Column, y: Column) -> Column:
    """Pairwise-complete Pearson r; NULL for a constant column (as pandas' NaN).

    Plain ``corr`` raises DIVIDE_BY_ZERO on a constant column under ANSI mode.
    """
    return F.try_divide(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x)))


def sample_skewness(x: Column) -> Column:
    """Bias-corrected skewness G1 (pandas ``Series.skew``); NULL for n < 3 or constant."""
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    return F.when(n >= 3, F.try_multiply(g1, F.sqrt(n * (n - 1)) / (n - 2)))


def sample_kurtosis(x: Column) -> Column:
    """Bias-corrected excess kurtosis G2 (pandas ``Series.kurtosis``); NULL for n < 4."""
    n = F.count(x).cast("double")
    g2 = F.kurtosis(x)
    return F.when(n >= 4, F.try_divide((n - 1) * ((n + 1) * g2 + 6), (n - 2) * (n - 3)))


# Rounding nudge: statistics of decimal data can fall exactly on a rounding half,
# where summation-order noise (~1e-15) would decide the direction.  A fixed 1e-9
# shift makes such halves round the same way in every engine and every run.
ROUND_NUDGE = 1e-9


def rnd(x, decimals: int) -> Column:
    col = F.col(x) if isinstance(x, str) else x
    return F.round(col.cast("double") + F.lit(ROUND_NUDGE), decimals)


def r6(x: Column) -> Column:
    """Round doubles to 6 decimals (oracle comparisons)."""
    return rnd(x, 6)


def rsig(x, digits: int = 12) -> Column:
    """Round to ``digits`` significant digits: x is scaled by an exact power of ten
    (multiplication or division by 10^m, m <= 22, both correctly rounded), rounded to
    an integer and scaled back, so any IEEE engine produces the same double."""
    col = (F.col(x) if isinstance(x, str) else x).cast("double")
    m = (F.lit(digits - 1) - F.floor(F.log10(F.abs(col)))).cast("int")
    up = rnd(col * F.pow(F.lit(10.0), m), 0) / F.pow(F.lit(10.0), m)
    down = rnd(col / F.pow(F.lit(10.0), -m), 0) * F.pow(F.lit(10.0), -m)
    return F.when(col.isNull() | (col == 0), col).when(m >= 0, up).otherwise(down)


def md5_unit(x: Column) -> Column:
    """Deterministic number in [0, 1) from the first 8 hex digits of md5(x)."""
    return F.conv(F.substring(F.md5(x.cast("string")), 1, 8), 16, 10).cast("double") / 4294967296.0
