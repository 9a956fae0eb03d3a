"""Exact money arithmetic on integer cents.

Sums of cents are exact integers in every engine; dividing by 100 last gives
the same double everywhere. Averages and percentages are rounded half-up with
integer division, so no engine-specific float rounding is involved.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def idiv(a: Column, b: Column) -> Column:
    """Integer division (SQL ``div``), exact for BIGINT operands; null over zero,
    so that aggregates of empty tables don't fail."""
    return F.call_function("div", a.cast("long"), F.nullif(b.cast("long"), F.lit(0).cast("long")))


def cents_to_usd(cents: Column) -> Column:
    return cents / F.lit(100.0)


def sum_usd(cents: Column) -> Column:
    """SUM(amount) in USD, exact."""
    return cents_to_usd(F.sum(cents))


def avg_usd(cents: Column) -> Column:
    """ROUND(AVG(amount), 2), exact: mean cents rounded half-up in integers."""
    s, n = F.sum(cents), F.count(cents)
    return cents_to_usd(idiv(s * 2 + n, n * 2))


def pct_4dp(part: Column, whole: Column) -> Column:
    """ROUND(100 * part / whole, 4), exact for counts."""
    return idiv(part * 2_000_000 + whole, whole * 2) / F.lit(10000.0)


def to_grid(x: Column, scale: int = 1_000_000) -> Column:
    """Value on a 1/scale grid as an exact integer."""
    return F.round(x * F.lit(float(scale))).cast("long")


def grid_avg(x: Column, scale: int = 1_000_000) -> Column:
    """AVG(x) rounded half-up to 1/scale, computed on exact integers (x >= 0)."""
    s, n = F.sum(to_grid(x, scale)), F.count(x)
    return idiv(s * 2 + n, n * 2) / F.lit(float(scale))


def grid_mid(a: Column, b: Column, scale: int = 1_000_000) -> Column:
    """(a + b) / 2 rounded half-up to 1/scale, exact (a, b >= 0)."""
    return idiv(to_grid(a, scale) + to_grid(b, scale) + 1, F.lit(2)) / F.lit(float(scale))


def round_hu(x: Column, digits: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d: pure IEEE arithmetic, so every engine
    gives the same double (unlike engine-specific ROUND on decimal ties)."""
    p = float(10**digits)
    return F.floor(x * F.lit(p) + F.lit(0.5)) / F.lit(p)


def ratio_4dp(a: Column, b: Column) -> Column:
    """round(a / max(b, 1), 4) for non-negative counts, exact."""
    den = F.greatest(b, F.lit(1))
    return idiv(a * 20000 + den, den * 2) / F.lit(10000.0)


def fmt_fixed(x: Column, digits: int) -> Column:
    """printf('%.{d}f') of a value first put on the 10^-d grid."""
    return F.format_string(f"%.{digits}f", round_hu(x, digits))


def fmt_signed_fixed(x: Column, digits: int) -> Column:
    """'{:+.{d}f}' formatting: explicit sign, fixed decimals."""
    r = round_hu(x, digits)
    return F.concat(F.when(r < 0, F.lit("-")).otherwise(F.lit("+")), F.format_string(f"%.{digits}f", F.abs(r)))


def fmt_thousands(n: Column) -> Column:
    """'{:,}' of an integer."""
    return F.format_number(n.cast("long"), 0)


def fmt_signed_thousands(n: Column) -> Column:
    return F.concat(F.when(n < 0, F.lit("-")).otherwise(F.lit("+")), F.format_number(F.abs(n).cast("long"), 0))


def ratio_dp(a: Column, b: Column, digits: int = 6) -> Column:
    """round(a / b, digits) half-up for non-negative integers, b > 0, exact."""
    p = 10**digits
    return idiv(a * (2 * p) + b, b * 2) / F.lit(float(p))
