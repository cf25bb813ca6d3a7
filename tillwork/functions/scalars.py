"""Scalar helpers that keep NULL, rounding and hashing rules in one place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0))


def safe_divide(x: Column, y: Column) -> Column:
    """x / y, NULL when y is zero (ANSI mode would raise)."""
    return x / F.nullif(y, F.lit(0))


def round_half_up(x: Column, scale: int) -> Column:
    """Exact rounding on decimals; give it a decimal, not a double, at ties."""
    return F.round(x, scale)


def cents(x: Column) -> Column:
    return x.cast("decimal(10,2)")


def hash_bucket(key: Column, n: int) -> Column:
    """A stable bucket in [0, n): the same on every cluster and in any engine with md5."""
    head = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") % n


def rate_pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """part / whole * 100 in decimal arithmetic, rounded half up; NULL when whole is 0."""
    p, w = part.cast("decimal(20,0)"), whole.cast("decimal(20,0)")
    return F.round(safe_divide(p, w) * 100, scale).cast(f"decimal(20,{scale})")


def beta_mean(a: Column, b: Column) -> Column:
    return a / (a + b)


def beta_var(a: Column, b: Column) -> Column:
    n = a + b
    return (a * b) / (n * n * (n + 1))


def beta_std(a: Column, b: Column) -> Column:
    return F.sqrt(beta_var(a, b))


def money(x: Column) -> Column:
    """1234567.5 -> 1,234,567.50"""
    return F.format_number(x.cast("decimal(20,2)"), 2)


def whole(x: Column) -> Column:
    """1234567 -> 1,234,567"""
    return F.format_number(x.cast("bigint"), 0)


def pct(x: Column) -> Column:
    """54.63 -> 54.6%"""
    return F.concat(F.format_number(x.cast("decimal(20,1)"), 1), F.lit("%"))


def normal_cdf(z: Column) -> Column:
    """Standard normal CDF through the five-term rational approximation of erf.

    Absolute error below 1.5e-7 (Abramowitz and Stegun, formula 7.1.26).
    """
    # fixed values of the published formula
    p = 0.3275911
    coefficients = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(p) * x)
    series = F.lit(0.0)
    for c in reversed(coefficients):
        series = (series + F.lit(c)) * t
    erf = F.lit(1.0) - series * F.exp(-x * x)
    return F.when(z >= 0, (1 + erf) / 2).otherwise((1 - erf) / 2)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)
