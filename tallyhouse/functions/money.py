"""Exact money arithmetic: sums stay decimal, quotients are rounded half up once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
_WHOLE = "decimal(38,0)"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value: Column | str) -> Column:
    """Any numeric column as money with two decimals."""
    return _column(value).cast(MONEY)


def as_double(value: Column | str) -> Column:
    """A decimal result in the double form that reports expose."""
    return _column(value).cast("double")


def rounded_quotient(numerator: Column, denominator: Column) -> Column:
    """Whole-number quotient, ties away from zero; NULL when dividing by 0.

    Both arguments are whole numbers. Working on doubled integers avoids the last-bit
    differences of floating division.
    """
    num = numerator.cast(_WHOLE)
    den = F.nullif(denominator.cast(_WHOLE), F.lit(0).cast(_WHOLE))
    size = F.call_function("div", F.abs(num) * 2 + F.abs(den), F.abs(den) * 2)
    return F.when((num < 0) != (den < 0), -size).otherwise(size)


def average_2dp(total: Column, n: Column) -> Column:
    """Average from an exact sum (money or whole numbers) and a count, two decimals."""
    return rounded_quotient(total.cast("decimal(28,2)") * 100, n) / F.lit(100.0)


def percent_2dp(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole`` (two counts or two money sums), two decimals."""
    in_cents = part.cast("decimal(28,2)") * 1000000
    return rounded_quotient(in_cents, whole.cast("decimal(28,2)") * 100) / F.lit(100.0)
