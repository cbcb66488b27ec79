"""Measures of the star by any dimension attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.money import as_double, average_2dp


def summed(column: str, name: str) -> Column:
    """Exact sum of a money column, shown as double."""
    return as_double(F.sum(column)).alias(name)


def averaged(column: str, name: str) -> Column:
    """Average over non-NULL values, rounded to cents."""
    return average_2dp(F.sum(column), F.count(column)).alias(name)


def rows(name: str = "transaction_count") -> Column:
    return F.count(F.lit(1)).alias(name)


def star_join(
    fact: DataFrame, dims: dict[str, tuple[DataFrame, list[str]]]
) -> DataFrame:
    """Fact rows with attributes of the given dimensions.

    ``dims`` maps the key column to a dimension and the attributes wanted from it. Joins are
    inner: facts without a key do not take part.
    """
    for key, (dim, attributes) in dims.items():
        fact = fact.join(dim.select(key, *attributes), key)
    return fact


def star_metrics(
    fact: DataFrame,
    dims: dict[str, tuple[DataFrame, list[str]]],
    group_by: list[str],
    measures: list[Column],
    totals: str | None = None,
    sets: list[list[str]] | None = None,
    level: str | None = None,
) -> DataFrame:
    """Measures by any attributes; ``totals`` is ``rollup`` or ``cube`` to add subtotals.

    ``sets`` names the subtotals wanted instead, computed in one pass. ``level`` is a column that tells a subtotal from
    an attribute that is NULL: a bit per attribute, the first highest, set where the line sums over it.
    """
    joined = star_join(fact, dims)
    if totals not in (None, "rollup", "cube"):
        raise ValueError("totals is rollup, cube or None")
    if totals and sets is not None:
        raise ValueError("give totals or sets")
    if level and not totals and sets is None:
        raise ValueError("a level needs totals or sets")
    if sets is not None:
        grouped = joined.groupingSets([[F.col(c) for c in s] for s in sets], *group_by)
    else:
        grouped = getattr(joined, totals or "groupBy")(*group_by)
    return grouped.agg(*([F.grouping_id().alias(level)] if level else []), *measures)
