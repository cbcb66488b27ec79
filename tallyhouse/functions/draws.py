"""Random draws derived from a hash of the row, so results do not depend on partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Leading hex digits of a digest that make a draw: 52 bits, which a double holds exactly.
_DIGITS = 13


def uniform(seed: int, label: str, *row: Column) -> Column:
    """A number in [0, 1) that depends only on the seed, the label and the row's columns.

    Drawn from an MD5 digest, so that any engine can repeat it.
    """
    text = F.concat_ws("|", F.lit(f"{seed}|{label}"), *(c.cast("string") for c in row))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, _DIGITS), 16, 10).cast("bigint")
    return bits / F.lit(float(16**_DIGITS))


def between(u: Column, low: float, high: float) -> Column:
    return u * (high - low) + low


def whole_number(u: Column, low: int, high: int) -> Column:
    """A whole number from ``low`` to ``high``, both included."""
    return (F.floor(u * (high - low + 1)) + low).cast("bigint")


def pick(u: Column, values: list[str]) -> Column:
    """One of the values, all equally likely."""
    return F.element_at(F.array(*map(F.lit, values)), F.floor(u * len(values)).cast("int") + 1)


def weighted(u: Column, weights: dict[str, float]) -> Column:
    """One of the names, with the given probabilities."""
    names = list(weights)
    total = sum(weights.values())
    chosen, reached = None, 0.0
    for name in names[:-1]:
        reached += weights[name] / total
        chosen = F.when(u < reached, name) if chosen is None else chosen.when(u < reached, name)
    return F.lit(names[-1]) if chosen is None else chosen.otherwise(names[-1])


def lognormal(u1: Column, u2: Column, mean: float, sigma: float) -> Column:
    """Box-Muller on two uniforms, then the exponential."""
    normal = F.sqrt(F.log(F.lit(1.0) - u1) * -2.0) * F.cos(u2 * (2.0 * math.pi))
    return F.exp(normal * sigma + mean)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def second_of_day(u: Column) -> Column:
    """An interval of 0 to 86,399 whole seconds."""
    return F.make_dt_interval(secs=F.floor(u * 86400).cast("decimal(18,6)"))
