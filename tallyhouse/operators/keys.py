"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.ordered import with_positions


def assign_keys(rows: DataFrame, natural_key: str, key_name: str) -> DataFrame:
    """Contiguous keys 1..N in natural-key order, a NULL natural key first."""
    keyed = with_positions(rows, F.asc_nulls_first(natural_key), into=key_name)
    return keyed.select(key_name, *rows.columns)


def extend_keys(
    existing: DataFrame, incoming: DataFrame, natural_key: str, key_name: str
) -> DataFrame:
    """Keys for natural keys not seen before, numbered on from the highest existing key.

    Existing keys never change, so facts that point at them stay valid. Returns the new rows
    only. NULL is a natural key like any other here.
    """
    fresh = incoming.join(
        existing.select(F.col(natural_key).alias("_known")),
        incoming[natural_key].eqNullSafe(F.col("_known")),
        "left_anti",
    )
    numbered = assign_keys(fresh, natural_key, "_local")
    top = existing.select(F.coalesce(F.max(key_name), F.lit(0))).scalar()
    return numbered.withColumn(key_name, F.col("_local") + top).select(
        key_name, *incoming.columns
    )
