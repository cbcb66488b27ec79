"""Exact distinct counts that can be merged: bitmaps over surrogate keys, stored by day.

A surrogate key is a place in a bitmap; bitmaps of a fixed size hold a range of keys each. Bitmaps of days are joined
by OR, so the distinct keys of any span of days come from the stored bitmaps alone, without the fact. A day adds one row
per range of keys that it touches, 4 KB before compression, whatever the number of facts.

Keys are contiguous numbers from 1 on. NULL keys are not counted, as in COUNT(DISTINCT); facts without a day are in no
span of days and have no bitmap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Bitmaps that one task sorts and joins, 4 KB each.
BITMAPS_PER_TASK = 50_000


def _dealt(bitmaps: DataFrame, rows: int, *by: str | Column) -> DataFrame:
    """Bitmaps of a group and key range together, in parts of a bounded number of them.

    Left to itself, adaptive execution sizes parts by compressed bytes, of which a sparse bitmap has very few. A group
    holds at most a bitmap per day and other columns, so it is never large.
    """
    return bitmaps.repartition(-(-rows // BITMAPS_PER_TASK) or 1, *by, "key_range")


def daily_bitmaps(fact: DataFrame, key: str, day: str = "date_key", by: list[str] | None = None) -> DataFrame:
    """(day, by, ``key_range``, ``keys``) for every day.

    What is shuffled are the distinct keys of a day, twice as 30 bytes or so, not bitmaps of 4 KB; a range of a day
    has no more than 32,768 of them, however busy the day.
    """
    groups = [day, *(by or [])]
    known = fact.filter(F.col(key).isNotNull() & F.col(day).isNotNull())
    once = known.select(
        *groups, F.bitmap_bucket_number(key).alias("key_range"), F.bitmap_bit_position(key).alias("_bit")
    ).distinct()
    together = once.repartition(*groups, "key_range")
    return together.groupBy(*groups, "key_range").agg(F.bitmap_construct_agg("_bit").alias("keys"))


def with_new_days(bitmaps: DataFrame, more: DataFrame) -> DataFrame:
    """Stored bitmaps and those of a batch, which may bring late facts of days that are there; nothing counts twice."""
    names = [c for c in bitmaps.columns if c != "keys"]
    both = bitmaps.unionByName(more)
    dealt = _dealt(both, both.count(), *(c for c in names if c != "key_range"))
    return dealt.groupBy(*names).agg(F.bitmap_or_agg("keys").alias("keys"))


def distinct_over(bitmaps: DataFrame, *groups: str | Column, name: str = "distinct_keys") -> DataFrame:
    """Distinct keys of each group: a span of days, of other columns of the bitmaps, or both."""
    return _counted(bitmaps.select(*groups, "key_range", "keys"), bitmaps.count(), name)


def _counted(bitmaps: DataFrame, rows: int, name: str) -> DataFrame:
    """Distinct keys by all columns but the range and the bitmap, of some number of rows."""
    columns = [c for c in bitmaps.columns if c not in ("key_range", "keys")]
    dealt = _dealt(bitmaps, rows, *columns)
    merged = dealt.groupBy(*columns, "key_range").agg(F.bitmap_or_agg("keys").alias("keys"))
    return merged.groupBy(*columns).agg(F.sum(F.bitmap_count("keys")).cast("bigint").alias(name))


def trailing_distinct(bitmaps: DataFrame, calendar: DataFrame, days: int, name: str = "distinct_keys") -> DataFrame:
    """Distinct keys of the ``days`` days up to each day of the calendar (``date_key``, ``full_date``).

    Every bitmap goes to ``days`` ends, which bounds what a long history costs; days without a fact count as well.
    """
    ends = F.sequence("full_date", F.date_add("full_date", days - 1))
    spread = calendar.select("date_key", F.explode(ends).alias("span_end"))
    placed = bitmaps.join(spread, "date_key").select("span_end", "key_range", "keys")
    counted = _counted(placed, bitmaps.count() * days, name)
    return calendar.select(F.col("full_date").alias("span_end")).join(counted, "span_end")
