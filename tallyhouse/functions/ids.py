"""Identifier formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded(number: Column, width: int) -> Column:
    """Decimal text of ``number``, zero padded to ``width``; longer numbers are kept whole."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def customer_id(number: Column, width: int = 4) -> Column:
    return F.concat(F.lit("USER_"), padded(number, width))


def merchant_id(number: Column, width: int = 4) -> Column:
    return F.concat(F.lit("MERCH_"), padded(number, width))


def transaction_id(day: Column, sequence: Column) -> Column:
    """``TXN_20241101_000001`` for a day and a sequence number."""
    compact = F.replace(day.cast("date").cast("string"), F.lit("-"), F.lit(""))
    return F.concat(F.lit("TXN_"), compact, F.lit("_"), padded(sequence, 6))
