"""Calendar expressions; whole-number results are bigint."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.fixed_values import FISCAL_YEAR_FIRST_MONTH


def date_key(moment: Column) -> Column:
    """yyyymmdd of a date or timestamp as a whole number (plain arithmetic, no text)."""
    return (F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)).cast("bigint")


def sunday_week(day: Column) -> Column:
    """Week of the year, weeks starting on Sunday; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("bigint")


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def fiscal_year(day: Column) -> Column:
    """Starting year of the fiscal year that begins in April."""
    in_new_year = F.month(day) >= FISCAL_YEAR_FIRST_MONTH
    return F.when(in_new_year, F.year(day)).otherwise(F.year(day) - 1).cast("bigint")


def fiscal_quarter(day: Column) -> Column:
    """Calendar quarter from April on, calendar quarter plus 4 before (values 2 to 5)."""
    in_new_year = F.month(day) >= FISCAL_YEAR_FIRST_MONTH
    return F.when(in_new_year, F.quarter(day)).otherwise(F.quarter(day) + 4).cast("bigint")


def shift_minutes(moment: Column, minutes: Column | int) -> Column:
    """A timestamp moved by whole minutes."""
    amount = F.lit(minutes) if isinstance(minutes, int) else minutes
    return moment + F.make_dt_interval(mins=amount)


def day_start(day: str | Column) -> Column:
    """Midnight of a day as a zone-less timestamp."""
    return (F.lit(day) if isinstance(day, str) else day).cast("date").cast("timestamp_ntz")


def instant(moment: Column) -> Column:
    """A zone-less time read as UTC, whatever the session's zone; watermarks need this type."""
    return F.to_timestamp(F.concat(moment.cast("string"), F.lit("Z")))


def utc_date(moment: Column) -> Column:
    """The UTC date of an instant, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(moment) / 86400).cast("int"))


def parsed(text: Column, text_format: str) -> Column:
    """Text as a zone-less time, NULL if unreadable.

    Parsed as UTC and counted from the epoch, so an hour that the session's zone skips survives.
    """
    moment = F.try_to_timestamp(F.concat(text, F.lit(" Z")), F.lit(f"{text_format} X"))
    seconds = (F.unix_micros(moment) / 1000000).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
