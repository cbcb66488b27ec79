"""Dimension tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.fixed_values import (
    CALENDAR_END, CALENDAR_START, STATUS_CATEGORY, STATUS_DISPLAY_ORDER, TERMINAL_STATUSES,
)
from tallyhouse.functions import dates
from tallyhouse.operators.conform import audit_time
from tallyhouse.operators.keys import assign_keys


def build_dimension(
    members: DataFrame,
    natural_key: str,
    key_name: str,
    schema: str,
    attributes: dict[str, Column] | None = None,
    load_ts: datetime | None = None,
) -> DataFrame:
    """A dimension from one row per natural key; surrogate keys follow the natural key."""
    return shaped(assign_keys(members, natural_key, key_name), schema, attributes, load_ts)


def shaped(
    keyed: DataFrame, schema: str, attributes: dict[str, Column] | None = None,
    load_ts: datetime | None = None,
) -> DataFrame:
    """Keyed members as a dimension: columns of ``schema`` that are neither given nor computed become
    typed NULLs; audit columns get the load time."""
    computed = {"created_at": audit_time(load_ts), "updated_at": audit_time(load_ts)}
    computed |= attributes or {}
    columns = []
    for name, kind in schemas.column_types(schema).items():
        if name in computed:
            value = computed[name]
        elif name in keyed.columns:
            value = F.col(name)
        else:
            value = F.lit(None)
        columns.append(value.cast(kind).alias(name))
    return keyed.select(*columns)


def dim_customers(silver: DataFrame, load_ts: datetime | None = None) -> DataFrame:
    """One open version per customer, valid from the load."""
    return build_dimension(
        silver.select("customer_id").distinct(),
        "customer_id", "customer_key", schemas.DIM_CUSTOMERS,
        {"effective_start_date": audit_time(load_ts), "is_current": F.lit(True)},
        load_ts,
    )


def merchant_names(silver: DataFrame) -> DataFrame:
    """Rows ``n`` per merchant id and name.

    Counting by both hashes in one pass; the smallest name per id of the raw rows would sort them.
    """
    return silver.groupBy("merchant_id", "merchant_name").agg(F.count(F.lit(1)).alias("n"))


def dim_merchants(
    silver: DataFrame, load_ts: datetime | None = None, newest_by: str | None = None
) -> DataFrame:
    """One row per merchant id, however many names it carries.

    The name is the smallest one, or the latest one when ``newest_by`` names a time column. For the
    smallest name, pass :func:`merchant_names` rather than the rows themselves.
    """
    if newest_by:
        # the name breaks ties, so that the choice does not depend on row order
        latest = F.max(F.struct(F.col(newest_by).alias("at"), F.col("merchant_name").alias("is")))
        name = latest["is"]
    else:
        name = F.min("merchant_name")
    return build_dimension(
        silver.groupBy("merchant_id").agg(name.alias("merchant_name")),
        "merchant_id", "merchant_key", schemas.DIM_MERCHANTS,
        {"is_active": F.lit(False)},
        load_ts,
    )


def dim_payment_methods(silver: DataFrame, load_ts: datetime | None = None) -> DataFrame:
    return build_dimension(
        silver.select(F.col("payment_method").alias("payment_method_name")).distinct(),
        "payment_method_name", "payment_method_key", schemas.DIM_PAYMENT_METHODS,
        load_ts=load_ts,
    )


def _by_name(name: Column, values: dict) -> Column:
    """CASE over names without ELSE: unknown names give NULL."""
    items = list(values.items())
    chosen = F.when(name == items[0][0], items[0][1])
    for key, value in items[1:]:
        chosen = chosen.when(name == key, value)
    return chosen


def status_attributes() -> dict[str, Column]:
    """Category, finality and display order of a status."""
    name = F.col("status_name")
    return {
        "status_category": _by_name(name, STATUS_CATEGORY),
        "is_terminal": F.coalesce(name.isin(TERMINAL_STATUSES), F.lit(False)),
        "display_order": _by_name(name, STATUS_DISPLAY_ORDER),
    }


def dim_transaction_status(silver: DataFrame, load_ts: datetime | None = None) -> DataFrame:
    """Statuses with category, finality and display order."""
    return build_dimension(
        silver.select(F.col("transaction_status").alias("status_name")).distinct(),
        "status_name", "status_key", schemas.DIM_TRANSACTION_STATUS, status_attributes(), load_ts,
    )


def dim_location(silver: DataFrame, load_ts: datetime | None = None) -> DataFrame:
    return build_dimension(
        silver.select("location_type").distinct(),
        "location_type", "location_key", schemas.DIM_LOCATION,
        load_ts=load_ts,
    )


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes for one ``full_date`` per row."""
    day = F.col("full_date")
    return days.select(
        dates.date_key(day).alias("date_key"),
        "full_date",
        F.dayofmonth(day).cast("bigint").alias("day_of_month"),
        F.dayofweek(day).cast("bigint").alias("day_of_week_number"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        dates.sunday_week(day).alias("week_of_year"),
        F.month(day).cast("bigint").alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.year(day).cast("bigint").alias("year"),
        dates.is_weekend(day).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        dates.fiscal_year(day).alias("fiscal_year"),
        dates.fiscal_quarter(day).alias("fiscal_quarter"),
    )


def _days(bounds: DataFrame) -> DataFrame:
    spine = F.sequence("first", "last", F.expr("interval 1 day"))
    return bounds.select(F.explode(spine).alias("full_date"))


def dim_date(
    spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END
) -> DataFrame:
    """The calendar between two dates, both included."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("last")
    )
    return calendar(_days(bounds))


def dim_date_covering(
    silver: DataFrame, start: str = CALENDAR_START, end: str = CALENDAR_END
) -> DataFrame:
    """The calendar between two dates, extended where the data begins earlier or ends later."""
    day = F.to_date("transaction_timestamp")
    bounds = silver.agg(
        F.least(F.lit(start).cast("date"), F.min(day)).alias("first"),
        F.greatest(F.lit(end).cast("date"), F.max(day)).alias("last"),
    )
    return calendar(_days(bounds))
