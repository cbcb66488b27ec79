"""Raw and daily data into the conformed layer; narrow projections without a shuffle."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.fixed_values import CURRENCY, RAW_TIMESTAMP_FORMAT, SOURCE_SYSTEM
from tallyhouse.functions import dates
from tallyhouse.functions.money import money

RENAMED = {
    "user_id": "customer_id",
    "transaction_date": "transaction_timestamp",
    "product_amount": "amount",
    "transaction_fee": "fee_amount",
    "cashback": "cashback_amount",
    "location": "location_type",
}
SILVER_ORDER = [
    "transaction_id", "product_category", "product_name", "loyalty_points", "payment_method",
    "transaction_status", "merchant_id", "device_type", "customer_id", "transaction_timestamp",
    "merchant_name", "amount", "fee_amount", "cashback_amount", "location_type", "currency",
    "loaded_at", "source_system",
]
MONEY_COLUMNS = ["amount", "fee_amount", "cashback_amount"]


def audit_time(load_ts: datetime | None) -> Column:
    """The load time of a run: given, or the start time of the query.

    A time without zone is read in the session's zone, not in that of the driver's machine.
    """
    if load_ts is None:
        return F.current_timestamp()
    text = load_ts.isoformat(sep=" ")
    return F.lit(text).cast("timestamp")


def parsed_time(df: DataFrame, column: str, text_format: str = RAW_TIMESTAMP_FORMAT) -> Column:
    """The column as a zone-less timestamp; text is parsed, anything unreadable becomes NULL."""
    if df.schema[column].dataType.typeName() == "string":
        return dates.parsed(F.col(column), text_format)
    return F.col(column).cast("timestamp_ntz")


def conform_raw(
    raw: DataFrame,
    currency: str = CURRENCY,
    source_system: str = SOURCE_SYSTEM,
    load_ts: datetime | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Conformed transactions: names changed, money exact, constants added, no row dropped.

    With ``columns`` only these, from raw rows that need not have more.
    """
    kept = columns or SILVER_ORDER
    if "transaction_timestamp" in kept:
        raw = raw.withColumn("transaction_date", parsed_time(raw, "transaction_date"))
    renamed = raw.withColumnsRenamed(RENAMED)
    typed = {c: money(c) for c in MONEY_COLUMNS if c in kept}
    added = {
        "currency": F.lit(currency),
        "loaded_at": audit_time(load_ts),
        "source_system": F.lit(source_system),
    }
    return renamed.withColumns(typed | added).select(*kept)


def conform_batch(
    batch: DataFrame,
    source_system: str = "daily_batch",
    load_ts: datetime | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """Conformed rows of daily batches, with ``updated_at``, ``batch_day`` and a batch id.

    Without ``batch_id`` the batch day identifies the batch.
    """
    lineage = F.lit(batch_id) if batch_id else F.date_format("batch_day", "yyyyMMdd")
    typed = {c: money(c) for c in MONEY_COLUMNS}
    added = {
        "loaded_at": audit_time(load_ts),
        "source_system": F.lit(source_system),
        "batch_id": lineage,
    }
    kept = [*SILVER_ORDER, "updated_at", "batch_day", "batch_id"]
    return batch.withColumns(typed | added).select(*kept)
