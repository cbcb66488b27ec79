"""The transaction fact table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.functions.dates import date_key
from tallyhouse.operators.conform import audit_time


@dataclass(frozen=True)
class Dimensions:
    """The six dimension tables of the star."""

    customers: DataFrame
    merchants: DataFrame
    payment_methods: DataFrame
    transaction_status: DataFrame
    location: DataFrame
    date: DataFrame

    def natural_keys(self) -> dict[str, tuple[DataFrame, str, str]]:
        """Per dimension: its current rows, natural key and surrogate key."""
        current = self.customers.filter(F.col("is_current"))
        return {
            "dim_customers": (current, "customer_id", "customer_key"),
            "dim_merchants": (self.merchants, "merchant_id", "merchant_key"),
            "dim_payment_methods":
                (self.payment_methods, "payment_method_name", "payment_method_key"),
            "dim_transaction_status": (self.transaction_status, "status_name", "status_key"),
            "dim_location": (self.location, "location_type", "location_key"),
            "dim_date": (self.date, "date_key", "date_key"),
        }


# silver column that carries the natural key of each dimension
SILVER_KEYS = {
    "dim_customers": "customer_id",
    "dim_merchants": "merchant_id",
    "dim_payment_methods": "payment_method",
    "dim_transaction_status": "transaction_status",
    "dim_location": "location_type",
}
FOREIGN_KEYS = [
    "customer_key", "merchant_key", "payment_method_key", "status_key", "location_key", "date_key",
]


#: Tasks over which rows without a natural key are spread when a lookup shuffles.
SPREAD = 256


def lookup(
    rows: DataFrame, dim: DataFrame, on: str, natural_key: str, take: str,
    spread_by: str | None = None,
) -> DataFrame:
    """Left lookup of a surrogate key; rows without a match keep a NULL key.

    Spark broadcasts the dimension when its measured size is below the session's threshold and
    otherwise shuffles, splitting skewed partitions of the transaction side at run time. Rows
    without a natural key match nothing; with ``spread_by``, a column with many values, they do not
    all meet in one task either.
    """
    found = dim.select(F.col(natural_key).alias("_natural"), F.col(take).alias("_taken"))
    match = rows[on] == F.col("_natural")
    if spread_by:
        found = found.withColumn("_place", F.lit(0))
        apart = F.pmod(F.xxhash64(rows[spread_by]), F.lit(SPREAD)).cast("int")
        match = match & (F.when(rows[on].isNull(), apart).otherwise(0) == F.col("_place"))
    joined = rows.join(found, match, "left")
    return joined.withColumn(take, F.col("_taken")).drop("_natural", "_taken", "_place")


def with_measures(rows: DataFrame) -> DataFrame:
    """The three derived measures."""
    return rows.withColumns(
        {
            "net_customer_amount": F.col("amount") - F.col("cashback_amount"),
            "merchant_net_amount": F.col("amount") - F.col("fee_amount"),
            "gateway_revenue": F.col("fee_amount") - F.col("cashback_amount"),
        }
    )


def build_fact(
    silver: DataFrame, dims: Dimensions, load_ts: datetime | None = None, keep: dict[str, Column] | None = None
) -> DataFrame:
    """One fact row per conformed transaction: six lookups, measures, flags, audit columns.

    ``keep`` are columns of the conformed rows to have beside those of the fact.
    """
    silver = silver.withColumns({f"_keep_{c}": value for c, value in (keep or {}).items()})
    rows = silver.withColumn("_day", date_key(F.col("transaction_timestamp")))
    for name, (dim, natural, key) in dims.natural_keys().items():
        if name == "dim_date":
            # a calendar of some decades: a few thousand rows whatever the data size
            rows = lookup(rows, F.broadcast(dim), "_day", natural, key)
        else:
            rows = lookup(rows, dim, SILVER_KEYS[name], natural, key, "transaction_id")
    computed = {
        "is_refunded": F.lit(False),
        "attempt_number": F.lit(1),
        "created_at": audit_time(load_ts),
        "updated_at": audit_time(load_ts),
    }
    rows = with_measures(rows)
    columns = []
    for name, kind in schemas.column_types(schemas.FACT_TRANSACTIONS).items():
        if name in computed:
            value = computed[name]
        elif name in rows.columns:
            value = F.col(name)
        else:
            value = F.lit(None)
        columns.append(value.cast(kind).alias(name))
    return rows.select(*columns, *(F.col(f"_keep_{c}").alias(c) for c in keep or {}))
