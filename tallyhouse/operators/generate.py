"""Synthetic daily batches with known defects.

Rows are computed from their day and sequence number by hashing, so the output is the same for
any number of partitions and any executor can recompute its part.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions import draws, ids
from tallyhouse.functions.dates import shift_minutes
from tallyhouse.functions.money import money

BATCH_COLUMNS = [
    "transaction_id", "customer_id", "transaction_timestamp", "merchant_id", "merchant_name",
    "product_category", "product_name", "amount", "fee_amount", "cashback_amount",
    "loyalty_points", "payment_method", "transaction_status", "device_type", "location_type",
    "currency", "updated_at",
]


@dataclass(frozen=True)
class Defects:
    """Shares of defective rows of a day; counts are cut to whole rows."""

    late: float = 0.0
    null_updated: float = 0.0
    renamed: float = 0.0
    zone_shifted: float = 0.0


CLEAN_DAY = Defects()
LATE_DAY = Defects(late=fixed.LATE_SHARE, null_updated=fixed.NULL_UPDATED_SHARE)
RENAME_DAY = Defects(renamed=fixed.RENAME_SHARE, zone_shifted=fixed.TIME_ZONE_SHARE)


def _share(total: Column, share: float | Column) -> Column:
    return F.floor(total * share).cast("bigint")


def with_segments(sequenced: DataFrame, defects: Defects | list[Defects], kind: Column | None = None) -> DataFrame:
    """Adds ``segment``: clean rows come first, then one block of ids per defect.

    Needs ``sequence`` (1..n of the day) and ``day_rows`` (n). Of several ``defects``, those of a row are
    numbered by ``kind``, from 0.
    """
    n, seq = F.col("day_rows"), F.col("sequence")

    def share(name: str) -> float | Column:
        if isinstance(defects, Defects):
            return getattr(defects, name)
        return F.element_at(F.array(*(F.lit(getattr(d, name)) for d in defects)), (kind + 1).cast("int"))

    blocks = [(name, _share(n, share(name))) for name in ("late", "null_updated", "renamed", "zone_shifted")]
    border = n
    for _, size in blocks:
        border = border - size
    segment = F.when(seq <= border, "clean")
    for name, size in blocks:
        border = border + size
        segment = segment.when(seq <= border, name)
    return sequenced.withColumn("segment", segment)


def merchant_names(spark: SparkSession) -> DataFrame:
    """The merchants that have a name of their own and their new name; one row per fixed name."""
    rows = [
        (i, name, fixed.MERCHANT_RENAMES.get(name))
        for i, name in enumerate(fixed.NAMED_MERCHANTS, start=1)
    ]
    return spark.createDataFrame(rows, "named_id bigint, own_name string, new_name string")


def _product(u: Column, category: Column) -> Column:
    """A product of the row's category."""
    chosen = None
    for name, products in fixed.PRODUCTS.items():
        item = draws.pick(u, products)
        chosen = F.when(category == name, item) if chosen is None else chosen.when(
            category == name, item
        )
    return chosen


_LABELS = [
    "merchant", "time", "update", "a1", "a2", "category", "status", "customer", "product", "fee", "cashback", "points",
    "method", "device", "location",
]


def fill_rows(
    segmented: DataFrame, n_customers: int = 1000, n_merchants: int = 500, seed: int = 42
) -> DataFrame:
    """Batch rows for (``day``, ``sequence``, ``segment``); keeps ``day`` and ``segment``."""
    spark = segmented.sparkSession
    day, seq, segment = F.col("day"), F.col("sequence"), F.col("segment")
    # each drawn once: a draw costs more than all that is made of it
    segmented = segmented.withColumns({f"_u_{label}": draws.uniform(seed, label, day, seq) for label in _LABELS})

    def u(label: str) -> Column:
        return F.col(f"_u_{label}")

    named = min(n_merchants, len(fixed.NAMED_MERCHANTS))
    merchant = F.when(segment == "renamed", draws.whole_number(u("merchant"), 1, named)).otherwise(
        draws.whole_number(u("merchant"), 1, n_merchants)
    )
    moment = day.cast("timestamp_ntz") + draws.second_of_day(u("time"))
    other = day.cast("timestamp_ntz") + draws.second_of_day(u("update"))
    amount = draws.clamp(
        draws.lognormal(u("a1"), u("a2"), fixed.AMOUNT_LOG_MEAN, fixed.AMOUNT_LOG_SIGMA),
        *fixed.AMOUNT_BOUNDS,
    )
    drawn = segmented.withColumns(
        {
            "merchant_number": merchant,
            "product_category": draws.pick(u("category"), list(fixed.PRODUCTS)),
            "amount": money(amount),
            "transaction_status": draws.weighted(u("status"), fixed.STATUS_WEIGHTS),
            "_moment": moment,
        }
    )
    settled = F.col("transaction_status") == "Successful"
    value = F.col("amount").cast("double")
    nothing = F.lit(0).cast("decimal(18,2)")
    names = F.broadcast(merchant_names(spark))  # one row per fixed name
    numbered = F.concat(F.lit("Merchant_"), ids.padded(F.col("merchant_number") - 1, 4))
    own = F.coalesce("own_name", numbered)
    renamed = F.coalesce("new_name", F.concat(own, F.lit(" Ltd")))
    filled = drawn.join(names, F.col("merchant_number") == F.col("named_id"), "left").withColumns(
        {
            "transaction_id": ids.transaction_id(day, seq),
            "customer_id": ids.customer_id(draws.whole_number(u("customer"), 1, n_customers)),
            "transaction_timestamp": F.when(
                segment == "late", shift_minutes(F.col("_moment"), -24 * 60)
            )
            .when(segment == "zone_shifted",
                  shift_minutes(F.col("_moment"), -fixed.EST_SHIFT_MINUTES))
            .otherwise(F.col("_moment")),
            "updated_at": F.when(segment.isin("late", "zone_shifted"), other)
            .when(segment != "null_updated", F.col("_moment")),
            "merchant_id": ids.merchant_id(F.col("merchant_number")),
            "merchant_name": F.when(segment == "renamed", renamed).otherwise(own),
            "product_name": _product(u("product"), F.col("product_category")),
            "fee_amount": money(value * draws.between(u("fee"), *fixed.FEE_RATE_BOUNDS)),
            "cashback_amount": F.when(
                settled, money(value * draws.between(u("cashback"), *fixed.CASHBACK_RATE_BOUNDS))
            ).otherwise(nothing),
            "loyalty_points": F.when(
                settled,
                (value / draws.between(u("points"), *fixed.POINTS_DIVISOR_BOUNDS)).cast("bigint"),
            ).otherwise(F.lit(0).cast("bigint")),
            "payment_method": draws.weighted(u("method"), fixed.PAYMENT_METHOD_WEIGHTS),
            "device_type": draws.weighted(u("device"), fixed.DEVICE_WEIGHTS),
            "location_type": draws.weighted(u("location"), fixed.LOCATION_WEIGHTS),
            "currency": F.lit(fixed.CURRENCY),
        }
    )
    return filled.select(*BATCH_COLUMNS, F.col("day").alias("batch_day"), "segment")


def generate_batch(
    spark: SparkSession,
    day: str,
    n: int,
    defects: Defects = CLEAN_DAY,
    n_customers: int = 1000,
    n_merchants: int = 500,
    seed: int = 42,
) -> DataFrame:
    """One daily batch of ``n`` rows."""
    rows = spark.range(1, n + 1).select(
        F.lit(day).cast("date").alias("day"),
        F.col("id").alias("sequence"),
        F.lit(n).cast("bigint").alias("day_rows"),
    )
    return fill_rows(with_segments(rows, defects), n_customers, n_merchants, seed)


def three_days(
    spark: SparkSession, start: str = "2024-11-01", n: int = 15000, seed: int = 42, **sizes: int
) -> DataFrame:
    """A clean day, a day with late and unstamped rows, a day with renames and shifted rows."""
    days = [str(date.fromisoformat(start) + timedelta(days=i)) for i in range(3)]
    plans = [CLEAN_DAY, LATE_DAY, RENAME_DAY]
    batches = [
        generate_batch(spark, day, n, plan, seed=seed, **sizes) for day, plan in zip(days, plans)
    ]
    return batches[0].unionByName(batches[1]).unionByName(batches[2])
