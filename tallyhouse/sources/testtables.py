"""The order and event tables of the test data seen as payment data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.fixed_values import CURRENCY, EST_SHIFT_MINUTES
from tallyhouse.functions import ids
from tallyhouse.functions.dates import shift_minutes
from tallyhouse.session import sent_when_small

DATE_SHIFT_YEARS = 20


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _choose(number: Column, values: list[str]) -> Column:
    """One of the values by ``number`` modulo their count."""
    chosen = F.when(F.pmod(number, F.lit(len(values))) == 0, values[0])
    for i, value in enumerate(values[1:-1], start=1):
        chosen = chosen.when(F.pmod(number, F.lit(len(values))) == i, value)
    return chosen.otherwise(values[-1])


#: Key of each parent.
_PARENT_KEYS = {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey"}


def _repeats(parent: DataFrame, key: str) -> bool:
    """Whether a key of a parent repeats, so that a lookup doubles lines."""
    counted = parent.filter(F.col(key).isNotNull()).groupBy(key).count()
    return not counted.filter(F.col("count") > 1).isEmpty()


def raw_transactions(spark: SparkSession, folder: str, *wanted: str, same_rows: bool = False) -> DataFrame:
    """Raw-shaped transactions, one per order line; all columns, or only the wanted ones.

    All parents are looked up by their unique key with left joins, so no line is lost or doubled
    and a parent that no wanted column needs can be left out: Spark cannot know that the keys are
    unique and would keep the join. Customers, parts and suppliers of bounded number are broadcast,
    larger tables are shuffled, with skewed partitions split at run time.

    With ``same_rows`` a parent is left out only if its keys are found to be unique, so that there
    are as many rows as with all columns whatever the tables hold.
    """
    columns = _raw_columns()
    names = list(wanted) or list(columns)
    parents = {parent for name in names for parent in columns[name][0]}

    def table(name: str, *kept: str) -> DataFrame:
        return read_table(spark, folder, name).select(*kept)

    if same_rows:
        parents |= {p for p, k in _PARENT_KEYS.items() if p not in parents and _repeats(table(p, k), k)}

    joined = table(
        "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
    )
    if "orders" in parents or "customer" in parents:
        placed = table("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        if "customer" in parents:
            # orders meet their customers first: a smaller shuffle than lines would be
            people = sent_when_small(table("customer", "c_custkey", "c_mktsegment"))
            placed = placed.join(people, F.col("o_custkey") == F.col("c_custkey"), "left")
        joined = joined.join(placed, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "part" in parents:
        parts = sent_when_small(table("part", "p_partkey", "p_name", "p_type"))
        joined = joined.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    if "supplier" in parents:
        suppliers = sent_when_small(table("supplier", "s_suppkey", "s_name"))
        joined = joined.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return joined.select(*(columns[name][1].alias(name) for name in names))


def _raw_columns() -> dict[str, tuple[list[str], Column]]:
    """Raw column to the parents it needs and its expression."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    settled = F.col("o_orderstatus") == "O"
    nothing = F.lit(0).cast("decimal(18,2)")
    segment = F.col("c_mktsegment")
    suffix = (
        F.when(F.col("l_linenumber") == 7, " Ltd")
        .when(F.col("l_linenumber") == 6, " Pvt Ltd")
        .otherwise("")
    )

    def part_of_price(rate: str) -> Column:
        return (price * F.col(rate).cast("decimal(4,2)")).cast("decimal(18,2)")

    line_keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    years = F.make_ym_interval(F.lit(DATE_SHIFT_YEARS))
    return {
        "transaction_id": ([], F.concat_ws("-", F.lit("TXN"), *line_keys)),
        "user_id": (["orders"], ids.customer_id(F.col("o_custkey"), 5)),
        "transaction_date": ([], F.col("l_shipdate") + years),
        "product_category": (["part"], F.col("p_type")),
        "product_name": (["part"], F.col("p_name")),
        "merchant_name": (["supplier"], F.concat("s_name", suffix)),
        "product_amount": ([], price.cast("decimal(18,2)")),
        "transaction_fee": ([], part_of_price("l_tax")),
        "cashback": (["orders"], F.when(settled, part_of_price("l_discount")).otherwise(nothing)),
        "loyalty_points": (
            ["orders"],
            F.when(settled, F.floor(F.col("l_extendedprice") / 100)).otherwise(0).cast("bigint"),
        ),
        "payment_method": (["orders"], F.col("o_orderpriority")),
        "transaction_status": (
            ["orders"],
            F.when(F.col("o_orderstatus") == "F", "Failed")
            .when(settled, "Successful")
            .when(F.col("o_orderstatus") == "P", "Pending"),
        ),
        "merchant_id": ([], ids.merchant_id(F.col("l_suppkey"), 4)),
        "device_type": ([], _choose(F.col("l_partkey"), ["Android", "iOS", "Web"])),
        "location": (
            ["customer"],
            F.when(segment.isin("AUTOMOBILE", "BUILDING"), "Urban")
            .when(segment.isin("FURNITURE", "HOUSEHOLD"), "Suburban")
            .when(segment == "MACHINERY", "Rural"),
        ),
    }


def _zone_day(stamp: Column) -> Column:
    return F.pmod(F.dayofmonth(stamp), F.lit(3)) == 0


def zone_plan(batches: DataFrame) -> DataFrame:
    """Which days of :func:`event_batches` hold shifted rows."""
    days = batches.select("batch_day").distinct()
    mode = F.when(_zone_day(F.col("batch_day")), "any_lag").otherwise("none")
    return days.withColumn("zone_mode", mode)


def event_batches(events: DataFrame) -> DataFrame:
    """Daily batches with one transaction per event and four kinds of defects.

    ``batch_day`` is the day of the event; the defects change event time, update time or
    merchant name, and no row has two of them. Late and shifted rows come on different days, as in
    real feeds, and the update time of a shifted row is an unrelated time of its day.
    """
    n = F.col("event_id")
    stamp = F.col("ts")
    value = F.col("value").cast("decimal(18,2)")
    no_update = F.pmod(n, F.lit(100)) == 7
    late = (F.pmod(n, F.lit(100)) == 11) & (_zone_day(stamp) == F.lit(False))
    renamed = F.pmod(n, F.lit(100)) == 13
    zoned = (F.pmod(n, F.lit(15)) == 2) & _zone_day(stamp) & ~no_update & ~renamed
    unrelated = F.date_trunc("day", stamp).cast("timestamp_ntz") + F.make_dt_interval(
        secs=F.pmod(n * 7919, F.lit(86400)).cast("decimal(18,6)")
    )
    settled = ~F.col("event_type").isin("error", "signup")
    merchant = F.pmod(n, F.lit(50))
    name = F.concat(F.lit("Merchant_"), ids.padded(merchant, 4))
    nothing = F.lit(0).cast("decimal(18,2)")
    return events.select(
        F.concat(F.lit("EVT-"), n.cast("string")).alias("transaction_id"),
        ids.customer_id(F.col("user_id"), 4).alias("customer_id"),
        F.when(late, shift_minutes(stamp, -24 * 60))
        .when(zoned, shift_minutes(stamp, -EST_SHIFT_MINUTES))
        .otherwise(stamp).alias("transaction_timestamp"),
        ids.merchant_id(merchant, 4).alias("merchant_id"),
        F.when(renamed, F.concat(name, F.lit(" Ltd"))).otherwise(name).alias("merchant_name"),
        F.col("event_type").alias("product_category"),
        F.concat(F.lit("Item_"), F.pmod(n, F.lit(20)).cast("string")).alias("product_name"),
        value.alias("amount"),
        (value * F.expr("0.02BD")).cast("decimal(18,2)").alias("fee_amount"),
        F.when(settled, (value * F.expr("0.01BD")).cast("decimal(18,2)"))
        .otherwise(nothing).alias("cashback_amount"),
        F.when(settled, F.floor(F.col("value") / 10)).otherwise(0).cast("bigint")
        .alias("loyalty_points"),
        _choose(n, ["UPI", "Credit Card", "Debit Card", "Wallet Balance", "Bank Transfer"])
        .alias("payment_method"),
        F.when(F.col("event_type") == "error", "Failed")
        .when(F.col("event_type") == "signup", "Pending")
        .otherwise("Successful").alias("transaction_status"),
        _choose(n, ["Android", "iOS", "Web"]).alias("device_type"),
        _choose(n, ["Urban", "Suburban", "Rural"]).alias("location_type"),
        F.lit(CURRENCY).alias("currency"),
        F.when(zoned, unrelated).when(~no_update, stamp).alias("updated_at"),
        F.to_date(stamp).alias("batch_day"),
    )
