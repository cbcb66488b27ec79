"""The ten business reports and the look-up reports on the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.money import as_double, average_2dp, percent_2dp
from tallyhouse.operators.fact import Dimensions
from tallyhouse.operators.metrics import averaged, rows, star_join, summed


def successes(name: str = "successful_count"):
    return F.count_if(F.col("status_name") == "Successful").alias(name)


def monthly_revenue(fact: DataFrame, dims: Dimensions) -> DataFrame:
    joined = star_join(fact, {"date_key": (dims.date, ["year", "month_number", "month_name"])})
    return (
        joined.groupBy("year", "month_name", "month_number")
        .agg(
            rows(),
            summed("amount", "total_revenue"),
            averaged("amount", "avg_transaction_size"),
            summed("fee_amount", "total_fees"),
            summed("cashback_amount", "total_cashback"),
        )
        .orderBy("year", "month_number")
        .drop("month_number")
    )


def payment_method_performance(fact: DataFrame, dims: Dimensions) -> DataFrame:
    joined = star_join(
        fact,
        {
            "payment_method_key": (dims.payment_methods, ["payment_method_name"]),
            "status_key": (dims.transaction_status, ["status_name"]),
        },
    )
    measured = joined.groupBy("payment_method_name").agg(
        rows("total_transactions"),
        successes(),
        averaged("fee_amount", "avg_fee"),
        averaged("amount", "avg_transaction_amount"),
        summed("amount", "total_volume"),
    )
    rate = percent_2dp(F.col("successful_count"), F.col("total_transactions"))
    return measured.withColumn("success_rate_pct", rate).orderBy(
        F.desc("success_rate_pct"), F.desc("total_volume"), "payment_method_name"
    )


def top_merchants(fact: DataFrame, dims: Dimensions, k: int = 10) -> DataFrame:
    """Facts are summed by key before the names come in, so only sums meet the dimension."""
    measured = fact.groupBy("merchant_key").agg(
        rows(),
        summed("amount", "total_revenue"),
        averaged("amount", "avg_transaction_size"),
        summed("merchant_net_amount", "merchant_net_revenue"),
        summed("fee_amount", "total_fees_paid"),
    )
    named = star_join(measured, {"merchant_key": (dims.merchants, ["merchant_name", "merchant_id"])})
    return named.drop("merchant_key").orderBy(F.desc("total_revenue"), "merchant_id").limit(k)


def weekend_weekday(fact: DataFrame, dims: Dimensions) -> DataFrame:
    joined = star_join(fact, {"date_key": (dims.date, ["is_weekend"])})
    measured = joined.groupBy("is_weekend").agg(
        rows(),
        F.sum("amount").alias("_amount"),
        F.sum("fee_amount").alias("_fee"),
        averaged("amount", "avg_transaction_amount"),
    )
    return measured.select(
        F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"),
        "transaction_count",
        as_double("_amount").alias("total_revenue"),
        "avg_transaction_amount",
        as_double("_fee").alias("total_fees"),
        percent_2dp(F.col("_fee"), F.col("_amount")).alias("fee_percentage"),
    ).orderBy(F.desc("transaction_count"), "day_type")


def top_customers(fact: DataFrame, dims: Dimensions, k: int = 20) -> DataFrame:
    """Facts are summed by key before the ids of current customers come in.

    An id has one current version (checked by the duplicate check), so a key stands for an id.
    """
    measured = fact.groupBy("customer_key").agg(
        rows(),
        summed("amount", "total_spent"),
        averaged("amount", "avg_transaction_size"),
        summed("cashback_amount", "total_cashback_received"),
        F.sum("loyalty_points").alias("total_loyalty_points"),
        F.max("transaction_timestamp").alias("last_transaction_date"),
    )
    current = dims.customers.filter(F.col("is_current"))
    named = star_join(measured, {"customer_key": (current, ["customer_id"])})
    return named.drop("customer_key").orderBy(F.desc("total_spent"), "customer_id").limit(k)


def status_by_location(fact: DataFrame, dims: Dimensions) -> DataFrame:
    joined = star_join(
        fact,
        {
            "location_key": (dims.location, ["location_type"]),
            "status_key": (dims.transaction_status, ["status_name"]),
        },
    )
    measured = joined.groupBy("location_type", "status_name").agg(
        rows(), summed("amount", "total_amount")
    )
    # the window sees aggregated rows only: statuses of a location
    within = F.sum("transaction_count").over(Window.partitionBy("location_type"))
    share = percent_2dp(F.col("transaction_count"), F.col("_within"))
    return (
        measured.withColumn("_within", within)
        .withColumn("pct_within_location", share)
        .drop("_within")
        .orderBy("location_type", F.desc("transaction_count"), "status_name")
    )


def category_performance(fact: DataFrame, k: int = 15) -> DataFrame:
    """No join: facts without keys take part."""
    return (
        fact.groupBy("product_category")
        .agg(
            rows(),
            summed("amount", "total_revenue"),
            averaged("amount", "avg_amount"),
            summed("cashback_amount", "total_cashback"),
            F.countDistinct("customer_key").alias("unique_customers"),
        )
        .orderBy(F.desc("total_revenue"), "product_category")
        .limit(k)
    )


def device_usage(fact: DataFrame, dims: Dimensions) -> DataFrame:
    joined = star_join(fact, {"status_key": (dims.transaction_status, ["status_name"])})
    measured = joined.groupBy("device_type").agg(
        rows(),
        summed("amount", "total_revenue"),
        averaged("amount", "avg_transaction_size"),
        successes("_successes"),
    )
    # all devices: a window over one row per device
    total = F.sum("transaction_count").over(Window.partitionBy())
    return (
        measured.withColumn("_total", total)
        .withColumn("percentage", percent_2dp(F.col("transaction_count"), F.col("_total")))
        .withColumn("success_rate_pct", percent_2dp(F.col("_successes"), F.col("transaction_count")))
        .drop("_successes", "_total")
        .orderBy(F.desc("transaction_count"), "device_type")
    )


def day_of_week_pattern(fact: DataFrame, dims: Dimensions) -> DataFrame:
    attributes = ["day_of_week_name", "day_of_week_number", "is_weekend"]
    joined = star_join(fact, {"date_key": (dims.date, attributes)})
    measured = joined.groupBy(*attributes).agg(rows(), summed("amount", "total_revenue"))
    kind = Window.partitionBy("is_weekend")
    n = F.col("transaction_count")
    return (
        measured.withColumns({"_sum": F.sum(n).over(kind), "_days": F.count(n).over(kind)})
        .withColumn("avg_for_day_type", average_2dp(F.col("_sum"), F.col("_days")))
        .drop("is_weekend", "_sum", "_days")
        .orderBy("day_of_week_number")
    )


def failure_analysis(fact: DataFrame, dims: Dimensions, k: int = 20) -> DataFrame:
    failed = dims.transaction_status.filter(F.col("status_name") == "Failed")
    joined = star_join(
        fact,
        {
            "status_key": (failed, []),
            "payment_method_key": (dims.payment_methods, ["payment_method_name"]),
            "location_key": (dims.location, ["location_type"]),
        },
    )
    measured = joined.groupBy("payment_method_name", "location_type").agg(
        rows("failed_count"), summed("amount", "lost_revenue")
    )
    total = F.sum("failed_count").over(Window.partitionBy())
    return (
        measured.withColumn("_total", total)
        .withColumn("pct_of_failures", percent_2dp(F.col("failed_count"), F.col("_total")))
        .drop("_total")
        .orderBy(F.desc("failed_count"), "payment_method_name", "location_type")
        .limit(k)
    )


# --- look-up reports ---------------------------------------------------------------------------


def weekend_dates(calendar: DataFrame, year: int, month: int, k: int = 10) -> DataFrame:
    return (
        calendar.filter(F.col("is_weekend") & (F.col("year") == year)
                        & (F.col("month_number") == month))
        .select("date_key", "full_date", "day_of_week_name", "is_weekend")
        .orderBy("full_date")
        .limit(k)
    )


def fiscal_boundary(calendar: DataFrame, year: int, months: tuple[int, ...] = (3, 4, 5)) -> DataFrame:
    return (
        calendar.filter((F.col("year") == year) & F.col("month_number").isin(*months))
        .select("full_date", "year", "quarter", "fiscal_year", "fiscal_quarter")
        .orderBy("full_date")
    )


def statuses_by_display_order(dim_status: DataFrame) -> DataFrame:
    return dim_status.select(
        "status_key", "status_name", "status_category", "is_terminal", "display_order"
    ).orderBy("display_order", "status_key")


def members(dim: DataFrame, key: str, name: str) -> DataFrame:
    """Key and name of every member."""
    return dim.select(key, name).orderBy(key)


def facts_outside_calendar(fact: DataFrame, k: int = 10) -> DataFrame:
    """Facts without a date key, the first ``k`` by id."""
    return (
        fact.filter(F.col("date_key").isNull())
        .select(
            "transaction_id", "transaction_timestamp",
            F.to_date("transaction_timestamp").alias("transaction_date"),
        )
        .orderBy("transaction_id")
        .limit(k)
    )


def first_rows(table: DataFrame, *order: str, k: int = 10) -> DataFrame:
    """Ordered preview."""
    return table.orderBy(*order).limit(k)


def preview(table: DataFrame, k: int = 10) -> DataFrame:
    """Any ``k`` rows."""
    return table.limit(k)


def fiscal_quarter_sales(monthly_fact: DataFrame, calendar: DataFrame, quarter: int) -> DataFrame:
    """Sales by day name in one fiscal quarter of every year, from the fact partitioned by ``txn_month``.

    The calendar is filtered and brings the month of each day: as part of the join key it tells the scan, before it
    starts, which folders to read.
    """
    wanted = calendar.filter(F.col("fiscal_quarter") == quarter).select(
        "date_key", "fiscal_year", "day_of_week_name", F.date_format("full_date", "yyyy-MM").alias("txn_month")
    )
    return (
        monthly_fact.join(wanted, ["txn_month", "date_key"])
        .groupBy("fiscal_year", "day_of_week_name")
        .agg(rows(), summed("amount", "total_amount"), averaged("amount", "avg_amount"))
    )
