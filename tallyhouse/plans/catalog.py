"""Every operator as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce, wraps
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.fixed_values import EST_SHIFT_MINUTES
from tallyhouse.functions import draws, ids
from tallyhouse.functions.dates import shift_minutes
from tallyhouse.functions.money import as_double, average_2dp, percent_2dp
from tallyhouse.operators import (
    conform, dimensions, distinct, generate, history, incremental, keys, metrics, quality, scd,
)
from tallyhouse.operators.fact import FOREIGN_KEYS, build_fact
from tallyhouse.operators.merge_on_read import MergeTable
from tallyhouse.operators.ordered import with_positions
from tallyhouse.plans import reports
from tallyhouse.plans.star_load import StarLoad
from tallyhouse.plans.warehouse import build_warehouse, load_bronze, warehouse_of
from tallyhouse.session import compiled_methods, scratch_path, sent_when_small, stage
from tallyhouse.sources import files, tables
from tallyhouse.sources.testtables import event_batches, raw_transactions, read_table, zone_plan
from tallyhouse.streaming import drops

Query = Callable[[SparkSession, str], DataFrame]
LOADED = datetime(2024, 12, 1)
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register


def shared(make: Query) -> Query:
    """A written table that several queries of an application use."""
    made: dict[tuple[str, str], DataFrame] = {}

    @wraps(make)
    def get(spark: SparkSession, folder: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, folder)
        if key not in made:
            made[key] = make(spark, folder)
        return made[key]

    return get


_SHOWN_AS = {"decimal": "double", "timestamp": "timestamp_ntz"}


def shown(df: DataFrame) -> DataFrame:
    """Decimals as doubles and times without zone."""
    return df.select(
        *(
            F.col(f.name).cast(_SHOWN_AS.get(f.dataType.typeName(), f.dataType)).alias(f.name)
            for f in df.schema
        )
    )


def _batches(spark: SparkSession, folder: str) -> DataFrame:
    return event_batches(read_table(spark, folder, "events"))


def _planned(spark: SparkSession, folder: str) -> DataFrame:
    """The batches with the mode in which each day is searched for shifted rows."""
    batches = _batches(spark, folder)
    return quality.with_zone_mode(batches, zone_plan(batches))


# --- layers --------------------------------------------------------------------------------------


@query("bronze_summary")
def bronze_summary(spark, folder):
    raw = raw_transactions(spark, folder, "transaction_id", "transaction_date")
    return raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("transaction_date").alias("earliest_transaction"),
        F.max("transaction_date").alias("latest_transaction"),
    )


@query("bronze_status_distribution")
def bronze_status_distribution(spark, folder):
    raw = raw_transactions(spark, folder, "transaction_status")
    return quality.distribution(raw, "transaction_status")


@query("bronze_method_counts")
def bronze_method_counts(spark, folder):
    return quality.value_counts(
        raw_transactions(spark, folder, "payment_method"), "payment_method"
    )


@query("bronze_preview")
def bronze_preview(spark, folder):
    """How many rows a preview shows, and how many of them are in the raw table."""
    raw = raw_transactions(spark, folder, "transaction_id")
    preview = stage(reports.preview(raw), "preview")
    found = preview.join(raw.select("transaction_id").distinct(), "transaction_id", "left_semi")
    return preview.agg(F.count(F.lit(1)).alias("preview_rows")).withColumn(
        "found_in_raw", found.select(F.count(F.lit(1))).scalar()
    )


@query("silver_transactions")
def silver_transactions(spark, folder):
    return shown(warehouse_of(spark, folder).silver)


@query("dim_customers")
def dim_customers(spark, folder):
    dim = warehouse_of(spark, folder).customers
    return shown(dim)


@query("dim_merchants")
def dim_merchants(spark, folder):
    return shown(warehouse_of(spark, folder).merchants)


@query("dim_merchants_latest_name")
def dim_merchants_latest_name(spark, folder):
    batches = _batches(spark, folder)
    dim = dimensions.dim_merchants(batches, LOADED, newest_by="transaction_timestamp")
    return dim.select("merchant_key", "merchant_id", "merchant_name")


@query("dim_payment_methods")
def dim_payment_methods(spark, folder):
    return shown(warehouse_of(spark, folder).payment_methods)


@query("dim_transaction_status")
def dim_transaction_status(spark, folder):
    return shown(warehouse_of(spark, folder).transaction_status)


@query("dim_location")
def dim_location(spark, folder):
    return shown(warehouse_of(spark, folder).location)


@query("dim_date")
def dim_date(spark, folder):
    return dimensions.dim_date_covering(warehouse_of(spark, folder).silver)


@query("fact_transactions")
def fact_transactions(spark, folder):
    return shown(warehouse_of(spark, folder).fact)


@query("fact_first_rows")
def fact_first_rows(spark, folder):
    fact = warehouse_of(spark, folder).fact
    first = reports.first_rows(fact, "transaction_timestamp", "transaction_id")
    return shown(first)


@query("customers_first_rows")
def customers_first_rows(spark, folder):
    dim = warehouse_of(spark, folder).customers
    return reports.first_rows(dim, "customer_key").select("customer_key", "customer_id")


@query("catalog_build")
def catalog_build(spark, folder):
    """The full rebuild into catalog tables, from the daily batches as the raw source."""
    batches = _batches(spark, folder)
    back = {new: old for old, new in conform.RENAMED.items()}
    raw = batches.withColumnsRenamed(back).drop("currency", "updated_at", "batch_day")
    built = build_warehouse(spark, raw, "tallyhouse_", LOADED, scratch_path(spark, "tables"))
    keys = {
        "dim_customers": ["customer_key"], "dim_merchants": ["merchant_key"],
        "dim_payment_methods": ["payment_method_key"], "dim_transaction_status": ["status_key"],
        "dim_location": ["location_key"], "dim_date": ["date_key"],
        "fact_transactions": FOREIGN_KEYS,
    }
    amounts = {
        "raw_transactions": "product_amount", "cleaned_transactions": "amount",
        "fact_transactions": "gateway_revenue",
    }
    lines = []
    for name, table in built.items():
        total = [F.sum(k) for k in keys.get(name, [])]
        amount = F.sum(amounts[name]).cast("double") if name in amounts else F.lit(None).cast("double")
        lines.append(
            table.agg(
                F.count(F.lit(1)).alias("row_count"),
                (reduce(add, total) if total else F.lit(None)).cast("bigint").alias("key_total"),
                amount.alias("amount_total"),
            ).withColumn("table_name", F.lit(name))
        )
    return reduce(DataFrame.unionByName, lines)


# --- business reports ----------------------------------------------------------------------------


def _report(name: str, make: Callable) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        house = warehouse_of(spark, folder)
        return make(house.fact, house.dims)

    QUERIES[name] = run


_report("q01_monthly_revenue", reports.monthly_revenue)
_report("q02_payment_method_performance", reports.payment_method_performance)
_report("q03_top_merchants", reports.top_merchants)
_report("q04_weekend_weekday", reports.weekend_weekday)
_report("q05_top_customers", reports.top_customers)
_report("q06_status_by_location", reports.status_by_location)
_report("q07_product_category", lambda fact, dims: reports.category_performance(fact))
_report("q08_device_usage", reports.device_usage)
_report("q09_day_of_week", reports.day_of_week_pattern)
_report("q10_failed_analysis", reports.failure_analysis)


@query("star_rollup")
def star_rollup(spark, folder):
    house = warehouse_of(spark, folder)
    return metrics.star_metrics(
        house.fact,
        {
            "date_key": (house.date, ["fiscal_year", "fiscal_quarter"]),
            "location_key": (house.location, ["location_type"]),
        },
        ["fiscal_year", "fiscal_quarter", "location_type"],
        [
            metrics.rows(),
            metrics.summed("amount", "total_amount"),
            metrics.summed("gateway_revenue", "total_gateway_revenue"),
            metrics.averaged("gateway_revenue", "avg_gateway_revenue"),
        ],
        totals="rollup",
    )


@query("star_cube")
def star_cube(spark, folder):
    house = warehouse_of(spark, folder)
    return metrics.star_metrics(
        house.fact,
        {
            "payment_method_key": (house.payment_methods, ["payment_method_name"]),
            "status_key": (house.transaction_status, ["status_name"]),
        },
        ["payment_method_name", "status_name"],
        [metrics.rows(), metrics.summed("net_customer_amount", "total_net")],
        totals="cube",
    )


@query("star_grouping_sets")
def star_grouping_sets(spark, folder):
    """Chosen subtotals in one pass, over a dimension with an attribute that is NULL; the level tells both apart."""
    house = warehouse_of(spark, folder)
    return metrics.star_metrics(
        house.fact,
        {
            "payment_method_key": (house.payment_methods, ["payment_method_name", "is_instant"]),
            "status_key": (house.transaction_status, ["status_name"]),
        },
        ["status_name", "payment_method_name", "is_instant"],
        [metrics.rows(), metrics.summed("amount", "total_amount")],
        sets=[["status_name", "is_instant"], ["payment_method_name"], ["is_instant"], []],
        level="total_level",
    )


@shared
def _customer_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """Bitmaps of the customers of each day and product category; the last year's days come as a batch of their own."""
    fact = warehouse_of(spark, folder).fact.select("date_key", "product_category", "customer_key")
    last = fact.agg(F.max("date_key")).scalar()
    late = F.col("date_key") > last - 10_000
    first, more = (
        stage(distinct.daily_bitmaps(part, "customer_key", by=["product_category"]), "daily_bitmaps")
        for part in (fact.filter(~late), fact.filter(late | (F.col("date_key") % 7 == 0)))
    )
    return stage(distinct.with_new_days(first, more), "customer_bitmaps")


@query("distinct_by_month")
def distinct_by_month(spark, folder):
    """Customers of each month, from the stored bitmaps of its days."""
    month = F.floor(F.col("date_key") / 100).alias("month_key")
    return distinct.distinct_over(_customer_bitmaps(spark, folder), month, name="unique_customers")


@query("distinct_by_category")
def distinct_by_category(spark, folder):
    """Customers of each product category and year, from the stored bitmaps."""
    year = F.floor(F.col("date_key") / 10_000).alias("year")
    return distinct.distinct_over(_customer_bitmaps(spark, folder), "product_category", year, name="unique_customers")


@query("distinct_trailing_week")
def distinct_trailing_week(spark, folder):
    """Customers of the seven days up to each day, from the stored bitmaps."""
    bitmaps = _customer_bitmaps(spark, folder)
    return distinct.trailing_distinct(bitmaps, warehouse_of(spark, folder).date, 7, "unique_customers")


def _days_of_facts(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar's days on which there are transactions."""
    house = warehouse_of(spark, folder)
    return house.date.join(house.fact.select("date_key").distinct(), "date_key", "left_semi")


@query("date_weekends")
def date_weekends(spark, folder):
    """Weekend dates of a month on which there were transactions."""
    return reports.weekend_dates(_days_of_facts(spark, folder), 2016, 8)


@query("date_fiscal_boundary")
def date_fiscal_boundary(spark, folder):
    """Dates with transactions around the turn of the fiscal year."""
    return reports.fiscal_boundary(_days_of_facts(spark, folder), 2016)


@query("status_by_display_order")
def status_by_display_order(spark, folder):
    return reports.statuses_by_display_order(warehouse_of(spark, folder).transaction_status)


@query("location_list")
def location_list(spark, folder):
    dim = warehouse_of(spark, folder).location
    return reports.members(dim, "location_key", "location_type")


@query("method_list")
def method_list(spark, folder):
    dim = warehouse_of(spark, folder).payment_methods
    return reports.members(dim, "payment_method_key", "payment_method_name")


# --- checks --------------------------------------------------------------------------------------


@query("dq_row_reconcile")
def dq_row_reconcile(spark, folder):
    house = warehouse_of(spark, folder)
    return quality.row_reconciliation(house.silver, house.fact)


@query("dq_dim_duplicates")
def dq_dim_duplicates(spark, folder):
    """The dimensions as they would be without the collapse: merchants by id and name."""
    house = warehouse_of(spark, folder)
    return quality.duplicates(house.merchant_names, "merchant_id")


@query("dq_dim_duplicates_built")
def dq_dim_duplicates_built(spark, folder):
    return quality.dimension_duplicates(warehouse_of(spark, folder).dims)


@query("dq_txn_duplicates")
def dq_txn_duplicates(spark, folder):
    return quality.duplicates(warehouse_of(spark, folder).fact, "transaction_id")


@query("dq_line_duplicates")
def dq_line_duplicates(spark, folder):
    """The same check on a key that is known to repeat."""
    lines = read_table(spark, folder, "lineitem")
    return quality.duplicates(lines, "l_orderkey", "l_linenumber")


@query("dq_fk_complete")
def dq_fk_complete(spark, folder):
    return quality.foreign_key_completeness(warehouse_of(spark, folder).fact)


@query("dq_fk_nulls")
def dq_fk_nulls(spark, folder):
    return quality.null_foreign_keys(warehouse_of(spark, folder).fact)


def _partial_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Facts of the daily batches against the dimensions of the orders: many lookups miss."""
    house = warehouse_of(spark, folder)
    silver = conform.conform_batch(_batches(spark, folder), load_ts=LOADED)
    return build_fact(silver, house.dims, LOADED)


@query("dq_fk_nulls_partial")
def dq_fk_nulls_partial(spark, folder):
    return quality.null_foreign_keys(_partial_fact(spark, folder))


@query("dq_orphans")
def dq_orphans(spark, folder):
    house = warehouse_of(spark, folder)
    return quality.orphans(
        _batches(spark, folder), house.customers, "customer_id", "customer_id"
    )


@query("dq_orphan_merchants")
def dq_orphan_merchants(spark, folder):
    house = warehouse_of(spark, folder)
    return quality.orphans(
        house.silver, dimensions.dim_merchants(_batches(spark, folder), LOADED),
        "merchant_id", "merchant_id",
    )


@query("dq_date_range")
def dq_date_range(spark, folder):
    return quality.date_range(warehouse_of(spark, folder).silver)


@query("dq_out_of_calendar")
def dq_out_of_calendar(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    return quality.out_of_calendar(lines, dimensions.dim_date(spark), "l_shipdate")


@query("dq_facts_outside_calendar")
def dq_facts_outside_calendar(spark, folder):
    house = warehouse_of(spark, folder)
    short = house.date.filter(F.col("full_date") >= "2016-01-01")
    dated = house.silver.select(
        "transaction_id", "transaction_timestamp",
        F.to_date("transaction_timestamp").alias("_day"),
    )
    keyed = dated.join(
        F.broadcast(short.select("full_date", "date_key")),
        F.col("_day") == F.col("full_date"), "left",
    )
    return reports.facts_outside_calendar(keyed)


@query("dq_measures")
def dq_measures(spark, folder):
    return quality.measure_summary(warehouse_of(spark, folder).fact)


@query("dq_measure_rows")
def dq_measure_rows(spark, folder):
    return quality.measure_check(warehouse_of(spark, folder).fact)


@query("dq_key_range")
def dq_key_range(spark, folder):
    return quality.key_range(warehouse_of(spark, folder).customers, "customer_key")


@query("dq_name_variations")
def dq_name_variations(spark, folder):
    return quality.name_variations(warehouse_of(spark, folder).merchant_names)


@query("dq_status_distribution")
def dq_status_distribution(spark, folder):
    house = warehouse_of(spark, folder)
    dim = house.transaction_status.select("status_name", "is_terminal")
    known = house.silver.join(dim, house.silver["transaction_status"] == dim["status_name"])
    return quality.distribution(known, "status_name", "is_terminal")


@query("dq_location_distribution")
def dq_location_distribution(spark, folder):
    house = warehouse_of(spark, folder)
    known = house.silver.join(house.location.select("location_type"), "location_type")
    return quality.distribution(known, "location_type")


@query("dq_method_distribution")
def dq_method_distribution(spark, folder):
    house = warehouse_of(spark, folder)
    dim = house.payment_methods.select("payment_method_name")
    known = house.silver.join(dim, house.silver["payment_method"] == dim["payment_method_name"])
    return quality.value_counts(known, "payment_method_name")


@query("dq_constants")
def dq_constants(spark, folder):
    return quality.constant_columns(warehouse_of(spark, folder).silver).select(
        "unique_currencies", "unique_sources",
        (F.col("first_load_time") == F.col("last_load_time")).alias("one_load_time"),
    )


@query("dq_critical_nulls")
def dq_critical_nulls(spark, folder):
    return quality.critical_nulls(warehouse_of(spark, folder).silver)


@query("dq_late")
def dq_late(spark, folder):
    late = _batches(spark, folder).filter(quality.is_late())
    return late.select("batch_day", "transaction_id", "transaction_timestamp")


@query("dq_null_updated")
def dq_null_updated(spark, folder):
    missing = _batches(spark, folder).filter(quality.is_update_missing())
    return missing.groupBy("batch_day").agg(F.count(F.lit(1)).alias("null_updated_rows"))


@query("dq_renames")
def dq_renames(spark, folder):
    renamed = _batches(spark, folder).filter(quality.is_renamed())
    return renamed.select("batch_day", "transaction_id", "merchant_name")


@query("dq_renames_orders")
def dq_renames_orders(spark, folder):
    silver = warehouse_of(spark, folder).silver
    return silver.agg(
        F.count_if(quality.is_renamed()).alias("renamed_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )


@query("dq_tz_shift")
def dq_tz_shift(spark, folder):
    return _batches(spark, folder).groupBy("batch_day").agg(
        *(
            F.count_if(quality.is_zone_shifted(mode)).alias(f"{mode}_rows")
            for mode in ("day_border", "any_lag", "fixed_lag")
        )
    )


@query("dq_clean_rows")
def dq_clean_rows(spark, folder):
    return quality.batch_defects(_planned(spark, folder), F.col("zone_mode"))


@query("dq_cross_batch_dups")
def dq_cross_batch_dups(spark, folder):
    batches = _batches(spark, folder)
    again = batches.filter(F.pmod(F.col("amount") * 100, F.lit(7)) == 0)
    return quality.repeated_ids(batches.unionByName(again))


@query("dq_batch_profile")
def dq_batch_profile(spark, folder):
    return quality.batch_profile(_batches(spark, folder))


@query("dq_batch_report")
def dq_batch_report(spark, folder):
    return quality.batch_report(_planned(spark, folder), F.col("zone_mode"))


@query("dq_fanout")
def dq_fanout(spark, folder):
    house = warehouse_of(spark, folder)
    return quality.fan_out(house.silver, house.fact, house.dims)


@query("dq_fanout_uncollapsed")
def dq_fanout_uncollapsed(spark, folder):
    """What the lookup would do with merchants by id and name: rows before and after.

    Computed from counts per merchant; the multiplied rows are never produced.
    """
    per_id = warehouse_of(spark, folder).merchant_names.groupBy("merchant_id").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("names")
    )
    matches = F.when(F.col("merchant_id").isNull(), 1).otherwise(F.col("names"))
    return per_id.agg(
        F.sum("n").alias("silver_count"), F.sum(F.col("n") * matches).alias("fact_count")
    )


@query("dq_expected_counts")
def dq_expected_counts(spark, folder):
    house = warehouse_of(spark, folder)
    d = house.dims
    return quality.expected_counts(
        {
            "dim_payment_methods": 5, "dim_transaction_status": 3, "dim_location": 3,
            "dim_date": 5844, "dim_merchants": 987,
        },
        silver=house.silver, fact=house.fact, dim_customers=d.customers,
        dim_merchants=d.merchants, dim_payment_methods=d.payment_methods,
        dim_transaction_status=d.transaction_status, dim_location=d.location, dim_date=d.date,
    )


@query("dq_schema")
def dq_schema(spark, folder):
    fact = warehouse_of(spark, folder).fact
    return quality.schema_conformance(fact, schemas.column_types(schemas.FACT_TRANSACTIONS))


@query("dq_report")
def dq_report(spark, folder):
    house = warehouse_of(spark, folder)
    return quality.quality_report(house.silver, house.fact, house.dims)


# --- dimensions with history ---------------------------------------------------------------------


@query("scd1_merchants")
def scd1_merchants(spark, folder):
    """Merchant names of the orders overwritten by the names in the daily batches."""
    dim = warehouse_of(spark, folder).merchants
    batches = _batches(spark, folder)
    applied = scd.scd1_apply(
        dim, batches, "merchant_id", "merchant_key", ["merchant_name"],
        newest_by="transaction_timestamp", load_ts=LOADED,
    )
    return applied.select("merchant_key", "merchant_id", "merchant_name")


@shared
def _customer_versions(spark: SparkSession, folder: str) -> DataFrame:
    """A customer dimension from the customer table, and a round of changes applied to it."""
    customers = read_table(spark, folder, "customer")
    members = customers.select(
        ids.customer_id(F.col("c_custkey"), 5).alias("customer_id"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("c_acctbal").alias("risk_score"),
    )
    first = datetime(2015, 6, 1)
    dim = dimensions.build_dimension(
        members, "customer_id", "customer_key", schemas.DIM_CUSTOMERS,
        {
            "effective_start_date": conform.audit_time(first), "is_current": F.lit(True),
            "customer_segment": F.col("customer_segment"), "risk_score": F.col("risk_score"),
        },
        first,
    )
    versions = scd.scd2_apply(
        stage(dim, "customers_before"), _customer_updates(customers),
        "customer_id", "customer_key", ["customer_segment", "risk_score"], "changed_at", LOADED,
    )
    return stage(versions, "customer_versions")


def _customer_updates(customers: DataFrame) -> DataFrame:
    n = F.col("c_custkey")
    name = ids.customer_id(n, 5)

    def change(who: Column, customer: Column, segment: Column, at: str) -> DataFrame:
        return customers.filter(who).select(
            customer.alias("customer_id"), segment.alias("customer_segment"),
            F.col("c_acctbal").alias("risk_score"),
            F.lit(at).cast("timestamp").alias("changed_at"),
        )

    same = F.col("c_mktsegment")
    parts = [
        change(F.pmod(n, F.lit(10)) == 0, name, F.lit("PREMIUM"), "2017-03-01"),
        change(F.pmod(n, F.lit(20)) == 0, name, F.lit("PREMIUM"), "2018-01-01"),  # no change
        change(F.pmod(n, F.lit(20)) == 0, name, same, "2019-01-01"),
        change(F.pmod(n, F.lit(7)) == 0, name, same, "2016-01-01"),  # no change
        change(F.pmod(n, F.lit(50)) == 1, F.concat(F.lit("NEW_"), name), same, "2018-06-01"),
        change(F.pmod(n, F.lit(9)) == 0, name, F.lit("OLD"), "2014-01-01"),  # before the start
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("scd2_customers")
def scd2_customers(spark, folder):
    return _customer_versions(spark, folder).select(
        "customer_key", "customer_id", "customer_segment", "risk_score",
        F.col("effective_start_date").cast("timestamp_ntz").alias("effective_start_date"),
        F.col("effective_end_date").cast("timestamp_ntz").alias("effective_end_date"),
        "is_current",
    )


@query("scd2_replay")
def scd2_replay(spark, folder):
    """The same changes applied a second time: nothing moves."""
    once = _customer_versions(spark, folder)
    updates = _customer_updates(read_table(spark, folder, "customer"))
    twice = scd.scd2_apply(
        once, updates, "customer_id", "customer_key", ["customer_segment", "risk_score"],
        "changed_at", LOADED,
    )
    return twice.select(
        "customer_key", "customer_id", "customer_segment",
        F.col("effective_start_date").cast("timestamp_ntz").alias("effective_start_date"),
        F.col("effective_end_date").cast("timestamp_ntz").alias("effective_end_date"),
        "is_current",
    )


@query("pit_lookup")
def pit_lookup(spark, folder):
    """Sales by the segment a customer had at the time of the transaction."""
    versions = _customer_versions(spark, folder)
    silver = warehouse_of(spark, folder).silver_of("customer_id", "transaction_timestamp", "amount")
    found = scd.point_in_time_lookup(
        silver, versions, "customer_id", "transaction_timestamp", ["customer_segment"]
    )
    return found.groupBy("customer_segment").agg(
        metrics.rows(), metrics.summed("amount", "total_amount")
    )


@query("pit_lookup_strict")
def pit_lookup_strict(spark, folder):
    """Transactions per version key, without stretching the first version back."""
    versions = _customer_versions(spark, folder)
    silver = warehouse_of(spark, folder).silver_of("customer_id", "transaction_timestamp")
    found = scd.point_in_time_lookup(
        silver, versions, "customer_id", "transaction_timestamp", ["customer_key"],
        first_version_open=False,
    )
    return found.groupBy("customer_key").agg(metrics.rows())


# --- increments ----------------------------------------------------------------------------------


@query("inc_hwm")
def inc_hwm(spark, folder):
    new = incremental.changed_since(_batches(spark, folder), "2024-01-20 00:00:00")
    return shown(new.select("transaction_id", "transaction_timestamp", "updated_at", "amount"))


@query("inc_next_mark")
def inc_next_mark(spark, folder):
    return incremental.high_water_mark(_batches(spark, folder))


def _corrections(batches: DataFrame) -> DataFrame:
    """Changes to the batches: two for every ninth id, stale ones, and new ids."""
    n = F.substring("transaction_id", 5, 20).cast("bigint")
    base = batches.filter(F.col("updated_at").isNotNull()).withColumn("_n", n)

    def moved(days: int) -> Column:
        return F.col("updated_at") + F.make_dt_interval(days=F.lit(days))

    ninth = base.filter(F.pmod("_n", F.lit(9)) == 0)
    parts = [
        ninth.withColumns({"amount": F.col("amount") + 1, "updated_at": moved(1)}),
        ninth.withColumns({"amount": F.col("amount") + 2, "updated_at": moved(2)}),
        base.filter(F.pmod("_n", F.lit(11)) == 5).withColumns(
            {"amount": F.col("amount") + 1000, "updated_at": moved(-3)}
        ),
        base.filter(F.pmod("_n", F.lit(40)) == 1).withColumn(
            "transaction_id", F.concat(F.lit("NEW-"), F.col("transaction_id"))
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    typed = out.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    return typed.select(*batches.columns)


@query("inc_upsert")
def inc_upsert(spark, folder):
    batches = _batches(spark, folder)
    merged = incremental.upsert(batches, _corrections(batches), "transaction_id")
    return shown(merged.select("transaction_id", "amount", "updated_at", "transaction_status"))


def _history(spark: SparkSession, batches: DataFrame, name: str) -> history.BucketedHistory:
    """An empty history of its own for every call."""
    tables.create_database(spark, "tallyhouse_history", scratch_path(spark, "histories"))
    path = scratch_path(spark, name)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batches.schema)
    table = f"tallyhouse_history.{path.rsplit('/', 1)[-1].replace('-', '_')}"
    return history.BucketedHistory(spark, table, schema, "transaction_id", buckets=8, root=path)


@query("inc_bucketed_upsert")
def inc_bucketed_upsert(spark, folder):
    """Spans of days and their corrections as batches of a bucketed history, one of them twice and one not yet written."""
    spans = _in_spans(_batches(spark, folder))
    kept = _history(spark, spans[0], "upserts")
    for number, span in enumerate(spans):
        kept.append(span.unionByName(_corrections(spans[number - 1])) if number else span, number)
        if number == 1:
            kept.compact()
    kept.append(spans[-1].unionByName(_corrections(spans[-2])), SPANS - 1)
    merged = kept.upserted(_corrections(spans[-1]))
    return shown(merged.select("transaction_id", "amount", "updated_at", "transaction_status"))


@query("dq_cross_batch_history")
def dq_cross_batch_history(spark, folder):
    """Each span with every seventh row of the span before: its ids against all that came earlier."""
    spans = _in_spans(_batches(spark, folder))
    kept = _history(spark, spans[0], "ids")
    again = [s.filter(F.pmod(F.col("amount") * 100, F.lit(7)) == 0) for s in spans]
    lines = []
    for number, span in enumerate(spans):
        batch = span.unionByName(again[number - 1]) if number else span
        kept.append(batch, number)
        lines.append(kept.check(batch, number).withColumn("batch_number", F.lit(number).cast("bigint")))
    return reduce(DataFrame.unionByName, lines)


@query("inc_cdc")
def inc_cdc(spark, folder):
    batches = _batches(spark, folder)
    applied = incremental.apply_changes(
        batches.select("transaction_id", "amount", "transaction_status"),
        _feed(batches), "transaction_id", "seq",
    )
    return shown(applied)


def _feed(batches: DataFrame) -> DataFrame:
    """Updates, later deletes of some of them, deletes of absent ids, inserts."""
    n = F.substring("transaction_id", 5, 20).cast("bigint")
    base = batches.select("transaction_id", "amount", "transaction_status").withColumn("_n", n)
    absent = F.concat(F.lit("GONE-"), F.col("transaction_id"))
    fresh = F.concat(F.lit("NEW-"), F.col("transaction_id"))
    money = F.col("amount").cast("decimal(18,2)")
    parts = [
        base.filter(F.pmod("_n", F.lit(6)) == 0).select(
            "transaction_id", (money + 5).cast("decimal(18,2)").alias("amount"),
            F.lit("Refunded").alias("transaction_status"),
            F.lit(1).alias("seq"), F.lit("U").alias("op"),
        ),
        base.filter(F.pmod("_n", F.lit(12)) == 0).select(
            "transaction_id", "amount", "transaction_status",
            F.lit(2).alias("seq"), F.lit("D").alias("op"),
        ),
        base.filter(F.pmod("_n", F.lit(30)) == 1).select(
            absent.alias("transaction_id"), "amount", "transaction_status",
            F.lit(1).alias("seq"), F.lit("D").alias("op"),
        ),
        base.filter(F.pmod("_n", F.lit(25)) == 2).select(
            fresh.alias("transaction_id"), "amount", "transaction_status",
            F.lit(1).alias("seq"), F.lit("I").alias("op"),
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("inc_soft_delete")
def inc_soft_delete(spark, folder):
    batches = _batches(spark, folder)
    applied = incremental.apply_changes(
        batches.select("transaction_id", "amount", "transaction_status"),
        _feed(batches), "transaction_id", "seq", soft_delete=True,
    )
    return applied.groupBy("is_deleted").agg(
        metrics.rows(), metrics.summed("amount", "total_amount")
    )


@query("inc_late_route")
def inc_late_route(spark, folder):
    """Batches stored by event date; late rows and corrections rewrite only their dates."""
    batches = incremental.with_event_date(_batches(spark, folder))
    path = scratch_path(spark, "by_event_date")
    on_time = batches.filter(~quality.is_late())
    tables.write_by_partition(on_time, path, "event_date")
    late = batches.filter(quality.is_late())
    incremental.upsert_partitions(spark, path, late, "transaction_id", "event_date")
    stored = spark.read.schema(batches.schema).parquet(path)
    return stored.groupBy("event_date").agg(
        metrics.rows(), metrics.summed("amount", "total_amount")
    )


@query("inc_tz_fix")
def inc_tz_fix(spark, folder):
    fixed = incremental.normalise_time_zone(_planned(spark, folder), F.col("zone_mode"))
    return fixed.select("transaction_id", "transaction_timestamp", "zone_fixed")


@query("inc_lineage")
def inc_lineage(spark, folder):
    silver = conform.conform_batch(_batches(spark, folder), load_ts=LOADED)
    return silver.groupBy("batch_id", "source_system").agg(
        metrics.rows(), metrics.summed("amount", "total_amount")
    )


@query("inc_month_partitions")
def inc_month_partitions(spark, folder):
    fact = warehouse_of(spark, folder).fact
    path = scratch_path(spark, "fact_by_month")
    month = tables.month_of(F.col("transaction_timestamp"))
    monthly = fact.withColumn("txn_month", month)
    tables.write_by_partition(monthly, path, "txn_month")
    # the given schema keeps the partition value text
    stored = spark.read.schema(monthly.schema).parquet(path)
    return stored.groupBy("txn_month").agg(
        metrics.rows(), metrics.summed("amount", "total_amount")
    )


@shared
def _monthly_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The fact in a folder per month."""
    monthly = warehouse_of(spark, folder).fact.withColumn("txn_month", tables.month_of(F.col("transaction_timestamp")))
    path = scratch_path(spark, "fact_by_month")
    tables.write_by_partition(monthly, path, "txn_month")
    return spark.read.schema(monthly.schema).parquet(path)


@query("inc_fiscal_quarter")
def inc_fiscal_quarter(spark, folder):
    """Sales of the third fiscal quarter; only the folders of its months are read."""
    return reports.fiscal_quarter_sales(_monthly_fact(spark, folder), warehouse_of(spark, folder).date, 3)


@query("inc_merge_on_read")
def inc_merge_on_read(spark, folder):
    """Corrections in two batches beside a base of events: rows as read before a compaction."""
    batches = incremental.with_event_date(_batches(spark, folder))
    table = MergeTable(spark, scratch_path(spark, "merge"), batches.schema, "transaction_id", incremental.change_time(), "event_date")
    table.create(batches)
    changes = incremental.with_event_date(_corrections(_batches(spark, folder)))
    fresh = F.col("transaction_id").startswith("NEW-")
    table.append(changes.filter(fresh), 1)
    table.append(changes.filter(~fresh), 2)
    return shown(table.read().select("transaction_id", "amount", "updated_at", "transaction_status"))


@query("inc_clustered")
def inc_clustered(spark, folder):
    fact = warehouse_of(spark, folder).fact
    laid = stage(
        tables.clustered(fact, "date_key", "merchant_key", "status_key", spread="transaction_id"),
        "fact_clustered",
    )
    return laid.groupBy("date_key", "status_key").agg(
        metrics.rows(), metrics.summed("amount", "total_amount")
    )


@query("inc_clustered_curve")
def inc_clustered_curve(spark, folder):
    """The fact laid out along a curve through three keys: rows and bounds of each of its ranges."""
    by = ["date_key", "merchant_key", "status_key"]
    fact = warehouse_of(spark, folder).fact
    laid = stage(tables.clustered_on_curve(fact, *by, spread="transaction_id"), "fact_on_curve")
    bounds = [f(k).alias(f"{name}_{k}") for k in by for name, f in (("least", F.min), ("most", F.max))]
    return laid.groupBy(tables.curve_place(laid, *by, bits=3).alias("place")).agg(
        metrics.rows(), metrics.summed("amount", "total_amount"), *bounds
    )


@query("inc_star_load")
def inc_star_load(spark, folder):
    """A star loaded in spans of days and then with corrections, one load of them twice."""
    batches = _batches(spark, folder)
    load = StarLoad(spark, scratch_path(spark, "star"), batches.columns)
    spans = _in_spans(batches)
    for i, part in enumerate(spans):
        load.load(part, f"span-{i}", LOADED)
    load.load(spans[1], "span-1", LOADED)
    load.load(_corrections(batches), "corrections", LOADED)
    star = load.star(LOADED, ["merchant_key", "customer_key", "status_key", "location_key", "date_key", "amount"])
    dims = star["dims"]
    rows = star["fact"].join(dims.merchants.select("merchant_key", "merchant_id", "merchant_name"), "merchant_key")
    rows = rows.join(dims.customers.select("customer_key", "customer_id"), "customer_key")
    rows = rows.join(dims.transaction_status.select("status_key", "status_name", "display_order"), "status_key")
    rows = rows.join(dims.location.select("location_key", "location_type"), "location_key")
    by = ["merchant_id", "merchant_name", "status_name", "display_order", "location_type", "date_key"]
    return rows.groupBy(*by).agg(
        metrics.rows(), metrics.summed("amount", "total_amount"), F.count_distinct("customer_id").alias("customers")
    )


@query("inc_dq_dim")
def inc_dq_dim(spark, folder):
    keyed = incremental.with_quality_key(_planned(spark, folder), F.col("zone_mode"))
    dim = incremental.dim_data_quality(spark, LOADED).select("dq_key", "dq_issue")
    # sixteen combinations of four defects, whatever the data size
    labelled = keyed.join(F.broadcast(dim), "dq_key", "left")
    return labelled.groupBy("dq_key", "dq_issue").agg(metrics.rows())


@query("inc_keys")
def inc_keys(spark, folder):
    house = warehouse_of(spark, folder)
    incoming = _batches(spark, folder).select("customer_id").distinct().unionByName(
        house.silver.select("customer_id").distinct()
    ).distinct()
    existing = house.customers
    return keys.extend_keys(existing, incoming, "customer_id", "customer_key")


@query("inc_rename_scd2")
def inc_rename_scd2(spark, folder):
    """Merchant names with history, kept by the version operator."""
    batches = _batches(spark, folder)
    first = datetime(2024, 1, 1)
    start = dimensions.build_dimension(
        batches.groupBy("merchant_id").agg(F.min("merchant_name").alias("merchant_name")),
        "merchant_id", "merchant_key",
        schemas.DIM_MERCHANTS + ", effective_start_date timestamp, "
        "effective_end_date timestamp, is_current boolean",
        {"effective_start_date": conform.audit_time(first), "is_current": F.lit(True),
         "is_active": F.lit(False)},
        first,
    )
    versions = scd.scd2_apply(
        stage(start, "merchants_before"), batches, "merchant_id", "merchant_key",
        ["merchant_name"], "transaction_timestamp", LOADED,
    )
    return versions.select(
        "merchant_key", "merchant_id", "merchant_name",
        F.col("effective_start_date").cast("timestamp_ntz").alias("effective_start_date"),
        F.col("effective_end_date").cast("timestamp_ntz").alias("effective_end_date"),
        "is_current",
    )


# --- generator: one synthetic row per event ------------------------------------------------------


#: Synthetic rows that one task draws.
ROWS_PER_DRAWING_TASK = 200_000


@shared
def _generated(spark: SparkSession, folder: str) -> DataFrame:
    """Synthetic days as large as the days of the events, defects by day of month modulo 3."""
    events = read_table(spark, folder, "events").select(
        F.to_date("ts").alias("day"), "event_id"
    )
    placed = with_positions(events, "day", "event_id")
    spans = placed.groupBy("day").agg(
        F.min("position").alias("_first"), F.count(F.lit(1)).alias("day_rows")
    )
    # one row per calendar day
    sequenced = placed.join(F.broadcast(spans), "day").select(
        "day", (F.col("position") - F.col("_first") + 1).alias("sequence"), "day_rows"
    )
    plans = [generate.CLEAN_DAY, generate.LATE_DAY, generate.RENAME_DAY]
    kind = F.pmod(F.dayofmonth("day") - 1, F.lit(3))
    # few narrow columns that become many: the work is in the draws, so tasks are made for it
    tasks = max(spark.sparkContext.defaultParallelism, -(-events.count() // ROWS_PER_DRAWING_TASK))
    dealt = sequenced.repartition(tasks, "day", "sequence")
    with compiled_methods(spark):
        return stage(generate.fill_rows(generate.with_segments(dealt, plans, kind)), "generated")


def _is_moved() -> Column:
    """The event time is the drawn moment of the day less the shift; drawn again to compare."""
    drawn = draws.uniform(42, "time", F.col("batch_day"), F.substring("transaction_id", 14, 20).cast("bigint"))
    moment = F.col("batch_day").cast("timestamp_ntz") + draws.second_of_day(drawn)
    return shift_minutes(F.col("transaction_timestamp"), EST_SHIFT_MINUTES) == moment


@query("gen_batch_profile")
def gen_batch_profile(spark, folder):
    return _generated(spark, folder).groupBy("batch_day").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("transaction_id").alias("unique_transactions"),
        F.min("transaction_id").alias("first_id"),
        F.max("transaction_id").alias("last_id"),
        F.count_if(quality.is_update_missing()).alias("null_updated_rows"),
        F.count_if(quality.is_renamed()).alias("renamed_rows"),
        F.count_if(quality.is_late() & (F.col("segment") != "zone_shifted")).alias("late_rows"),
        F.count_if(_is_moved()).alias("zone_shifted_rows"),
    )


@query("gen_rows")
def gen_rows(spark, folder):
    """Every generated row with all its columns."""
    return shown(_generated(spark, folder))


@query("gen_shares")
def gen_shares(spark, folder):
    """Shares of the drawn categories."""
    rows = _generated(spark, folder)
    names = ["payment_method", "transaction_status", "device_type", "location_type",
             "product_category"]
    long = rows.select(
        F.explode(F.array(*(F.struct(F.lit(n).alias("column_name"), F.col(n).alias("value"))
                            for n in names))).alias("v")
    ).select("v.*")
    total = rows.select(F.count(F.lit(1))).scalar()
    counted = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))
    return counted.withColumn("percentage", percent_2dp(F.col("row_count"), total))


@query("gen_amounts")
def gen_amounts(spark, folder):
    rows = _generated(spark, folder)
    return rows.groupBy("transaction_status").agg(
        metrics.rows(),
        as_double(F.min("amount")).alias("min_amount"),
        as_double(F.max("amount")).alias("max_amount"),
        average_2dp(F.sum("amount"), F.count("amount")).alias("avg_amount"),
        percent_2dp(F.sum("fee_amount"), F.sum("amount")).alias("fee_pct"),
        percent_2dp(F.sum("cashback_amount"), F.sum("amount")).alias("cashback_pct"),
        F.sum("loyalty_points").alias("loyalty_points"),
    )


@query("gen_defects")
def gen_defects(spark, folder):
    """What the detectors find in generated days."""
    return quality.batch_defects(_generated(spark, folder))


# --- files ---------------------------------------------------------------------------------------


def _raw_rows(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_transactions(spark, folder)
    columns = schemas.column_types(schemas.RAW_TRANSACTIONS)
    return raw.withColumn("idx", F.lit(None).cast("bigint")).select(
        *(F.col(c).cast(t).alias(c) for c, t in columns.items())
    )


def _raw_files(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "raw_csv")
    files.write_raw_csv(_raw_rows(spark, folder), path, compressed=True)
    return path


def _raw_profile(raw: DataFrame) -> DataFrame:
    silver = conform.conform_raw(raw, load_ts=LOADED)
    return silver.groupBy("payment_method", "transaction_status").agg(
        metrics.rows(),
        metrics.summed("amount", "total_amount"),
        metrics.summed("fee_amount", "total_fees"),
        metrics.summed("cashback_amount", "total_cashback"),
        F.sum("loyalty_points").alias("loyalty_points"),
        F.min("transaction_timestamp").alias("first_event"),
        F.max("transaction_timestamp").alias("last_event"),
    )


@query("src_raw_csv")
def src_raw_csv(spark, folder):
    raw = files.read_raw_csv(spark, _raw_files(spark, folder))
    return _raw_profile(files.good_rows(raw))


@query("src_raw_csv_detected")
def src_raw_csv_detected(spark, folder):
    detected = files.read_raw_csv_detected(spark, _raw_files(spark, folder))
    return _raw_profile(files.good_rows(detected))


def _faulty_files(spark: SparkSession, folder: str) -> str:
    """Files in which every seventh number of points breaks its amount."""
    fault = F.pmod("loyalty_points", F.lit(7)) == 3
    amount = F.when(fault, F.lit("n/a")).otherwise(F.col("product_amount").cast("string"))
    path = scratch_path(spark, "raw_csv_faults")
    files.write_raw_csv(_raw_rows(spark, folder).withColumn("product_amount", amount), path, compressed=True)
    return path


def _good_and_broken(good: DataFrame, broken: DataFrame) -> DataFrame:
    good = good.withColumns({"is_broken": F.lit(False), "line": F.lit("")})
    broken = broken.select("parsed.*", F.lit(True).alias("is_broken"), "line")
    return good.unionByName(broken).groupBy("is_broken", "payment_method").agg(
        metrics.rows(),
        as_double(F.sum(F.col("transaction_fee").cast("decimal(18,2)"))).alias("total_fees"),
        F.sum("loyalty_points").alias("loyalty_points"),
        F.count_if(F.contains("line", F.lit("n/a"))).alias("lines_with_the_fault"),
    )


@query("src_raw_csv_quarantine")
def src_raw_csv_quarantine(spark, folder):
    """Good and broken lines of files with faults."""
    lines = files.read_raw_csv(spark, _faulty_files(spark, folder))
    return _good_and_broken(files.good_rows(lines), files.broken_rows(lines))


@query("bronze_load")
def bronze_load(spark, folder):
    """The same files loaded into the bronze table and the table of broken lines."""
    loaded = load_bronze(spark, _faulty_files(spark, folder), "tallyhouse_load_", scratch_path(spark, "bronze"))
    return _good_and_broken(*loaded)


@query("src_batch_csv_quarantine")
def src_batch_csv_quarantine(spark, folder):
    """Good and broken lines of daily batches in which every ninth event breaks its amount."""
    batches = _batches(spark, folder).withColumn("day", F.col("batch_day"))
    n = F.substring("transaction_id", 5, 20).cast("bigint")
    amount = F.when(F.pmod(n, F.lit(9)) == 4, F.lit("n/a")).otherwise(F.col("amount").cast("string"))
    rows = batches.select(*schemas.column_types(schemas.DAILY_BATCH), "day").withColumn("amount", amount)
    path = scratch_path(spark, "batch_csv_faults")
    files.write_csv(rows.hint("rebalance", "day"), path, ["day"])
    lines = files.read_batch_csv(spark, path, DAY_FOLDER)
    broken = files.broken_rows(lines).select("parsed.batch_day", "parsed.amount", F.lit(True).alias("is_broken"))
    good = files.good_rows(lines).select("batch_day", "amount", F.lit(False).alias("is_broken"))
    return good.unionByName(broken).groupBy("batch_day", "is_broken").agg(
        metrics.rows(), as_double(F.sum(F.col("amount").cast("decimal(18,2)"))).alias("total_amount")
    )


def _batch_files(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "batch_csv")
    batches = _batches(spark, folder).withColumn("day", F.col("batch_day"))
    rows = batches.select(*schemas.column_types(schemas.DAILY_BATCH), "day")
    files.write_csv(rows.hint("rebalance", "day"), path, ["day"])
    return path


DAY_FOLDER = r"day=(\d{4}-\d{2}-\d{2})"


@query("src_batch_csv")
def src_batch_csv(spark, folder):
    path = _batch_files(spark, folder)
    batches = files.good_rows(files.read_batch_csv(spark, path, DAY_FOLDER))
    return batches.groupBy("batch_day").agg(
        metrics.rows(),
        as_double(F.sum(F.col("amount").cast("decimal(18,2)"))).alias("total_amount"),
        F.count("updated_at").alias("updated_rows"),
        F.min("transaction_timestamp").alias("first_event"),
    )


@query("snk_report")
def snk_report(spark, folder):
    """The check report written as JSON lines and read back."""
    house = warehouse_of(spark, folder)
    path = scratch_path(spark, "report")
    report = quality.quality_report(house.silver, house.fact, house.dims)
    files.write_report(report, path)
    return spark.read.schema(report.schema).json(path)


@query("snk_table")
def snk_table(spark, folder):
    """A catalog table created, then replaced by a query on itself."""
    name, root = "tallyhouse_reports.method_counts", scratch_path(spark, "replaced")
    tables.create_database(spark, "tallyhouse_reports", root)
    counts = quality.value_counts(warehouse_of(spark, folder).fact, "payment_method_key")
    tables.replace_table(counts, name, root=root)
    doubled = spark.table(name).withColumn("transaction_count", F.col("transaction_count") * 2)
    return tables.replace_table(doubled, name, root=root)


@query("snk_view")
def snk_view(spark, folder):
    """A partitioned dataset behind a view, replaced by a query on itself with other partitions and columns."""
    name, root = "tallyhouse_reports.method_days", scratch_path(spark, "viewed")
    tables.create_database(spark, "tallyhouse_reports", root)
    fact = warehouse_of(spark, folder).fact
    by_day = fact.groupBy("payment_method_key", "date_key").agg(metrics.rows(), metrics.summed("amount", "total_amount"))
    tables.replace_view(by_day, name, ["payment_method_key"], root)
    by_year = spark.table(name).groupBy("payment_method_key", F.floor(F.col("date_key") / 10000).alias("year"))
    years = by_year.agg(F.sum("transaction_count").alias("transaction_count"), F.max("transaction_count").alias("most_in_a_day"))
    return tables.replace_view(years, name, ["year"], root)


# --- streams over the events ---------------------------------------------------------------------


SPANS, FILES = 4, 2
#: Rows of a delivered file, which one task writes.
ROWS_PER_FILE = 250_000


def _in_spans(batches: DataFrame) -> list[DataFrame]:
    """The batches of four spans of days, in order."""
    lo, hi = batches.agg(F.min("batch_day"), F.max("batch_day")).head()
    span = F.floor(F.datediff("batch_day", F.lit(lo)) * SPANS / (F.datediff(F.lit(hi), F.lit(lo)) + 1))
    return [batches.filter(span == i) for i in range(SPANS)]


def _most_rows(parts: list[DataFrame]) -> int:
    """Rows of the largest part."""
    numbered = reduce(DataFrame.union, [p.select(F.lit(i).alias("part")) for i, p in enumerate(parts)])
    return numbered.groupBy("part").count().agg(F.max("count")).head()[0] or 0


def _delivered(spark: SparkSession, parts: list[DataFrame], most: int = 0, count: int = FILES) -> DataFrame:
    """A stream that takes one part, of so many files, per trigger; more files for ``most`` rows in a part."""
    count = max(count, -(-most // ROWS_PER_FILE))
    path = scratch_path(spark, "delivered")
    for part in parts:
        part.repartition(count).write.mode("append").parquet(path)
    stream = spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", count)
    return stream.parquet(path)


def _too_late(first: DataFrame) -> DataFrame:
    """Rows of the first day under new ids; at the end of the stream the watermark drops them."""
    day = first.select(F.min("batch_day")).scalar()
    name = F.concat(F.lit("TOO-LATE-"), F.col("transaction_id"))
    return first.filter(F.col("batch_day") == day).withColumn("transaction_id", name)


@query("st_ingest")
def st_ingest(spark, folder):
    """CSV drops ingested as a stream, conformed and written as files."""
    source = _batch_files(spark, folder)
    lines = drops.read_drops(spark, source, DAY_FOLDER, files_per_trigger=8)
    stream = conform.conform_batch(files.good_rows(lines), load_ts=LOADED)
    path, mark = scratch_path(spark, "ingested"), scratch_path(spark, "mark")
    drops.append_to_files(stream, path, mark)
    return spark.read.parquet(path).groupBy("batch_day", "batch_id").agg(
        metrics.rows(), metrics.summed("amount", "total_amount")
    )


@query("st_daily_totals")
def st_daily_totals(spark, folder):
    """Totals over five triggers; the last one brings rows that the watermark drops."""
    spans = _in_spans(_batches(spark, folder))
    most = _most_rows(spans)
    totals = drops.daily_totals(_delivered(spark, [*spans, _too_late(spans[0])], most))
    path, mark = scratch_path(spark, "totals"), scratch_path(spark, "mark")
    state = drops.state_partitions(spark, most)
    return shown(drops.merge_totals(totals, path, mark, "event_date", most_deltas=3, partitions=state).read())


@query("st_dedup")
def st_dedup(spark, folder):
    """Every fifth event delivered again a trigger later; each id is counted once."""
    spans = _in_spans(_batches(spark, folder))
    again = [s.filter(F.pmod(F.col("amount") * 100, F.lit(5)) == 0) for s in spans]
    parts = [spans[0], *(s.unionByName(r) for s, r in zip(spans[1:], again)), again[-1]]
    most = _most_rows(parts)
    unique = drops.without_repeats(_delivered(spark, parts, most))
    path, mark = scratch_path(spark, "unique"), scratch_path(spark, "mark")
    kept = unique.select("transaction_id", "batch_day", "amount")
    drops.append_to_files(kept, path, mark, partitions=drops.state_partitions(spark, most))
    return spark.read.parquet(path).groupBy("batch_day").agg(
        metrics.rows(), metrics.summed("amount", "total_amount")
    )


@query("st_lookup")
def st_lookup(spark, folder):
    dim = sent_when_small(warehouse_of(spark, folder).merchants)
    spans = _in_spans(_batches(spark, folder))
    stream = _delivered(spark, spans, _most_rows(spans))
    keyed = drops.with_dimension(stream, dim, "merchant_id", "merchant_id", "merchant_key")
    path, mark = scratch_path(spark, "keyed"), scratch_path(spark, "mark")
    drops.append_to_files(keyed.select("merchant_key", "transaction_id", "amount"), path, mark)
    return spark.read.parquet(path).groupBy("merchant_key").agg(
        metrics.rows(), metrics.summed("amount", "total_amount")
    )


@query("st_lookup_changing")
def st_lookup_changing(spark, folder):
    """Every third merchant is known; others are announced a day or ten days after their first event.

    An announcement is delivered a trigger after the events of its span and repeated in the next one with a later time.
    Facts from two days before the announcement on find their merchant.
    """
    batches = _batches(spark, folder)
    dim = sent_when_small(warehouse_of(spark, folder).merchants).select("merchant_id", "merchant_key")
    kind = F.pmod("merchant_key", F.lit(3))
    firsts = batches.groupBy("merchant_id").agg(F.min("transaction_timestamp").alias("first_event"))
    days = F.when(kind == 1, 1).otherwise(10)
    new = stage(
        dim.filter(kind != 0).join(firsts, "merchant_id")
        .withColumn("announced_at", F.col("first_event") + F.make_dt_interval(days=days)).drop("first_event"),
        "announced",
    )
    lo, hi = batches.agg(F.min("batch_day"), F.max("batch_day")).head()
    span = F.floor(F.datediff("announced_at", F.lit(lo)) * SPANS / (F.datediff(F.lit(hi), F.lit(lo)) + 1))
    of_span = [new.filter(F.least(F.greatest(span, F.lit(0)), F.lit(SPANS - 1)) == i) for i in range(SPANS)]
    again = [s.withColumn("announced_at", F.col("announced_at") + F.make_dt_interval(days=F.lit(1))) for s in of_span]

    def quiet(at: Column) -> DataFrame:
        """An announcement of no one, which only moves the watermark."""
        return spark.range(1).select(
            F.lit(None).cast("string").alias("merchant_id"), F.lit(None).cast("bigint").alias("merchant_key"),
            at.cast("timestamp_ntz").alias("announced_at"),
        )

    start, end = F.lit(lo), F.date_add(F.lit(hi), 60)
    told = [quiet(start)]
    for i, part in enumerate(of_span):
        told.append((part.unionByName(again[i - 1]) if i else part).unionByName(quiet(start)))
    told[-1] = told[-1].unionByName(quiet(end))
    last = spark.range(1).select(*(
        (end if f.name == "transaction_timestamp" else F.lit(None)).cast(f.dataType).alias(f.name) for f in batches.schema
    ))
    spans = _in_spans(batches)
    most = _most_rows(spans)
    keyed = drops.with_changing_dimension(
        _delivered(spark, [*spans, last], most), dim.filter(kind == 0), _delivered(spark, told, count=1),
        "merchant_id", "merchant_id", "merchant_key",
    )
    path, mark = scratch_path(spark, "keyed"), scratch_path(spark, "mark")
    rows = keyed.select("merchant_key", "transaction_id", "amount")
    drops.append_to_files(rows, path, mark, partitions=drops.state_partitions(spark, most))
    return spark.read.parquet(path).filter(F.col("transaction_id").isNotNull()).groupBy("merchant_key").agg(
        metrics.rows(), metrics.summed("amount", "total_amount")
    )


@query("st_upsert")
def st_upsert(spark, folder):
    """Events, and a trigger later their corrections; the newest row per id is kept, merged when read."""
    spans = _in_spans(_batches(spark, folder))
    late = [_corrections(s) for s in spans]
    parts = [spans[0], *(s.unionByName(r) for s, r in zip(spans[1:], late)), late[-1]]
    path, mark = scratch_path(spark, "merged"), scratch_path(spark, "mark")
    # compacted once on the way
    table = drops.merge_stream(_delivered(spark, parts, _most_rows(parts)), path, mark, most_deltas=4)
    return table.read().groupBy("event_date").agg(
        metrics.rows(), metrics.summed("amount", "total_amount")
    )


@query("st_upsert_partitions")
def st_upsert_partitions(spark, folder):
    """The same, with the partitions that a trigger touches rewritten in it."""
    spans = _in_spans(_batches(spark, folder))
    late = [_corrections(s) for s in spans]
    parts = [spans[0], *(s.unionByName(r) for s, r in zip(spans[1:], late)), late[-1]]
    path, mark = scratch_path(spark, "upserted"), scratch_path(spark, "mark")
    # a correction never changes the event's time
    drops.upsert_stream(_delivered(spark, parts, _most_rows(parts)), path, mark, keys_stay=True)
    return spark.read.parquet(path).groupBy("event_date").agg(
        metrics.rows(), metrics.summed("amount", "total_amount")
    )
