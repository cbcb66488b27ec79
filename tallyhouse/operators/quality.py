"""Data-quality checks.

Plain checks return the table a person would read. :func:`long_form` turns any one-row table of
numbers into (check, subject, value, expected, passed), so reports of all checks can be stacked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.fixed_values import EST_SHIFT_MINUTES, RENAME_KEYWORDS
from tallyhouse.functions.dates import day_start, shift_minutes
from tallyhouse.functions.money import percent_2dp
from tallyhouse.operators.fact import FOREIGN_KEYS, Dimensions

RENAME_PATTERN = "|".join(RENAME_KEYWORDS)


def count() -> Column:
    return F.count(F.lit(1))


def long_form(one_row: DataFrame, check: str, expected: dict[str, Column] | int | None) -> DataFrame:
    """A one-row table of whole numbers as one line per column.

    ``expected`` is one number for all, or a column per subject computed from the same row;
    without it lines neither pass nor fail.
    """
    subjects = one_row.columns

    def line(c: str) -> Column:
        wanted = expected.get(c, F.lit(None)) if isinstance(expected, dict) else F.lit(expected)
        return F.struct(
            F.lit(check).alias("check"),
            F.lit(c).alias("subject"),
            F.col(c).cast("bigint").alias("value"),
            wanted.cast("bigint").alias("expected"),
        )

    lines = one_row.select(F.explode(F.array(*map(line, subjects))).alias("line"))
    return lines.select("line.*").withColumn("passed", F.col("value") == F.col("expected"))


def row_counts(**tables: DataFrame) -> DataFrame:
    """Row counts side by side, one column per table; Parquet footers suffice for them."""
    first, *others = tables.items()
    counted = first[1].agg(count().alias(first[0]))
    # every further count is a scalar subquery: one number, nothing is joined
    for name, table in others:
        counted = counted.withColumn(name, table.select(count()).scalar())
    return counted


def row_reconciliation(silver: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows of both layers and their difference."""
    counted = row_counts(silver_count=silver, fact_count=fact)
    return counted.withColumn("difference", F.col("fact_count") - F.col("silver_count"))


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*keys).agg(count().alias("row_count")).filter(F.col("row_count") > 1)


def dimension_duplicates(dims: Dimensions) -> DataFrame:
    """Natural keys that occur twice among the current rows, over the natural-key dimensions."""
    found = [
        duplicates(dim.select(F.col(natural).cast("string").alias("natural_key")), "natural_key")
        .select(F.lit(name).alias("dimension"), "natural_key", "row_count")
        for name, (dim, natural, _) in dims.natural_keys().items()
        if name != "dim_date"
    ]
    return reduce(DataFrame.unionByName, found)


def foreign_key_completeness(fact: DataFrame) -> DataFrame:
    """Total rows and non-NULL rows per foreign key in one scan."""
    filled = [F.count(k).alias("has_" + k.removesuffix("_key")) for k in FOREIGN_KEYS]
    return fact.agg(count().alias("total_rows"), *filled)


def null_foreign_keys(fact: DataFrame) -> DataFrame:
    """NULL foreign keys per dimension: one scan, then one line per key."""
    nulls = fact.agg(*(F.count_if(F.col(k).isNull()).alias(k) for k in FOREIGN_KEYS))
    return nulls.unpivot([], FOREIGN_KEYS, "dimension", "null_count")


def orphans(silver: DataFrame, dim: DataFrame, on: str, natural_key: str) -> DataFrame:
    """Natural keys without a dimension row; NULL counts as one of them.

    Keys are made distinct before the join, which takes hot keys out of it.
    """
    keys = silver.select(on).distinct()
    known = dim.select(F.col(natural_key).alias("_known"))
    return keys.join(known, keys[on] == F.col("_known"), "left_anti")


def date_range(rows: DataFrame, moment: str = "transaction_timestamp") -> DataFrame:
    day = F.to_date(moment)
    return rows.agg(F.min(day).alias("earliest_date"), F.max(day).alias("latest_date"))


def out_of_calendar(rows: DataFrame, calendar: DataFrame, moment: str) -> DataFrame:
    """Rows per day for days that the calendar lacks (rows without a time included)."""
    per_day = rows.groupBy(F.to_date(moment).alias("transaction_date")).agg(
        count().alias("row_count")
    )
    days = F.broadcast(calendar.select("full_date"))
    return per_day.join(days, per_day["transaction_date"] == days["full_date"], "left_anti")


def with_measure_checks(fact: DataFrame) -> DataFrame:
    """Every derived measure recomputed: OK or ERROR per row, beside the fact's columns."""

    def verdict(stored: str, computed: Column) -> Column:
        return F.when(F.col(stored) == computed, "OK").otherwise("ERROR")

    amount, fee, cashback = (F.col(c) for c in ("amount", "fee_amount", "cashback_amount"))
    return fact.withColumns(
        {
            "net_customer_check": verdict("net_customer_amount", amount - cashback),
            "merchant_net_check": verdict("merchant_net_amount", amount - fee),
            "gateway_revenue_check": verdict("gateway_revenue", fee - cashback),
        }
    )


def measure_check(fact: DataFrame) -> DataFrame:
    """The verdicts per transaction."""
    checks = ("net_customer_check", "merchant_net_check", "gateway_revenue_check")
    return with_measure_checks(fact).select("transaction_id", *checks)


def measure_summary(fact: DataFrame) -> DataFrame:
    """Rows per combination of verdicts."""
    checks = ["net_customer_check", "merchant_net_check", "gateway_revenue_check"]
    return measure_check(fact).groupBy(*checks).agg(count().alias("row_count"))


def key_range(dim: DataFrame, key: str) -> DataFrame:
    return dim.agg(
        F.min(key).alias("min_key"),
        F.max(key).alias("max_key"),
        F.countDistinct(key).alias("unique_keys"),
    )


def name_variations(silver: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` merchants with most distinct names, and the names.

    Names are listed for the chosen merchants only, and made distinct within the tasks first, so
    a merchant with very many rows is no burden.
    """
    counted = (
        silver.groupBy("merchant_id")
        .agg(F.countDistinct("merchant_name").alias("name_variations"))
        .filter(F.col("name_variations") > 1)
    )
    chosen = counted.orderBy(F.desc("name_variations"), "merchant_id").limit(k)
    # k rows
    named = silver.select("merchant_id", "merchant_name").join(F.broadcast(chosen), "merchant_id")
    listed = named.groupBy("merchant_id", "name_variations").agg(
        F.array_join(F.array_sort(F.collect_set("merchant_name")), ", ").alias("all_names")
    )
    return listed.orderBy(F.desc("name_variations"), "merchant_id")


def distribution(rows: DataFrame, *by: str) -> DataFrame:
    """Rows per value and their share of all rows in percent.

    The total is a scalar subquery over the same groups, so no window gathers them in one task
    and the shuffle of the counts serves both.
    """
    counted = rows.groupBy(*by).agg(count().alias("transaction_count"))
    total = counted.select(F.sum("transaction_count")).scalar()
    return counted.withColumn("percentage", percent_2dp(F.col("transaction_count"), total))


def value_counts(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(count().alias("transaction_count"))


def constant_columns(silver: DataFrame) -> DataFrame:
    """Coverage of the constant columns and the span of load times."""
    return silver.agg(
        F.countDistinct("currency").alias("unique_currencies"),
        F.min("loaded_at").alias("first_load_time"),
        F.max("loaded_at").alias("last_load_time"),
        F.countDistinct("source_system").alias("unique_sources"),
    )


def critical_nulls(silver: DataFrame) -> DataFrame:
    return silver.agg(
        count().alias("total_rows"),
        F.count("transaction_id").alias("non_null_tx_id"),
        F.count("customer_id").alias("non_null_customer"),
        F.count("merchant_id").alias("non_null_merchant"),
        F.count("amount").alias("non_null_amount"),
    )


# --- daily batches ---------------------------------------------------------------------------


def is_late() -> Column:
    """The event happened before the day of its batch."""
    return F.col("transaction_timestamp") < day_start(F.col("batch_day"))


def is_update_missing() -> Column:
    return F.col("updated_at").isNull()


def is_renamed() -> Column:
    """The merchant name holds a word of a legal form; a missing name is not renamed."""
    return F.coalesce(F.col("merchant_name").rlike(RENAME_PATTERN), F.lit(False))


ZONE_MODES = ("none", "day_border", "any_lag", "fixed_lag")


def is_zone_shifted(mode: str | Column = "day_border") -> Column:
    """Event time in another zone than the update time.

    ``day_border`` sees only rows moved across midnight. ``any_lag`` takes every row whose two
    times differ, for batches without late rows. ``fixed_lag`` takes exactly the known shift, for
    feeds that stamp the update at the time of the event. ``none`` is for batches known to have no
    shift. A column gives the mode of each row, see :func:`with_zone_mode`.
    """
    event, update = F.col("transaction_timestamp"), F.col("updated_at")
    tests = {
        "none": F.lit(False),
        "day_border": is_late(),
        "any_lag": F.coalesce(event != update, F.lit(False)),
        "fixed_lag": F.coalesce(shift_minutes(event, EST_SHIFT_MINUTES) == update, F.lit(False)),
    }
    if isinstance(mode, str):
        if mode not in tests:
            raise ValueError(f"unknown mode: {mode}")
        return tests[mode]
    return F.coalesce(*(F.when(mode == name, test) for name, test in tests.items()), F.lit(False))


def with_zone_mode(batches: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds ``zone_mode`` from a plan with ``batch_day`` and ``zone_mode``; days not in it have none.

    Late rows and shifted rows look alike, so which of them a batch holds must be known.
    """
    days = plan.select(F.col("batch_day").alias("_day"), "zone_mode")
    # one row per day
    return batches.join(F.broadcast(days), F.col("batch_day") == F.col("_day"), "left").drop("_day")


def batch_defects(batches: DataFrame, zone_mode: str | Column = "day_border") -> DataFrame:
    """Rows and defects per batch in one aggregation.

    ``clean_rows`` is the total minus the issues; a shifted row that is also late by date is
    subtracted once.
    """
    shifted = is_zone_shifted(zone_mode)
    counted = batches.groupBy("batch_day").agg(
        count().alias("total_rows"),
        F.count_if(is_late()).alias("late_rows"),
        F.count_if(is_update_missing()).alias("null_updated_rows"),
        F.count_if(is_renamed()).alias("renamed_rows"),
        F.count_if(shifted).alias("zone_shifted_rows"),
        F.count_if(shifted & ~is_late()).alias("_shifted_only"),
    )
    issues = (
        F.col("late_rows") + F.col("null_updated_rows") + F.col("renamed_rows")
        + F.col("_shifted_only")
    )
    return counted.withColumn("clean_rows", F.col("total_rows") - issues).drop("_shifted_only")


def batch_profile(batches: DataFrame) -> DataFrame:
    """Size, distinct ids, time span and status shares of every batch.

    The distinct counts are merged from one row per batch and value, so one big batch is spread
    over many tasks before its counts meet.
    """
    plain = batches.groupBy("batch_day").agg(
        count().alias("total_rows"),
        F.min("transaction_timestamp").alias("first_event"),
        F.max("transaction_timestamp").alias("last_event"),
        F.count_if(is_update_missing()).alias("null_updated_rows"),
        *(
            F.count_if(F.col("transaction_status") == s).alias(f"{s.lower()}_rows")
            for s in ("Successful", "Failed", "Pending")
        ),
    )
    values = batches.select(
        "batch_day",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(i).alias("kind"), F.col(c).alias("value"))
                    for i, c in enumerate(("transaction_id", "customer_id", "merchant_id"))
                )
            )
        ).alias("v"),
    ).select("batch_day", "v.kind", "v.value").distinct()
    distinct = values.groupBy(F.col("batch_day").alias("_day")).agg(
        *(
            F.count(F.when(F.col("kind") == i, F.col("value"))).alias(name)
            for i, name in enumerate(
                ("unique_transactions", "unique_customers", "unique_merchants")
            )
        )
    )
    joined = plain.join(distinct, plain["batch_day"].eqNullSafe(F.col("_day"))).drop("_day")
    shares = {
        f"{s}_pct": percent_2dp(F.col(f"{s}_rows"), F.col("total_rows"))
        for s in ("successful", "failed", "pending")
    }
    return joined.withColumns(shares)


def batch_report(batches: DataFrame, zone_mode: str | Column = "day_border") -> DataFrame:
    """Counts per batch in long form, and the totals of all batches on lines without a batch.

    ``issue_rows`` is what is not clean: a row that shows as late and as shifted counts once.
    """
    defects = batch_defects(batches, zone_mode)
    kinds = ["late_rows", "null_updated_rows", "renamed_rows", "zone_shifted_rows"]
    lines = defects.unpivot(
        ["batch_day"], ["total_rows", *kinds, "clean_rows"], "check", "value"
    )
    totals = defects.agg(
        *(F.sum(c).alias(c) for c in ("total_rows", *kinds)),
        F.sum(F.col("total_rows") - F.col("clean_rows")).alias("issue_rows"),
    )
    overall = totals.unpivot([], totals.columns, "check", "value").select(
        F.lit(None).cast("date").alias("batch_day"), "check", "value"
    )
    return lines.unionByName(overall)


def repeated_ids(batches: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Across all batches: rows, distinct ids, surplus occurrences, and whether ids are unique.

    A missing id counts as one more value for the surplus, but not as an id.
    """
    per_id = batches.groupBy(key).agg(count().alias("n"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(key).alias("unique_ids"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"),
    ).withColumn("all_unique", F.col("unique_ids") == F.col("total_rows"))


# --- checks over the whole warehouse ---------------------------------------------------------


def fan_out(silver: DataFrame, fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Surplus fact rows, and per dimension the natural keys that would multiply rows."""
    surplus = row_reconciliation(silver, fact).select(
        F.lit("fact_transactions").alias("subject"), F.col("difference").alias("surplus")
    )
    per_dim = []
    for name, (dim, natural, _) in dims.natural_keys().items():
        repeats = duplicates(dim.select(natural), natural)
        per_dim.append(
            repeats.agg(F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("surplus"))
            .select(F.lit(name).alias("subject"), "surplus")
        )
    return reduce(DataFrame.unionByName, [surplus, *per_dim]).withColumn(
        "passed", F.col("surplus") == 0
    )


def expected_counts(expected: dict[str, int | None], **tables: DataFrame) -> DataFrame:
    """Row counts against expected ones; a table without an expectation only reports."""
    wanted = {name: F.lit(expected.get(name)) for name in tables}
    return long_form(row_counts(**tables), "row_count", wanted)


def schema_conformance(table: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Per column: actual and expected type, and how many rows hold a value.

    Missing columns have a NULL type, unexpected ones a NULL expectation.
    """
    actual = dict(table.dtypes)
    names = [*expected, *(c for c in actual if c not in expected)]
    filled = table.agg(
        *((F.count(F.col(c)) if c in actual else F.lit(0)).alias(c) for c in names)
    )

    def line(c: str) -> Column:
        return F.struct(
            F.lit(c).alias("column_name"),
            F.lit(actual.get(c)).cast("string").alias("data_type"),
            F.lit(expected.get(c)).cast("string").alias("expected_type"),
            F.lit(actual.get(c) == expected.get(c)).alias("passed"),
            F.col(c).cast("bigint").alias("non_null_rows"),
        )

    return filled.select(F.explode(F.array(*map(line, names))).alias("line")).select("line.*")


def quality_report(silver: DataFrame, fact: DataFrame, dims: Dimensions) -> DataFrame:
    """The main checks of a build in long form."""
    measures = ("net_customer_check", "merchant_net_check", "gateway_revenue_check")
    checked = with_measure_checks(fact)
    # NULL keys, measures and the number of rows in one pass over the fact
    once = checked.agg(
        count().alias("fact_count"),
        *(F.count_if(F.col(k).isNull()).alias(k) for k in FOREIGN_KEYS),
        *(F.count_if(F.col(c) == "ERROR").alias(c) for c in measures),
    ).withColumn("_silver_count", silver.select(count()).scalar())
    lines = [("row_count", "fact_count", F.col("_silver_count"))]
    lines += [("null_foreign_key", k, F.lit(0)) for k in FOREIGN_KEYS]
    lines += [("derived_measure", c, F.lit(0)) for c in measures]
    long = once.select(
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(check).alias("check"), F.lit(subject).alias("subject"),
                        F.col(subject).cast("bigint").alias("value"),
                        expected.cast("bigint").alias("expected"),
                    )
                    for check, subject, expected in lines
                )
            )
        ).alias("line")
    ).select("line.*").withColumn("passed", F.col("value") == F.col("expected"))
    reports = [
        long,
        long_form(repeated_ids(fact).select(F.col("extra_rows").alias("transaction_id")),
                  "duplicate_id", 0),
        fan_out(silver, fact, dims).filter(F.col("subject") != "fact_transactions").select(
            F.lit("duplicate_natural_key").alias("check"), "subject",
            F.col("surplus").cast("bigint").alias("value"),
            F.lit(0).cast("bigint").alias("expected"), "passed",
        ),
    ]
    return reduce(DataFrame.unionByName, reports)
