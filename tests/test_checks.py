from datetime import date
from decimal import Decimal

import pytest
from conftest import tuples
from fixtures import AT, batches, silver, star, ts
from pyspark.sql import functions as F

from tallyhouse.operators import quality
from tallyhouse.operators.fact import Dimensions, build_fact
from tallyhouse.plans import reports


def test_fan_out_names_the_dimension(spark):
    table, dims, _ = star(spark, [{"merchant_id": "M1"}, {"merchant_id": "M1"}, {"merchant_id": "M2"}])
    twice = Dimensions(dims.customers, dims.merchants.unionByName(dims.merchants.filter("merchant_id = 'M1'")),
                       dims.payment_methods, dims.transaction_status, dims.location, dims.date)
    fact = build_fact(table, twice, AT)
    assert tuples(quality.row_reconciliation(table, fact)) == [(3, 5, 2)]
    found = tuples(quality.fan_out(table, fact, twice).filter("NOT passed").select("subject", "surplus"))
    assert found == [("dim_merchants", 1), ("fact_transactions", 2)]
    assert tuples(quality.dimension_duplicates(twice)) == [("dim_merchants", "M1", 2)]


def test_closed_versions_are_not_duplicates(spark):
    _, dims, _ = star(spark, [{}])
    closed = dims.customers.withColumn("is_current", F.lit(False))
    history = Dimensions(dims.customers.unionByName(closed), dims.merchants, dims.payment_methods,
                         dims.transaction_status, dims.location, dims.date)
    assert quality.dimension_duplicates(history).count() == 0


def test_null_keys_and_orphans(spark):
    table, dims, fact = star(spark, [{"customer_id": None}, {"merchant_id": None}, {"customer_id": "U9"}])
    nulls = {r[0]: r[1] for r in quality.null_foreign_keys(fact).collect()}
    assert nulls == {"customer_key": 1, "merchant_key": 1, "payment_method_key": 0, "status_key": 0, "location_key": 0, "date_key": 0}
    assert tuples(quality.foreign_key_completeness(fact)) == [(3, 2, 2, 3, 3, 3, 3)]
    fewer = dims.customers.filter("customer_id = 'USER_0001'")
    assert tuples(quality.orphans(table, fewer, "customer_id", "customer_id")) == [(None,), ("U9",)]


def test_measures_report_errors(spark):
    _, _, fact = star(spark, [{}, {"cashback_amount": None}])
    broken = fact.withColumn("merchant_net_amount", F.col("merchant_net_amount") + 1)
    assert tuples(quality.measure_check(fact)) == [("T0", "OK", "OK", "OK"), ("T1", "ERROR", "OK", "ERROR")]
    assert {r[2] for r in quality.measure_check(broken).collect()} == {"ERROR"}


def test_name_variations_list_the_largest_first(spark):
    rows = [{"merchant_id": m, "merchant_name": n} for m, n in
            (("M1", "c"), ("M1", "a"), ("M1", "b"), ("M1", "a"), ("M2", "x"), ("M3", "q"), ("M3", "p"), ("M3", None))]
    got = quality.name_variations(silver(spark, rows)).collect()
    assert [tuple(r) for r in got] == [("M1", 3, "a, b, c"), ("M3", 2, "p, q")]
    assert quality.name_variations(silver(spark, rows), k=1).count() == 1


def test_long_form(spark):
    row = spark.createDataFrame([(0, 3, None)], "a bigint, b bigint, c bigint")
    assert tuples(quality.long_form(row, "x", 0), "subject") == [
        ("x", "a", 0, 0, True), ("x", "b", 3, 0, False), ("x", "c", None, 0, None)]


def test_report_of_a_sound_build(spark):
    table, dims, fact = star(spark, [{"merchant_id": f"M{i % 3}"} for i in range(9)])
    report = quality.quality_report(table, fact, dims)
    assert report.columns == ["check", "subject", "value", "expected", "passed"]
    assert report.filter("NOT passed").count() == 0 and report.count() == 17


def test_schema_conformance(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, extra string")
    got = tuples(quality.schema_conformance(df, {"a": "bigint", "gone": "date"}), "column_name")
    assert got == [("a", "int", "bigint", False, 2), ("extra", "string", None, False, 1), ("gone", None, "date", False, 0)]


def defects(spark):
    return batches(spark, [
        {},
        {"transaction_timestamp": ts("2024-11-01 20:00:00"), "updated_at": ts("2024-11-02 09:00:00")},   # late
        {"updated_at": None},
        {"merchant_name": "Swiggy Ltd"}, {"merchant_name": None},
        {"transaction_timestamp": ts("2024-11-01 22:00:00"), "updated_at": ts("2024-11-02 08:30:00")},   # shifted over midnight
        {"transaction_timestamp": ts("2024-11-02 04:30:00"), "updated_at": ts("2024-11-02 15:00:00")},   # shifted within the day
    ])


def test_detectors(spark):
    rows = defects(spark)

    def hits(test):
        return [r[0] for r in rows.filter(test).orderBy("transaction_id").select("transaction_id").collect()]

    assert hits(quality.is_late()) == ["T1", "T5"]
    assert hits(quality.is_update_missing()) == ["T2"]
    assert hits(quality.is_renamed()) == ["T3"]
    assert hits(quality.is_zone_shifted("day_border")) == ["T1", "T5"]
    assert hits(quality.is_zone_shifted("any_lag")) == ["T1", "T5", "T6"]
    assert hits(quality.is_zone_shifted("fixed_lag")) == ["T5", "T6"]
    with pytest.raises(ValueError):
        quality.is_zone_shifted("other")
    assert tuples(quality.batch_defects(rows, "fixed_lag")) == [(date(2024, 11, 2), 7, 2, 1, 1, 2, 2)]
    assert tuples(quality.batch_defects(rows)) == [(date(2024, 11, 2), 7, 2, 1, 1, 2, 3)]


def test_repeated_ids_across_batches(spark):
    rows = batches(spark, [{"transaction_id": t} for t in ("a", "a", "a", "b", None)])
    assert tuples(quality.repeated_ids(rows)) == [(5, 2, 2, False)]
    assert tuples(quality.repeated_ids(rows.filter("transaction_id = 'b'"))) == [(1, 1, 0, True)]


def test_batch_profile(spark):
    rows = batches(spark, [
        {"customer_id": "a", "transaction_status": "Failed"}, {"customer_id": "b"}, {"customer_id": "b"},
        {"batch_day": date(2024, 11, 3)}])
    got = {r["batch_day"]: r for r in quality.batch_profile(rows).collect()}
    day = got[date(2024, 11, 2)]
    assert (day["total_rows"], day["unique_transactions"], day["unique_customers"], day["unique_merchants"]) == (3, 3, 2, 1)
    assert (day["successful_pct"], day["failed_pct"], day["pending_pct"]) == (66.67, 33.33, 0.0)


# --- reports on special cases --------------------------------------------------------------------


def test_ties_at_the_cut_are_settled_by_id(spark):
    _, dims, fact = star(spark, [{"merchant_id": f"M{i:02d}", "customer_id": f"U{i:02d}"} for i in range(12)])
    assert [r["merchant_id"] for r in reports.top_merchants(fact, dims, 3).collect()] == ["M00", "M01", "M02"]
    assert [r["customer_id"] for r in reports.top_customers(fact, dims, 2).collect()] == ["U00", "U01"]


def test_a_group_without_revenue_has_no_fee_share(spark):
    _, dims, fact = star(spark, [{"amount": 0, "fee_amount": 1}])
    row = reports.weekend_weekday(fact, dims).head()
    assert row["fee_percentage"] is None and row["total_revenue"] == 0.0


def test_facts_without_keys_leave_joined_reports_only(spark):
    _, dims, fact = star(spark, [{"customer_id": None}, {"transaction_timestamp": ts("2040-01-01")}, {}])
    assert sum(r["transaction_count"] for r in reports.monthly_revenue(fact, dims).collect()) == 2
    category = reports.category_performance(fact).head()
    assert (category["transaction_count"], category["unique_customers"]) == (3, 1)
    assert reports.facts_outside_calendar(fact).head()["transaction_id"] == "T1"


def test_old_versions_do_not_count_as_customers(spark):
    _, dims, fact = star(spark, [{"customer_id": "A"}, {"customer_id": "B"}])
    closed = dims.customers.withColumn("is_current", F.col("customer_id") != "A")
    history = Dimensions(closed, dims.merchants, dims.payment_methods, dims.transaction_status, dims.location, dims.date)
    assert [r["customer_id"] for r in reports.top_customers(fact, history).collect()] == ["B"]


def test_shares_add_up(spark):
    rows = [{"location_type": l, "transaction_status": s, "device_type": d} for l in ("Urban", "Rural")
            for s in ("Failed", "Failed", "Successful") for d in ("Web", "iOS", "iOS")]
    _, dims, fact = star(spark, rows)
    by_location = {}
    for r in reports.status_by_location(fact, dims).collect():
        by_location[r["location_type"]] = by_location.get(r["location_type"], 0) + r["pct_within_location"]
    assert all(abs(v - 100) < 0.05 for v in by_location.values())
    assert abs(sum(r["percentage"] for r in reports.device_usage(fact, dims).collect()) - 100) < 0.05
    assert abs(sum(r["pct_of_failures"] for r in reports.failure_analysis(fact, dims).collect()) - 100) < 0.05
    assert abs(sum(r["percentage"] for r in quality.distribution(fact, "device_type").collect()) - 100) < 0.05
    total = fact.agg(F.sum("amount")).head()[0]
    assert Decimal(str(sum(r["total_revenue"] for r in reports.weekend_weekday(fact, dims).collect()))) == total
