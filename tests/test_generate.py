from datetime import date

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tallyhouse import fixed_values, schemas
from tallyhouse.operators import generate, incremental, quality
from tallyhouse.session import stage


@pytest.fixture(scope="module")
def days(spark):
    return stage(generate.three_days(spark), "three_days")


def test_sizes_and_ids(days):
    profile = {r["batch_day"].day: r for r in quality.batch_profile(days).collect()}
    assert [profile[d]["total_rows"] for d in (1, 2, 3)] == [15000] * 3
    assert [profile[d]["unique_transactions"] for d in (1, 2, 3)] == [15000] * 3
    assert (profile[1]["unique_customers"], profile[1]["unique_merchants"]) == (1000, 500)
    assert tuples(quality.repeated_ids(days)) == [(45000, 45000, 0, True)]
    first, last = days.filter("batch_day = '2024-11-01'").agg(F.min("transaction_id"), F.max("transaction_id")).head()
    assert (first, last) == ("TXN_20241101_000001", "TXN_20241101_015000")


def test_injected_and_detected_defects(days):
    injected = {(r[0].day, r[1]): r[2] for r in days.groupBy("batch_day", "segment").count().collect()}
    assert injected == {(1, "clean"): 15000, (2, "clean"): 14700, (2, "late"): 150, (2, "null_updated"): 150,
                        (3, "clean"): 14501, (3, "renamed"): 300, (3, "zone_shifted"): 199}
    found = {r["batch_day"].day: r for r in quality.batch_defects(days).collect()}
    assert (found[1]["late_rows"], found[1]["null_updated_rows"], found[1]["renamed_rows"]) == (0, 0, 0)
    assert (found[2]["late_rows"], found[2]["null_updated_rows"]) == (150, 150)
    assert found[3]["renamed_rows"] == 300
    # about 10.5 of 24 hours cross midnight
    assert 60 <= found[3]["zone_shifted_rows"] <= 115
    third = days.filter("batch_day = '2024-11-03'")
    assert third.filter(quality.is_zone_shifted("any_lag")).count() == 199


def test_shifts_are_repaired_batch_by_batch(spark, days):
    plan = spark.createDataFrame([(date(2024, 11, 3), "any_lag")], "batch_day date, zone_mode string")
    planned = quality.with_zone_mode(days, plan)
    fixed = incremental.normalise_time_zone(planned, F.col("zone_mode"))
    assert tuples(fixed.filter("zone_fixed").groupBy("segment").count()) == [("zone_shifted", 199)]
    # a repaired row is back on its own day
    assert fixed.filter("zone_fixed AND to_date(transaction_timestamp) <> batch_day").count() == 0
    keyed = incremental.with_quality_key(planned, F.col("zone_mode"))
    labels = keyed.filter("dq_key IS NOT NULL").groupBy("dq_key", "segment").count()
    assert sorted((r[0], r[2]) for r in labels.collect()) == [(2, 150), (3, 150), (5, 300), (9, 199)]


def test_issue_total_is_what_is_not_clean(spark, days):
    found = {r["batch_day"].day: r for r in quality.batch_defects(days).collect()}
    report = {r["check"]: r["value"] for r in quality.batch_report(days).filter("batch_day IS NULL").collect()}
    assert report["issue_rows"] == 150 + 150 + 300 + found[3]["late_rows"]
    plan = spark.createDataFrame([(date(2024, 11, 3), "any_lag")], "batch_day date, zone_mode string")
    exact = quality.batch_report(quality.with_zone_mode(days, plan), F.col("zone_mode"))
    assert exact.filter("batch_day IS NULL AND check = 'issue_rows'").head()["value"] == 150 + 150 + 300 + 199
    late_day = exact.filter("batch_day = '2024-11-02' AND check = 'zone_shifted_rows'")
    assert late_day.head()["value"] == 0


def test_output_does_not_depend_on_partitions(spark):
    rows = spark.range(1, 501, 1, 1).select(F.lit("2024-11-02").cast("date").alias("day"), F.col("id").alias("sequence"), F.lit(500).cast("bigint").alias("day_rows"))
    one = generate.fill_rows(generate.with_segments(rows, generate.LATE_DAY))
    eight = generate.fill_rows(generate.with_segments(rows.repartition(8), generate.LATE_DAY))
    assert tuples(one, "transaction_id") == tuples(eight, "transaction_id")


def test_columns_and_values(days):
    got = dict(days.dtypes)
    want = {c: t.replace("double", "decimal(18,2)") for c, t in schemas.column_types(schemas.DAILY_BATCH).items()}
    assert {c: got[c] for c in want} == want
    low, high, points, cashback = days.agg(
        F.min("amount"), F.max("amount"), F.min("loyalty_points"), F.min("cashback_amount")).head()
    assert low >= 100 and high <= 50000 and points >= 0 and cashback >= 0
    unpaid = days.filter("transaction_status <> 'Successful'").agg(F.max("cashback_amount"), F.max("loyalty_points")).head()
    assert tuple(unpaid) == (0, 0)
    fee = days.select(F.col("fee_amount") / F.col("amount")).agg(F.min("(fee_amount / amount)"), F.max("(fee_amount / amount)")).head()
    assert float(fee[0]) > 0.0149 and float(fee[1]) < 0.0301
    pairs = {(r[0], r[1]) for r in days.select("product_category", "product_name").distinct().collect()}
    assert pairs == {(c, p) for c, ps in fixed_values.PRODUCTS.items() for p in ps}
    assert days.filter("updated_at < batch_day OR updated_at >= date_add(batch_day, 1)").count() == 0


def test_shares(days):
    for column, weights in (("payment_method", fixed_values.PAYMENT_METHOD_WEIGHTS), ("transaction_status", fixed_values.STATUS_WEIGHTS),
                            ("device_type", fixed_values.DEVICE_WEIGHTS), ("location_type", fixed_values.LOCATION_WEIGHTS)):
        got = {r[0]: r[1] / 45000 for r in days.groupBy(column).count().collect()}
        assert set(got) == set(weights) and all(abs(got[k] - w) < 0.01 for k, w in weights.items())
    median = days.agg(F.percentile_approx("amount", 0.5)).head()[0]
    assert 1600 < median < 2000  # exp(7.5) = 1808


def test_renames(days):
    names = {r[0]: r[1] for r in days.filter("segment = 'renamed'").select("merchant_id", "merchant_name").distinct().collect()}
    assert set(names) <= {f"MERCH_{i:04d}" for i in range(1, 35)}
    assert names["MERCH_0001"] == "Amazon India Pvt Ltd" and names["MERCH_0003"] == "Meesho Ltd"
    plain = {r[0]: r[1] for r in days.filter("segment = 'clean'").select("merchant_id", "merchant_name").distinct().collect()}
    assert plain["MERCH_0034"] == "EduPoint" and plain["MERCH_0035"] == "Merchant_0034"
    assert date(2024, 11, 3) == days.agg(F.max("batch_day")).head()[0]
