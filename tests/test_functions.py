from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tallyhouse.functions import dates, draws, ids
from tallyhouse.functions.money import average_2dp, percent_2dp, rounded_quotient


def test_quotients_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (7, 3), (1, 0), (0, 4), (-1, 3)], "a bigint, b bigint")
    got = [r[0] for r in df.select(rounded_quotient(F.col("a"), F.col("b"))).collect()]
    assert got == [3, -3, 2, None, 0, 0]


def test_average_of_exact_half_cents(spark):
    rows = [("x", Decimal("1.00")), ("x", Decimal("1.01")), ("y", Decimal("-1.00")), ("y", Decimal("-1.01"))]
    df = spark.createDataFrame(rows, "k string, v decimal(18,2)")
    got = {r[0]: r[1] for r in df.groupBy("k").agg(average_2dp(F.sum("v"), F.count("v"))).collect()}
    assert got == {"x": 1.01, "y": -1.01}


def test_percent_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (5, 0)], "a bigint, b bigint")
    assert [r[0] for r in df.select(percent_2dp(F.col("a"), F.col("b"))).collect()] == [33.33, 66.67, 12.5, None]


def test_sums_beyond_64_bits(spark):
    big = Decimal("9" * 16 + ".99")
    df = spark.createDataFrame([(big,)] * 50, "v decimal(18,2)")
    assert df.agg(average_2dp(F.sum("v"), F.count("v"))).head()[0] == float(big)


def test_calendar_edges(spark):
    days = [date(2022, 1, 1), date(2023, 1, 1), date(2024, 1, 7), date(2028, 12, 31), date(2023, 3, 31), date(2023, 4, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    d = F.col("d")
    got = df.select(dates.date_key(d), dates.sunday_week(d), dates.fiscal_year(d), dates.fiscal_quarter(d)).collect()
    for day, row in zip(days, got):
        assert row[0] == int(day.strftime("%Y%m%d"))
        assert row[1] == int(day.strftime("%U"))
    assert [(r[2], r[3]) for r in got[-2:]] == [(2022, 5), (2023, 2)]


def test_ids_are_never_cut(spark):
    df = spark.createDataFrame([(7,), (12345,), (1234567,)], "n bigint")
    assert [r[0] for r in df.select(ids.customer_id(F.col("n"))).collect()] == ["USER_0007", "USER_12345", "USER_1234567"]
    row = spark.sql("select date'2024-11-01' as d, 1 as n").select(ids.transaction_id(F.col("d"), F.col("n")))
    assert row.head()[0] == "TXN_20241101_000001"


def test_instants_do_not_depend_on_the_zone(spark):
    df = spark.createDataFrame([(datetime(2024, 11, 3, 0, 30),)], "t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(F.unix_seconds(dates.instant(F.col("t"))), dates.utc_date(dates.instant(F.col("t")))).head()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row[0] == 1730593800 and row[1] == date(2024, 11, 3)


def test_draws_follow_their_weights(spark):
    u = draws.uniform(1, "x", F.col("id"))
    df = spark.range(20000).select(u.alias("u"), draws.weighted(u, {"a": 0.6, "b": 0.3, "c": 0.1}).alias("w"))
    low, high = df.agg(F.min("u"), F.max("u")).head()
    assert 0 <= low < 0.001 and 0.999 < high < 1
    shares = {r[0]: r[1] / 20000 for r in df.groupBy("w").count().collect()}
    assert abs(shares["a"] - 0.6) < 0.02 and abs(shares["b"] - 0.3) < 0.02 and abs(shares["c"] - 0.1) < 0.02


def test_text_times_survive_a_skipped_hour(spark):
    df = spark.createDataFrame([("10-03-2024 02:30",), ("31-12-1969 23:59",), ("soon",), (None,)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r[0] for r in df.select(dates.parsed(F.col("t"), "dd-MM-yyyy HH:mm")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [datetime(2024, 3, 10, 2, 30), datetime(1969, 12, 31, 23, 59), None, None]
