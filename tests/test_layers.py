from datetime import date
from decimal import Decimal

import pytest
from conftest import tuples
from fixtures import AT, batches, silver, star, ts
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.operators import conform, dimensions
from tallyhouse.plans.warehouse import build_warehouse, load_bronze
from tallyhouse.sources import files, tables
from tallyhouse.streaming import drops

HEADER = ",".join(schemas.column_types(schemas.RAW_TRANSACTIONS))
GOOD = '1,a-1,USER_05159,19-08-2023 03:32,Rent Payment,"2BHK ""Flat"", Deposit",Airbnb,1525.39,36.69,19.19,186,UPI,Successful,MERCH_0083,iOS,Urban'
BAD_DATE = "2,a-2,USER_1,2023/08/19,Food,Tea,Shop,10.0,0.1,0.0,1,UPI,Failed,MERCH_1,Web,Rural"
BAD_NUMBER = "3,a-3,USER_1,20-08-2023 10:00,Food,Tea,Shop,ten,0.1,0.0,1,UPI,Failed,MERCH_1,Web,Rural"


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("\n".join([HEADER, GOOD, BAD_DATE, BAD_NUMBER]) + "\n")
    return str(path)


def test_declared_schema_keeps_broken_lines_apart(spark, csv_file):
    raw = files.read_raw_csv(spark, csv_file)
    good = files.good_rows(raw).collect()
    assert [r["transaction_id"] for r in good] == ["a-1"]
    assert good[0]["product_name"] == '2BHK "Flat", Deposit'
    assert good[0]["transaction_date"] == ts("2023-08-19 03:32:00")
    assert sorted(r["line"] for r in files.broken_rows(raw).collect()) == [BAD_DATE, BAD_NUMBER]
    # whatever columns a query asks for
    assert [r[0] for r in files.good_rows(raw).select("transaction_id").collect()] == ["a-1"]
    assert (files.good_rows(raw).count(), files.broken_rows(raw).count()) == (1, 2)
    assert {r[0] for r in files.broken_rows(raw).select("parsed.transaction_id").collect()} == {"a-2", "a-3"}


def test_bronze_load_quarantines_broken_lines(spark, csv_file, tmp_path):
    good, broken = load_bronze(spark, csv_file, "load_", str(tmp_path / "t"))
    assert (good.count(), broken.count()) == (1, 2)
    assert dict(spark.table("load_bronze.raw_transactions").dtypes) == schemas.column_types(schemas.RAW_TRANSACTIONS)


def test_detection_falls_back_on_mixed_types(spark, csv_file):
    lines = files.read_raw_csv_detected(spark, csv_file)
    assert files.broken_rows(lines).count() == 2
    got = files.good_rows(lines)
    assert [r["transaction_id"] for r in got.collect()] == ["a-1"]
    assert dict(got.dtypes) == schemas.column_types(schemas.RAW_TRANSACTIONS)


def test_detection_accepts_clean_files(spark, tmp_path):
    path = tmp_path / "clean.csv"
    path.write_text("\n".join([HEADER, GOOD, "4,too short"]) + "\n")
    lines = files.read_raw_csv_detected(spark, str(path))
    assert [r[0] for r in files.broken_rows(lines).select("line").collect()] == ["4,too short"]
    got = files.good_rows(lines)
    assert dict(got.dtypes) == schemas.column_types(schemas.RAW_TRANSACTIONS)
    assert got.head()["transaction_date"] == ts("2023-08-19 03:32:00")


def test_batch_files_carry_their_day(spark, tmp_path):
    rows = batches(spark, [{}, {"updated_at": None}]).drop("batch_day")
    files.write_csv(rows, str(tmp_path / "2024-11-02"))
    files.write_csv(rows.limit(1), str(tmp_path / "2024-11-03"))
    paths = [str(tmp_path / d) for d in ("2024-11-02", "2024-11-03")]
    got = files.good_rows(files.read_batch_csv(spark, paths, r"/(\d{4}-\d{2}-\d{2})/"))
    assert tuples(got.groupBy("batch_day").agg(F.count("*"), F.count("updated_at"))) == [
        (date(2024, 11, 2), 2, 1), (date(2024, 11, 3), 1, 1)]


def test_batch_files_named_by_number(spark, tmp_path):
    header = ",".join(schemas.column_types(schemas.DAILY_BATCH))
    good = "T1,U,2024-11-01 10:00:00,M,N,c,p,1.5,0,0,1,UPI,Failed,Web,Urban,INR,"
    bad = good.replace("T1", "T2").replace("1.5", "ten")
    (tmp_path / "day1_transactions.csv").write_text("\n".join([header, good, bad]) + "\n")
    (tmp_path / "other.csv").write_text("\n".join([header, good]) + "\n")
    days = {"day1_transactions.csv": "2024-11-01", "day2_transactions.csv": "2024-11-02"}
    lines = files.read_batch_csv(spark, str(tmp_path), days)
    good_ones = files.good_rows(lines).select("batch_day", "amount")
    assert sorted(map(str, tuples(good_ones))) == sorted(map(str, [(date(2024, 11, 1), 1.5), (None, 1.5)]))
    assert tuples(files.broken_rows(lines).select("line", "parsed.batch_day")) == [(bad, date(2024, 11, 1))]
    stream = drops.read_drops(spark, str(tmp_path), days)
    drops.append_to_files(stream, str(tmp_path / "out"), str(tmp_path / "mark"))
    taken = spark.read.parquet(str(tmp_path / "out"))
    assert files.good_rows(taken).count() == 2
    broken = files.broken_rows(taken).select("parsed.transaction_id", "parsed.batch_day")
    assert tuples(broken) == [("T2", date(2024, 11, 1))]


def test_conform_keeps_every_row_and_parses_text(spark):
    raw = spark.createDataFrame(
        [(1, "a", "U1", "19-08-2023 03:32", "c", "p", "m", 1525.39, 36.69, -0.0, 186, "UPI", "Failed", "M1", "Web", "Rural"),
         (2, "b", None, "no date", "c", "p", "m", None, 1.0, 1.0, 1, "UPI", "Failed", None, "Web", "Rural")],
        schemas.RAW_TRANSACTIONS.replace("transaction_date timestamp_ntz", "transaction_date string"))
    got = conform.conform_raw(raw, load_ts=AT)
    assert got.columns == list(schemas.column_types(schemas.SILVER))
    assert dict(got.dtypes) == schemas.column_types(schemas.SILVER)
    first, second = got.orderBy("transaction_id").collect()
    assert first["transaction_timestamp"] == ts("2023-08-19 03:32:00") and first["amount"] == Decimal("1525.39")
    assert second["transaction_timestamp"] is None and second["amount"] is None
    assert (first["currency"], first["source_system"]) == ("INR", "kaggle_csv")


def test_dimension_schemas(spark):
    _, dims, fact = star(spark, [{}])
    for dim, ddl in ((dims.customers, schemas.DIM_CUSTOMERS), (dims.merchants, schemas.DIM_MERCHANTS),
                     (dims.payment_methods, schemas.DIM_PAYMENT_METHODS),
                     (dims.transaction_status, schemas.DIM_TRANSACTION_STATUS),
                     (dims.location, schemas.DIM_LOCATION), (dims.date, schemas.DIM_DATE),
                     (fact, schemas.FACT_TRANSACTIONS)):
        assert dict(dim.dtypes) == schemas.column_types(ddl)


def test_null_keys_get_a_member_but_no_match(spark):
    _, dims, fact = star(spark, [{"customer_id": None}, {"merchant_id": None}, {}])
    assert tuples(dims.customers.select("customer_key", "customer_id")) == [(1, None), (2, "USER_0001")]
    got = tuples(fact.select("transaction_id", "customer_key", "merchant_key"))
    assert got == [("T0", None, 2), ("T1", 2, None), ("T2", 2, 2)]


def test_unknown_status(spark):
    _, dims, _ = star(spark, [{"transaction_status": s} for s in ("Reversed", "Failed", "Pending", "Successful", None)])
    got = {r[0]: tuple(r)[1:] for r in dims.transaction_status.select(
        "status_name", "status_category", "is_terminal", "display_order").collect()}
    assert got == {None: (None, False, None), "Failed": ("Failed", True, 3), "Pending": ("Pending", False, 1),
                   "Reversed": (None, False, None), "Successful": ("Success", True, 2)}


def test_merchants_collapse_to_one_row(spark):
    rows = [{"merchant_id": "M1", "merchant_name": n, "transaction_timestamp": ts(t)}
            for n, t in (("B", "2024-01-01"), ("A", "2024-01-02"), ("C", "2024-01-03"), ("Z", "2023-01-01"))]
    table = silver(spark, rows + [{"merchant_id": "M2", "merchant_name": "X"}])
    assert tuples(dimensions.dim_merchants(table, AT).select("merchant_id", "merchant_name")) == [("M1", "A"), ("M2", "X")]
    newest = dimensions.dim_merchants(table, AT, newest_by="transaction_timestamp")
    assert tuples(newest.select("merchant_id", "merchant_name")) == [("M1", "C"), ("M2", "X")]


def test_calendar(spark):
    days = dimensions.dim_date(spark)
    assert days.count() == 5844
    got = {r["full_date"]: r for r in days.collect()}
    for day, row in got.items():
        assert row["week_of_year"] == int(day.strftime("%U"))
        assert row["day_of_week_name"] == day.strftime("%A") and row["month_name"] == day.strftime("%B")
        assert row["is_weekend"] == (day.weekday() >= 5)
    assert got[date(2024, 3, 31)]["fiscal_quarter"] == 5 and got[date(2024, 4, 1)]["fiscal_quarter"] == 2


def test_dates_outside_the_calendar(spark):
    moments = ["2014-12-31 23:59:59", "2015-01-01 00:00:00", "2030-12-31 23:59:59", "2031-01-01 00:00:00"]
    table, _, fact = star(spark, [{"transaction_timestamp": ts(m)} for m in moments])
    assert tuples(fact.select("transaction_id", "date_key")) == [
        ("T0", None), ("T1", 20150101), ("T2", 20301231), ("T3", None)]
    assert dimensions.dim_date_covering(table).count() == 5844 + 2


def test_derived_measures_and_flags(spark):
    _, _, fact = star(spark, [{"amount": "100.10", "fee_amount": "0.20", "cashback_amount": "0.30"}])
    row = fact.head()
    assert (row["net_customer_amount"], row["merchant_net_amount"], row["gateway_revenue"]) == (
        Decimal("99.80"), Decimal("99.90"), Decimal("-0.10"))
    assert (row["is_refunded"], row["refund_amount"], row["attempt_number"]) == (False, None, 1)


def test_catalog_build_is_repeatable(spark, tmp_path):
    raw = spark.createDataFrame(
        [(i, f"t{i}", f"U{i % 3}", ts("2024-01-15 10:00:00"), "c", "p", f"m{i % 2}", 10.0 + i, 1.0, 0.5, 1,
          "UPI", "Failed", f"M{i % 2}", "Web", "Rural") for i in range(20)], schemas.RAW_TRANSACTIONS)
    for _ in range(2):
        built = build_warehouse(spark, raw, "unit_", AT, str(tmp_path / "tables"))
    assert built["fact_transactions"].count() == 20
    assert spark.table("unit_gold.dim_customers").count() == 3
    assert tables.read_layer_table(spark, "unit_gold", "dim_merchants").count() == 2
    columns = tables.table_columns(spark, "unit_bronze.raw_transactions")
    found = columns.filter("column_name = 'transaction_date'").head()
    assert (found["data_type"], found["position"]) == ("timestamp_ntz", 4)


def test_a_table_can_be_replaced_by_a_query_on_itself(spark, tmp_path):
    name, root = "self_gold.t", str(tmp_path / "t")
    tables.create_layers(spark, "self_", root)
    tables.replace_table(spark.range(5), name, root=root)
    tables.replace_table(spark.table(name).withColumn("id", F.col("id") * 2), name, root=root)
    assert [r[0] for r in spark.table(name).orderBy("id").collect()] == [0, 2, 4, 6, 8]
    assert tables.remove_old_versions(spark, name, root) == 1
    assert spark.table(name).count() == 5
    tables.replace_table(spark.range(2).withColumn("more", F.lit(1)), name, root=root)
    assert spark.table(name).columns == ["id", "more"]
    parted = spark.range(6).withColumn("p", F.col("id") % 2)
    tables.replace_table(parted, name, partition_by=["p"], root=root)
    assert spark.table(name).filter("p = 1").count() == 3


def test_clustered_files_split_a_hot_key(spark, tmp_path, many_chunks):
    df = spark.range(4000).select(F.when(F.col("id") < 3600, 1).otherwise(F.col("id")).alias("k"), "id")
    tables.clustered(df, "k", spread="id").write.parquet(str(tmp_path / "c"))
    per_file = spark.read.parquet(str(tmp_path / "c")).filter("k = 1").groupBy(F.input_file_name()).count()
    assert per_file.count() > 2
