from datetime import date
from decimal import Decimal

from conftest import tuples
from fixtures import AT, batches, ts
from pyspark.sql import functions as F

from tallyhouse.operators import conform, incremental
from tallyhouse.sources import tables


def test_extract_loses_neither_late_nor_unstamped_rows(spark):
    rows = batches(spark, [
        {"transaction_timestamp": ts("2024-11-01 10:00:00"), "updated_at": ts("2024-11-01 10:00:00")},
        {"transaction_timestamp": ts("2024-11-01 10:00:00"), "updated_at": ts("2024-11-02 10:00:00")},
        {"updated_at": None},
    ])
    got = incremental.changed_since(rows, "2024-11-01 23:59:59")
    assert [r[0] for r in tuples(got.select("transaction_id"))] == ["T1", "T2"]
    assert incremental.high_water_mark(rows).head()[0] == ts("2024-11-02 10:00:00")


def test_upsert_keeps_the_newest(spark):
    target = batches(spark, [{"transaction_id": t, "amount": 1} for t in ("same", "newer", "stale", "nulls")]
                     + [{"transaction_id": None, "amount": 7}])
    changes = batches(spark, [
        {"transaction_id": "newer", "amount": 2, "updated_at": ts("2024-11-03")},
        {"transaction_id": "newer", "amount": 3, "updated_at": ts("2024-11-04")},
        {"transaction_id": "stale", "amount": 9, "updated_at": ts("2024-10-01")},
        {"transaction_id": "nulls", "amount": 5, "updated_at": None, "transaction_timestamp": ts("2024-11-05")},
        {"transaction_id": "fresh", "amount": 4}, {"transaction_id": None, "amount": 8},
    ])
    want = [(None, Decimal("7.00")), ("fresh", Decimal("4.00")), ("newer", Decimal("3.00")), ("nulls", Decimal("5.00")),
            ("same", Decimal("1.00")), ("stale", Decimal("1.00"))]
    once = incremental.upsert(target, changes, "transaction_id")
    assert tuples(once.select("transaction_id", "amount")) == want
    twice = incremental.upsert(once, changes, "transaction_id")
    assert tuples(twice.select("transaction_id", "amount")) == want
    assert once.columns == target.columns


FEED = [(None, 3, 9, "I"), ("a", 10, 1, "U"), ("a", 11, 2, "U"), ("b", 0, 1, "D"), ("gone", 0, 1, "D"), ("c", 1, 1, "D"), ("c", 30, 2, "I"), ("n", 5, 1, "I")]


def test_change_feed(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4), (None, 6)], "id string, v int")
    feed = spark.createDataFrame(FEED, "id string, v int, seq int, op string")
    assert tuples(incremental.apply_changes(target, feed, "id", "seq")) == [(None, 6), ("a", 11), ("c", 30), ("d", 4), ("n", 5)]
    soft = incremental.apply_changes(target, feed, "id", "seq", soft_delete=True)
    assert tuples(soft) == [(None, 6, False), ("a", 11, False), ("b", 2, True), ("c", 30, False), ("d", 4, False), ("n", 5, False)]
    assert incremental.not_deleted(soft).count() == 5
    again = incremental.apply_changes(soft, spark.createDataFrame([("b", 9, 5, "U")], feed.schema), "id", "seq", soft_delete=True)
    assert ("b", 9, False) in tuples(again)


def stored(spark, path, schema):
    return tuples(spark.read.schema(schema).parquet(path).select("transaction_id", "amount", "event_date"))


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = incremental.with_event_date(batches(spark, [
        {"transaction_id": f"d{d}-{i}", "amount": i, "transaction_timestamp": ts(f"2024-11-0{d} 10:00:00"),
         "updated_at": ts(f"2024-11-0{d} 10:00:00")} for d in (1, 2, 3) for i in (1, 2)]))
    tables.write_by_partition(rows, path, "event_date")
    before = {p: sorted(f.name for f in (tmp_path / "d" / f"event_date=2024-11-0{p}").glob("*.parquet")) for p in (1, 2, 3)}
    late = incremental.with_event_date(batches(spark, [
        {"transaction_id": "late", "amount": 9, "transaction_timestamp": ts("2024-11-01 11:00:00"), "updated_at": ts("2024-11-04")},
        {"transaction_id": "d1-2", "amount": 8, "transaction_timestamp": ts("2024-11-01 10:00:00"), "updated_at": ts("2024-11-04")}]))
    for _ in range(2):
        incremental.upsert_partitions(spark, path, late, "transaction_id", "event_date")
    one = date(2024, 11, 1)
    assert [r for r in stored(spark, path, rows.schema) if r[2] == one] == [
        ("d1-1", Decimal("1.00"), one), ("d1-2", Decimal("8.00"), one), ("late", Decimal("9.00"), one)]
    after = {p: sorted(f.name for f in (tmp_path / "d" / f"event_date=2024-11-0{p}").glob("*.parquet")) for p in (1, 2, 3)}
    assert after[1] != before[1] and (after[2], after[3]) == (before[2], before[3])


def test_a_row_that_moves_leaves_its_old_partition(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = incremental.with_event_date(batches(spark, [{"transaction_id": "x"}, {"transaction_id": "y", "transaction_timestamp": ts("2024-11-05")}]))
    tables.write_by_partition(rows, path, "event_date")
    moved = incremental.with_event_date(batches(spark, [
        {"transaction_id": "x", "transaction_timestamp": ts("2024-11-05"), "updated_at": ts("2024-11-06")}]))
    incremental.upsert_partitions(spark, path, moved, "transaction_id", "event_date")
    assert [(r[0], r[2]) for r in stored(spark, path, rows.schema)] == [("x", date(2024, 11, 5)), ("y", date(2024, 11, 5))]


def test_rows_without_a_partition_value_are_kept(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = incremental.with_event_date(batches(spark, [
        {"transaction_id": t, "transaction_timestamp": None} for t in ("x", "y")] + [{"transaction_id": "z"}]))
    tables.write_by_partition(rows, path, "event_date")
    new = incremental.with_event_date(batches(spark, [
        {"transaction_id": "n", "transaction_timestamp": None},
        {"transaction_id": "x", "transaction_timestamp": ts("2024-11-05"), "updated_at": ts("2024-11-06")}]))
    incremental.upsert_partitions(spark, path, new, "transaction_id", "event_date")
    two, five = date(2024, 11, 2), date(2024, 11, 5)
    assert sorted((r[0], r[2] or date.min) for r in stored(spark, path, rows.schema)) == [
        ("n", date.min), ("x", five), ("y", date.min), ("z", two)]
    last = incremental.with_event_date(batches(spark, [
        {"transaction_id": t, "transaction_timestamp": ts("2024-11-05"), "updated_at": ts("2024-11-07")} for t in ("n", "y")]))
    incremental.upsert_partitions(spark, path, last, "transaction_id", "event_date")
    assert sorted((r[0], r[2]) for r in stored(spark, path, rows.schema)) == [("n", five), ("x", five), ("y", five), ("z", two)]


def test_concerned_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = incremental.with_event_date(batches(spark, [
        {"transaction_timestamp": ts(f"2024-11-0{d} 10:00:00")} for d in (1, 2, 3)]))
    tables.write_by_partition(rows, path, "event_date")
    read = spark.read.schema(rows.schema).parquet(path).filter(incremental._one_of("event_date", [date(2024, 11, 2), None]))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and read.count() == 1
    only = incremental.with_event_date(batches(spark, [
        {"transaction_id": "T1", "amount": 3, "transaction_timestamp": ts("2024-11-02 10:00:00"), "updated_at": ts("2024-11-09")}]))
    incremental.upsert_partitions(spark, path, only, "transaction_id", "event_date", keys_stay=True)
    assert [str(r[1]) for r in stored(spark, path, rows.schema)] == ["10.00", "3.00", "10.00"]


def test_shifted_times_are_moved_back(spark):
    rows = batches(spark, [{}, {"transaction_timestamp": ts("2024-11-01 22:00:00"), "updated_at": ts("2024-11-02 08:30:00")}])
    got = tuples(incremental.normalise_time_zone(rows).select("transaction_id", "transaction_timestamp", "zone_fixed"))
    assert got == [("T0", ts("2024-11-02 10:00:00"), False), ("T1", ts("2024-11-02 08:30:00"), True)]


def test_quality_dimension(spark):
    rows = batches(spark, [{}, {"updated_at": None, "merchant_name": "X Ltd"}])
    dim = incremental.dim_data_quality(spark, AT)
    assert dim.count() == 16
    got = incremental.with_quality_key(rows).join(dim, "dq_key", "left").select("transaction_id", "dq_key", "dq_issue")
    assert tuples(got) == [("T0", None, None), ("T1", 7, "missing_update, renamed")]


def test_batch_lineage(spark):
    rows = batches(spark, [{}])
    assert conform.conform_batch(rows, load_ts=AT).head()["batch_id"] == "20241102"
    assert conform.conform_batch(rows, load_ts=AT, batch_id="run-7").head()["batch_id"] == "run-7"


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path, many_chunks):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "64KB")
    try:
        df = spark.range(60000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"), F.lit("2024-01").alias("m"))
        tables.write_by_partition(df, str(tmp_path / "m"), "m")
    finally:
        spark.conf.unset(key)
    assert len(list((tmp_path / "m" / "m=2024-01").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "m")).count() == 60000
