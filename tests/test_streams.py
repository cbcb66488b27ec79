import os
from datetime import date
from decimal import Decimal

from conftest import tuples
from fixtures import batches, ts
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.operators import conform, incremental
from tallyhouse.streaming import drops

PATTERN = r"/day-(\d{4}-\d{2}-\d{2})\."
COLUMNS = list(schemas.column_types(schemas.DAILY_BATCH))


def put(spark, folder, day, rows, clock):
    """One CSV file per day, with modification times in day order."""
    folder.mkdir(exist_ok=True)
    path = folder / f"day-{day}.csv"
    data = batches(spark, rows).select(*COLUMNS).toPandas()
    data.to_csv(path, index=False, date_format="%Y-%m-%d %H:%M:%S")
    os.utime(path, (clock, clock))


def at(moment, name, **more):
    return {"transaction_id": name, "transaction_timestamp": ts(moment), "updated_at": ts(moment)} | more


def three_days(spark, folder):
    put(spark, folder, "2024-11-01", [at("2024-11-01 10:00:00", "a"), at("2024-11-01 12:00:00", "b")], 1_000)
    put(spark, folder, "2024-11-02", [at("2024-11-02 10:00:00", "c"), at("2024-11-01 23:00:00", "late"), at("2024-11-02 10:00:00", "c")], 2_000)
    put(spark, folder, "2024-11-06", [at("2024-11-06 10:00:00", "d")], 3_000)
    put(spark, folder, "2024-11-07", [at("2024-11-07 10:00:00", "e")], 4_000)
    # rows are dropped by the watermark of the trigger before, 2024-11-04 10:00: that day is closed
    put(spark, folder, "2024-11-08", [at("2024-11-01 09:00:00", "too_late")], 5_000)


def test_daily_totals_keep_late_rows_and_drop_too_late_ones(spark, tmp_path):
    three_days(spark, tmp_path / "in")
    stream = drops.read_drops(spark, str(tmp_path / "in"), PATTERN, files_per_trigger=1)
    path, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    drops.update_table(drops.daily_totals(stream), path, mark)
    got = tuples(drops.current_rows(spark, path, "event_date").select("event_date", "transaction_count", "late_rows"))
    assert got == [(date(2024, 11, 1), 3, 1), (date(2024, 11, 2), 2, 0), (date(2024, 11, 6), 1, 0), (date(2024, 11, 7), 1, 0)]
    # a new file continues from the checkpoint
    put(spark, tmp_path / "in", "2024-11-09", [at("2024-11-07 11:00:00", "f")], 6_000)
    stream = drops.read_drops(spark, str(tmp_path / "in"), PATTERN, files_per_trigger=1)
    drops.update_table(drops.daily_totals(stream), path, mark)
    got = tuples(drops.current_rows(spark, path, "event_date").select("event_date", "transaction_count"))
    assert got[-1] == (date(2024, 11, 7), 2)


def test_totals_merged_when_read_stay_few_folders(spark, tmp_path):
    three_days(spark, tmp_path / "in")
    path, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    wanted = [(date(2024, 11, 1), 3), (date(2024, 11, 2), 2), (date(2024, 11, 6), 1), (date(2024, 11, 7), 1)]
    for _ in range(2):  # the second time nothing is new
        stream = drops.read_drops(spark, str(tmp_path / "in"), PATTERN, files_per_trigger=1)
        table = drops.merge_totals(drops.daily_totals(stream), path, mark, "event_date", most_deltas=2)
        assert tuples(table.read().select("event_date", "transaction_count")) == wanted
    table.clean()
    assert 1 <= len([f for f in os.listdir(path) if "=" in f]) <= 2
    put(spark, tmp_path / "in", "2024-11-09", [at("2024-11-07 11:00:00", "f")], 6_000)
    stream = drops.read_drops(spark, str(tmp_path / "in"), PATTERN, files_per_trigger=1)
    table = drops.merge_totals(drops.daily_totals(stream), path, mark, "event_date", most_deltas=2)
    assert tuples(table.read().select("event_date", "transaction_count")) == [*wanted[:3], (date(2024, 11, 7), 2)]


def test_one_trigger_equals_a_batch_job(spark, tmp_path):
    three_days(spark, tmp_path / "in")
    stream = drops.read_drops(spark, str(tmp_path / "in"), PATTERN)
    drops.update_table(drops.daily_totals(stream), str(tmp_path / "out"), str(tmp_path / "mark"))
    got = tuples(drops.current_rows(spark, str(tmp_path / "out"), "event_date").select("event_date", "transaction_count"))
    rows = spark.read.option("header", True).schema(schemas.DAILY_BATCH).csv(str(tmp_path / "in"))
    assert got == tuples(rows.groupBy(F.to_date("transaction_timestamp")).count())


def test_repeated_ids_pass_once(spark, tmp_path):
    three_days(spark, tmp_path / "in")
    stream = drops.read_drops(spark, str(tmp_path / "in"), PATTERN, files_per_trigger=1)
    drops.append_to_files(drops.without_repeats(stream), str(tmp_path / "out"), str(tmp_path / "mark"))
    got = [r[0] for r in tuples(spark.read.parquet(str(tmp_path / "out")).select("transaction_id"))]
    assert got == ["a", "b", "c", "d", "e", "late"]


def test_lookup_keeps_unmatched_rows(spark, tmp_path):
    put(spark, tmp_path / "in", "2024-11-01", [at("2024-11-01 10:00:00", "a"), at("2024-11-01 10:00:00", "b", merchant_id="X")], 1_000)
    dim = spark.createDataFrame([(5, "MERCH_0001")], "merchant_key bigint, merchant_id string")
    stream = drops.read_drops(spark, str(tmp_path / "in"), PATTERN)
    keyed = drops.with_dimension(conform.conform_batch(stream), dim, "merchant_id", "merchant_id", "merchant_key")
    drops.append_to_files(keyed, str(tmp_path / "out"), str(tmp_path / "mark"), ["batch_id"])
    got = spark.read.parquet(str(tmp_path / "out")).select("transaction_id", "merchant_key", "batch_id")
    assert tuples(got.withColumn("batch_id", F.col("batch_id").cast("string"))) == [("a", 5, "20241101"), ("b", None, "20241101")]


def test_upserts_over_several_triggers(spark, tmp_path):
    put(spark, tmp_path / "in", "2024-11-01", [at("2024-11-01 10:00:00", "a"), at("2024-11-01 11:00:00", "b")], 1_000)
    put(spark, tmp_path / "in", "2024-11-02", [
        at("2024-11-01 10:00:00", "a", amount=50, updated_at=ts("2024-11-02 08:00:00")), at("2024-11-02 10:00:00", "c"),
        at("2024-11-01 22:00:00", "late", updated_at=ts("2024-11-02 09:00:00"))], 2_000)
    stream = drops.read_drops(spark, str(tmp_path / "in"), PATTERN, files_per_trigger=1)
    path = str(tmp_path / "out")
    drops.upsert_stream(stream, path, str(tmp_path / "mark"))
    got = tuples(spark.read.parquet(path).select("transaction_id", F.col("amount").cast("decimal(18,2)"), "event_date"))
    one, two = date(2024, 11, 1), date(2024, 11, 2)
    assert got == [("a", Decimal("50.00"), one), ("b", Decimal("10.00"), one), ("c", Decimal("10.00"), two), ("late", Decimal("10.00"), one)]
    rows = incremental.with_event_date(spark.read.option("header", True).schema(schemas.DAILY_BATCH).csv(str(tmp_path / "in")))
    assert rows.count() == 5


def members(spark, folder, clock, *rows):
    """One file of announcements."""
    path = folder / f"{clock}.json"
    folder.mkdir(exist_ok=True)
    named = spark.createDataFrame(list(rows), "merchant_id string, merchant_key bigint, announced_at string")
    named.toPandas().to_json(path, orient="records", lines=True)
    os.utime(path, (clock, clock))


def test_members_that_are_announced_after_their_facts(spark, tmp_path):
    facts, told = tmp_path / "facts", tmp_path / "told"
    put(spark, facts, "2024-11-01", [
        at("2024-11-01 10:00:00", "known", merchant_id="K"), at("2024-11-01 10:00:00", "waits", merchant_id="N"),
        at("2024-11-01 10:00:00", "too_early", merchant_id="L"), at("2024-11-01 10:00:00", "nobody", merchant_id=None),
        at("2024-11-01 10:00:00", "never", merchant_id="X"),
        at("2024-11-01 10:00:00", "timeless", merchant_id="N") | {"transaction_timestamp": None}], 1_000)
    put(spark, facts, "2024-11-04", [at("2024-11-04 10:00:00", "edge", merchant_id="L"), at("2024-11-04 10:00:00", "again", merchant_id="N")], 2_000)
    put(spark, facts, "2024-11-05", [at("2024-11-05 10:00:00", "after", merchant_id="L"),
        at("2024-11-05 11:00:00", "never_late", merchant_id="Y")], 3_000)
    put(spark, facts, "2024-11-30", [at("2024-11-30 10:00:00", "end", merchant_id=None)], 4_000)
    # the first trigger announces no one; N follows a trigger after its fact, L more than two days after its first
    members(spark, told, 1_000, (None, None, "2024-11-01 00:00:00"))
    members(spark, told, 2_000, ("N", 7, "2024-11-02 09:00:00"), ("K", 99, "2024-11-02 09:00:00"), ("X", 8, None))
    members(spark, told, 3_000, ("L", 9, "2024-11-06 10:00:00"), ("N", 70, "2024-11-03 09:00:00"))
    members(spark, told, 4_000, (None, None, "2024-11-30 10:00:00"))
    known = spark.createDataFrame([("K", 1)], "merchant_id string, merchant_key bigint")
    announced = (
        spark.readStream.schema("merchant_id string, merchant_key bigint, announced_at string")
        .option("maxFilesPerTrigger", 1).json(str(told))
        .withColumn("announced_at", F.col("announced_at").cast("timestamp_ntz"))
    )
    stream = drops.read_drops(spark, str(facts), PATTERN, files_per_trigger=1)
    keyed = drops.with_changing_dimension(stream, known, announced, "merchant_id", "merchant_id", "merchant_key", spread=3)
    assert keyed.columns == [*stream.columns, "merchant_key"]
    drops.append_to_files(keyed, str(tmp_path / "out"), str(tmp_path / "mark"))
    got = tuples(spark.read.parquet(str(tmp_path / "out")).select("transaction_id", "merchant_key"))
    assert got == [("after", 9), ("again", 7), ("edge", 9), ("end", None), ("known", 1), ("never", None), ("never_late", None),
                   ("nobody", None), ("timeless", None), ("too_early", None), ("waits", 7)]
