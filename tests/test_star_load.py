from glob import glob

import pyarrow.parquet as pq
import pytest
from conftest import tuples
from fixtures import AT, batches, ts
from pyspark.sql import functions as F

from tallyhouse.operators import dimensions
from tallyhouse.operators.conform import conform_batch
from tallyhouse.operators.fact import Dimensions, build_fact
from tallyhouse.plans.star_load import StarLoad
from tallyhouse.sources import tables


def days(spark):
    """Three days: new members on each, a name that changes, a correction, a row without keys."""
    def on(day, name, **more):
        at = ts(f"2024-11-0{day} 10:00:00")
        return {"transaction_id": name, "transaction_timestamp": at, "updated_at": at} | more

    return [
        batches(spark, [on(1, "a"), on(1, "b", merchant_id="MERCH_0005", merchant_name="Zoo"), on(1, "n", customer_id=None)]),
        batches(spark, [on(2, "c", customer_id="USER_0000", transaction_status="Failed"), on(1, "a", amount=70, updated_at=ts("2024-11-02 09:00:00")),
                        on(2, "d", merchant_id="MERCH_0005", merchant_name="Ant")]),
        batches(spark, [on(3, "e", merchant_id="MERCH_0002", merchant_name="New"), on(3, "f", payment_method="Card", location_type=None)]),
    ]


def seen(fact, dims):
    """Facts with the natural keys and attributes that their keys stand for."""
    rows = fact
    for name, (dim, natural, key) in dims.natural_keys().items():
        if name != "dim_date":
            shown = ["merchant_name"] if name == "dim_merchants" else ["status_category"] if name == "dim_transaction_status" else []
            rows = rows.join(dim.select(key, natural, *shown), key, "left")
    return tuples(rows.select("transaction_id", "amount", "customer_id", "merchant_id", "merchant_name", "payment_method_name",
                              "status_name", "status_category", "location_type", "date_key", "net_customer_amount"))


def rebuilt(parts):
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    every = conform_batch(rows, batch_id="x")
    newest = every.groupBy("transaction_id").agg(F.max_by(F.struct(*every.columns), "updated_at").alias("r")).select("r.*")
    builds = [dimensions.dim_customers, dimensions.dim_merchants, dimensions.dim_payment_methods,
              dimensions.dim_transaction_status, dimensions.dim_location]
    dims = Dimensions(*(build(every, AT) for build in builds), dimensions.dim_date(rows.sparkSession))
    return seen(build_fact(newest, dims, AT), dims)


def test_three_days_with_a_crash_equal_a_rebuild(spark, tmp_path, monkeypatch):
    parts = days(spark)
    load = StarLoad(spark, str(tmp_path))
    assert load.load(parts[0], "one", AT)
    before = seen(*(load.star(AT)[k] for k in ("fact", "dims")))
    assert before == rebuilt(parts[:1])

    def crash(self, rows, sequence, load_ts):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(StarLoad, "_add_facts", crash)  # after the dimensions, before the facts
        with pytest.raises(OSError):
            load.load(parts[1], "two", AT)
    load = StarLoad(spark, str(tmp_path))
    assert seen(*(load.star(AT)[k] for k in ("fact", "dims"))) == before
    with pytest.raises(RuntimeError):
        load.load(parts[2], "three", AT)
    assert load.load(parts[1], "two", AT)
    keys = tuples(load.star(AT)["dims"].customers.select("customer_id", "customer_key"))
    assert load.load(parts[2], "three", AT)
    assert not load.load(parts[1], "two", AT)  # changes nothing
    star = load.star(AT)
    assert seen(star["fact"], star["dims"]) == rebuilt(parts)
    assert set(keys) <= set(tuples(star["dims"].customers.select("customer_id", "customer_key")))
    assert [r[0] for r in tuples(load.ledger(), "batch")] == ["one", "two", "three"]
    load.fact.compact()
    assert seen(load.star(AT)["fact"], star["dims"]) == rebuilt(parts)


def test_crash_before_the_ledger(spark, tmp_path, monkeypatch):
    parts = days(spark)
    load = StarLoad(spark, str(tmp_path))
    load.load(parts[0], "one", AT)
    with monkeypatch.context() as broken:
        broken.setattr(StarLoad, "_finish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            load.load(parts[1], "two", AT)
    assert load.star(AT)["fact"].count() == 3  # written, but not yet to be seen
    load.load(parts[1], "two", AT)
    star = load.star(AT)
    assert seen(star["fact"], star["dims"]) == rebuilt(parts[:2])


def test_members_that_come_late(spark, tmp_path):
    load = StarLoad(spark, str(tmp_path), fed=("dim_merchants",))
    load.load(days(spark)[0], "one", AT)
    assert load.star(AT)["fact"].filter("merchant_key IS NULL").count() == 3
    members = spark.createDataFrame([("MERCH_0001", "Shop"), ("MERCH_0009", None)], "natural string, name string")
    assert load.load_members("dim_merchants", members, "members-1", AT)
    assert not load.load_members("dim_merchants", members, "members-1", AT)
    got = tuples(load.star(AT)["fact"].select("transaction_id", "merchant_key"))
    assert got == [("a", 1), ("b", None), ("n", 1)]
    late = spark.createDataFrame([("MERCH_0005", "Zoo"), ("MERCH_0001", "Shop")], "natural string, name string")
    load.load_members("dim_merchants", late, "members-2", AT)
    assert tuples(load.star(AT)["fact"].select("transaction_id", "merchant_key")) == [("a", 1), ("b", 3), ("n", 1)]
    with pytest.raises(ValueError):
        load.load_members("dim_customers", late, "x")


def test_empty_batch(spark, tmp_path):
    load = StarLoad(spark, str(tmp_path))
    assert load.star()["fact"].count() == 0
    assert load.load(days(spark)[0].limit(0), "none", AT)
    assert load.star()["fact"].count() == 0


def test_a_curve_lets_every_key_skip(spark, tmp_path):
    n, files = 40_000, 64
    ids = spark.range(n).select(
        F.col("id").cast("string").alias("transaction_id"),
        (20240101 + F.pmod(F.xxhash64("id"), F.lit(300))).alias("date_key"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(500)).alias("merchant_key"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).cast("bigint").alias("status_key"),
    )
    by = ["date_key", "merchant_key", "status_key"]
    ids.repartitionByRange(files, *by).sortWithinPartitions(*by).write.parquet(str(tmp_path / "sorted"))
    tables.clustered_on_curve(ids, *by, spread="transaction_id", files=files).write.parquet(str(tmp_path / "curve"))
    assert tuples(spark.read.parquet(str(tmp_path / "curve"))) == tuples(ids)

    def admitted(folder, column, value):
        found = 0
        for path in glob(f"{tmp_path}/{folder}/*.parquet"):
            data = pq.ParquetFile(path).metadata
            at = data.schema.names.index(column)
            for g in range(data.num_row_groups):
                bounds = data.row_group(g).column(at).statistics
                found += bounds.min <= value <= bounds.max
        return found

    for value in (3, 250, 444):
        assert admitted("curve", "merchant_key", value) * 2.5 < admitted("sorted", "merchant_key", value)
    assert admitted("curve", "status_key", 6) * 2 < admitted("sorted", "status_key", 6)
    assert admitted("curve", "date_key", 20240150) < files / 2


def test_places(spark):
    rows = spark.createDataFrame([(1, 10), (8, 10), (1, 17), (8, 17), (None, 13)], "a bigint, b bigint")
    got = tuples(rows.select("a", "b", tables.curve_place(rows, "a", "b", bits=3).alias("place")), "b", "a")
    assert got == [(1, 10, 0), (8, 10, 0b101010), (None, 13, 0b000101), (1, 17, 0b010101), (8, 17, 0b111111)]
    short = rows.select(tables.curve_place(rows, "a", "b", bits=2).alias("s"), tables.curve_place(rows, "a", "b", bits=4).alias("l"))
    assert all(r["l"] >> 4 == r["s"] for r in short.collect())
    assert rows.limit(0).select(tables.curve_place(rows.limit(0), "a", "b")).collect() == []
    with pytest.raises(ValueError):
        tables.curve_place(rows, *"abcdefgh")
