"""Steps whose cost must follow the input: bounded broadcasts, lookups with long histories, bitmaps, layers left out."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from functools import reduce

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tallyhouse import session
from tallyhouse.operators import distinct, generate, scd
from tallyhouse.operators.merge_on_read import MergeTable
from tallyhouse.plans import catalog, warehouse
from tallyhouse.sources import testtables
from tallyhouse.streaming import drops

START = datetime(2024, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tables(spark, folder, twice=False):
    """A small set of order tables; with ``twice`` each part and customer comes twice, and the last one has no key."""
    r = random.Random(5)
    write = lambda name, rows, ddl: spark.createDataFrame(rows, ddl).write.parquet(f"{folder}/{name}.parquet")
    again = 2 if twice else 1
    write("customer", [(i, f"c{i}", 1.5, s) for i, s in enumerate(["BUILDING", "MACHINERY", "FURNITURE"])] * again + [(None, "x", 0.0, "BUILDING")],
          "c_custkey long, c_name string, c_acctbal double, c_mktsegment string")
    write("part", [(i, f"p{i}", f"kind {i % 2}") for i in range(4)] * again + [(None, "x", "y")] * 2, "p_partkey long, p_name string, p_type string")
    write("supplier", [(i, f"s{i}") for i in range(3)], "s_suppkey long, s_name string")
    write("orders", [(i, r.choice([None, 0, 1, 2]), r.choice("OFP"), "1-URGENT") for i in range(20)],
          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string")
    write("lineitem", [(r.randrange(22), r.choice([None, *range(4)]), r.choice([None, 0, 1, 2]), r.randrange(1, 8), 10.25 * i, 0.05, 0.02, START + timedelta(days=i)) for i in range(60)],
          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp_ntz")
    return str(folder)


def test_members_are_sent_whatever_the_threshold_up_to_a_bound(spark, tmp_path, monkeypatch):
    folder = tables(spark, tmp_path)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        sent = testtables.raw_transactions(spark, folder, "product_name", "merchant_name")
        assert plan_of(sent).count("BroadcastHashJoin") == 2
        monkeypatch.setattr(session, "MOST_SENT", 0)
        met = testtables.raw_transactions(spark, folder, "product_name", "merchant_name")
        assert "BroadcastHashJoin" not in plan_of(met)
        assert tuples(sent) == tuples(met)
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("twice", [False, True])
def test_some_columns_of_all_rows_without_writing_the_layer(spark, tmp_path, twice):
    house = warehouse.warehouse_of(spark, tables(spark, tmp_path, twice))
    names = ["merchant_id", "merchant_name"]
    narrow = house.silver_of(*names)
    counted = tuples(house.merchant_names)
    assert "silver" not in house.__dict__
    # parents that no column needs are looked up only where that multiplies rows
    assert ("part.parquet" in "".join(narrow.inputFiles())) == twice
    some = house.silver_of("customer_id", "transaction_timestamp", "amount", "transaction_id")
    assert tuples(narrow) == tuples(house.silver.select(*names))
    assert tuples(some) == tuples(house.silver.select(*some.columns))
    assert counted == tuples(house.silver.groupBy(*names).agg(F.count(F.lit(1)).alias("n")))


def test_fan_out_and_lookups_do_not_write_the_conformed_layer(spark, tmp_path):
    folder = tables(spark, tmp_path)
    catalog.QUERIES["dq_fanout_uncollapsed"](spark, folder).collect()
    catalog.QUERIES["pit_lookup"](spark, folder).collect()
    catalog.QUERIES["pit_lookup_strict"](spark, folder).collect()
    assert "silver" not in warehouse.warehouse_of(spark, folder).__dict__


def long_history(r, keys):
    spans = [(k, f"{k}{i}", START + timedelta(hours=c), None if r.random() < .3 else START + timedelta(hours=c + 30))
             for k, n in keys for i, c in enumerate(sorted(r.sample(range(1000), n)))]
    return spans, [(i, r.choice([None, "none", *(k for k, _ in keys)]), r.choice([None, START + timedelta(hours=r.randrange(-50, 1100))])) for i in range(500)]


@pytest.mark.parametrize("first_open", [True, False])
def test_long_histories_are_met_by_one_shuffle_of_the_facts(spark, monkeypatch, first_open):
    spans, facts = long_history(random.Random(8), [("hot", 60), ("a", 1), ("b", 5)])
    dim = spark.createDataFrame(spans, "customer_id string, version string, effective_start_date timestamp, effective_end_date timestamp")
    df = spark.createDataFrame(facts, "n int, customer_id string, at timestamp_ntz")

    def found():
        return scd.point_in_time_lookup(df, dim, "customer_id", "at", ["version"], first_open)

    sent = tuples(found())
    monkeypatch.setattr(scd, "MOST_BROADCAST", 0)
    carried = []
    monkeypatch.setattr(scd, "carried_forward", lambda *a, f=scd.carried_forward: carried.append(1) or f(*a))
    assert tuples(found()) == sent and not carried
    monkeypatch.setattr(scd, "MOST_PER_KEY", 59)
    assert tuples(found()) == sent and carried


def test_bitmaps_of_a_task_are_bounded_in_number(spark, monkeypatch):
    r = random.Random(9)
    rows = [(20240101 + r.randrange(9), r.choice("ab"), r.randrange(1, 10**6)) for _ in range(500)]
    bitmaps = distinct.daily_bitmaps(spark.createDataFrame(rows, "date_key long, kind string, customer_key long"), "customer_key", by=["kind"]).cache()
    monkeypatch.setattr(distinct, "BITMAPS_PER_TASK", 40)
    both = distinct.with_new_days(bitmaps, bitmaps)
    parts = both.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(parts) > 6 and sum(x["count"] for x in parts) == bitmaps.count()
    got = tuples(distinct.distinct_over(both, "kind"))
    assert got == sorted((k, len({x[2] for x in rows if x[1] == k})) for k in "ab")


def test_compressed_files_hold_a_bounded_number_of_lines(spark, tmp_path, monkeypatch):
    from tallyhouse.sources import files

    monkeypatch.setattr(files, "LINES_PER_FILE", 25)
    folder = tables(spark, tmp_path / "in")
    written = []
    monkeypatch.setattr(files, "write_raw_csv", lambda df, path, f=files.write_raw_csv, **how: written.append(path) or f(df, path, **how))
    path = catalog._faulty_files(spark, folder)
    assert written == [path]  # once, not clean and then faulty
    assert len(spark.read.text(path).inputFiles()) >= 3 and all(x.endswith(".csv.gz") for x in spark.read.text(path).inputFiles())
    lines = files.read_raw_csv(spark, path)
    raw = testtables.raw_transactions(spark, folder)
    broken = raw.filter(F.pmod("loyalty_points", F.lit(7)) == 3).count()
    assert (files.good_rows(lines).count(), files.broken_rows(lines).count()) == (raw.count() - broken, broken) and broken


def test_files_and_state_of_streams_follow_the_rows(spark, tmp_path, monkeypatch):
    """Not the session's shuffle partitions, of which each would cost every trigger."""
    monkeypatch.setattr(catalog, "ROWS_PER_FILE", 10)
    monkeypatch.setattr(drops, "ROWS_PER_STATE", 3)
    rows = [(f"T{i}", START + timedelta(hours=i)) for i in range(40)] * 2
    part = spark.createDataFrame(rows, "transaction_id string, transaction_timestamp timestamp_ntz")
    assert catalog._most_rows([part, part.limit(7)]) == 80 and catalog._most_rows([part.limit(0)]) == 0
    made = []
    monkeypatch.setattr(catalog, "scratch_path", lambda *a, f=catalog.scratch_path: made.append(f(*a)) or made[-1])
    stream = catalog._delivered(spark, [part, part], 80)
    assert len(spark.read.parquet(made[0]).inputFiles()) == 16
    state = drops.state_partitions(spark, 80)
    assert state == 27 and drops.state_partitions(spark, 0) == spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.shuffle.partitions")
    drops.append_to_files(drops.without_repeats(stream), str(tmp_path / "out"), str(tmp_path / "mark"), partitions=state)
    assert len([p for p in (tmp_path / "mark/state/0").iterdir() if p.name.isdigit()]) == state
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert tuples(spark.read.parquet(str(tmp_path / "out")).select("transaction_id")) == sorted({(r[0],) for r in rows})


def test_generated_days_are_drawn_in_one_pass_by_tasks_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "ROWS_PER_DRAWING_TASK", 4)
    events = [(START + timedelta(hours=i), i) for i in range(100)] + [(None, 100)]
    spark.createDataFrame(events, "ts timestamp_ntz, event_id long").write.parquet(f"{tmp_path}/events.parquet")
    plans = []
    monkeypatch.setattr(catalog, "stage", lambda df, name, f=catalog.stage: plans.append(plan_of(df)) or f(df, name))
    rows = catalog._generated(spark, str(tmp_path))
    assert "Union" not in plans[-1] and "REPARTITION_BY_NUM, [plan_id" in plans[-1] and ", 26)" in plans[-1]
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535"
    kinds = [generate.CLEAN_DAY, generate.LATE_DAY, generate.RENAME_DAY]
    wanted = [generate.generate_batch(spark, f"2024-01-0{d}", 24 if d < 5 else 4, kinds[(d - 1) % 3]) for d in range(1, 6)]
    assert tuples(rows) == tuples(reduce(lambda a, b: a.unionByName(b), wanted).select(*rows.columns))


def test_rows_known_to_be_unique_are_not_shuffled_and_some_columns_are_read(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, 5, "x"), ("b", 2, 6, "y"), (None, 3, 7, "z")], "id string, at int, n int, wide string")
    table = MergeTable(spark, str(tmp_path / "t"), rows.schema, "id", "at")
    assert table.append(rows, 1, unique=True) and not table.append(rows, 1, unique=True)
    assert "Exchange" not in plan_of(table.changes(1)) and tuples(table.changes(1)) == [("a", 1, 5, "x"), ("b", 2, 6, "y")]
    again = [("a", 1, 8, "later"), ("b", 1, 9, "older"), ("c", None, 4, None), ("c", 0, 3, "q")]
    table.append(spark.createDataFrame(again, rows.schema), 2)
    narrow = table.read(columns=["n", "id"])
    assert tuples(narrow) == [(3, "c"), (6, "b"), (8, "a")] == sorted((r["n"], r["id"]) for r in table.read().collect())
    assert "wide" not in plan_of(narrow)
    table.compact()
    assert tuples(table.read(columns=["n"])) == [(3,), (6,), (8,)]
