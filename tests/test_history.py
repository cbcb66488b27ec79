import random
from datetime import datetime, timedelta

import pytest
from conftest import tuples
from fixtures import AT, ts
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.operators.dimensions import build_dimension
from tallyhouse.session import stage
from tallyhouse.operators.scd import latest_per_key, point_in_time_lookup, scd1_apply, scd2_apply

START = datetime(2024, 1, 1)


def customers(spark, rows):
    members = spark.createDataFrame(rows, "customer_id string, customer_segment string, email string")
    dim = build_dimension(
        members, "customer_id", "customer_key", schemas.DIM_CUSTOMERS,
        {"effective_start_date": F.lit(START), "is_current": F.lit(True)}, START)
    return stage(dim, "before")


def updates(spark, rows):
    return spark.createDataFrame(
        [(k, s, ts(t)) for k, s, t in rows], "customer_id string, customer_segment string, at timestamp")


def versions(dim):
    return tuples(dim.select("customer_id", "customer_segment", "effective_start_date", "effective_end_date", "is_current"),
                  "customer_id", "effective_start_date")


def apply(dim, changes):
    applied = scd2_apply(dim, changes, "customer_id", "customer_key", ["customer_segment"], "at", AT)
    return stage(applied, "applied")


def test_versions_chain_and_replay_changes_nothing(spark, many_chunks):
    dim = customers(spark, [("A", "gold", "a@x"), ("B", None, "b@x"), ("C", "gold", None), ("D", "gold", "d@x")])
    changes = updates(spark, [
        ("A", "gold", "2024-02-01"),                                # no change
        ("B", "new", "2024-02-01"),                                 # NULL to value
        ("C", "silver", "2024-02-01"), ("C", "bronze", "2024-03-01"),  # two in one batch
        ("C", "bronze", "2024-04-01"),                              # no change after a change
        ("E", "fresh", "2024-02-01"),                               # unseen key
        ("D", "old", "2023-01-01"),                                 # older than the open version
        (None, "lost", "2024-02-01"),
    ])
    once = apply(dim, changes)
    jan, feb, mar = START, ts("2024-02-01"), ts("2024-03-01")
    want = [
        ("A", "gold", jan, None, True),
        ("B", None, jan, feb, False), ("B", "new", feb, None, True),
        ("C", "gold", jan, feb, False), ("C", "silver", feb, mar, False), ("C", "bronze", mar, None, True),
        ("D", "gold", jan, None, True),
        ("E", "fresh", feb, None, True),
    ]
    assert versions(once) == want
    assert tuples(once.select("customer_key", "customer_id", "customer_segment"), "customer_key") == [
        (1, "A", "gold"), (2, "B", None), (3, "C", "gold"), (4, "D", "gold"),
        (5, "B", "new"), (6, "C", "silver"), (7, "C", "bronze"), (8, "E", "fresh")]
    # attributes that are not tracked move to the new version
    assert once.filter("customer_segment = 'new'").head()["email"] == "b@x"
    again = apply(once, changes)
    assert tuples(again.select("customer_key", "customer_id", "customer_segment", "effective_end_date")) == tuples(
        once.select("customer_key", "customer_id", "customer_segment", "effective_end_date"))
    assert once.columns == dim.columns and once.dtypes == dim.dtypes


def test_a_hot_key_with_many_versions(spark, many_chunks):
    dim = customers(spark, [("hot", "s0", None), ("x", "s0", None)])
    r = random.Random(5)
    rows = [("hot", f"s{r.randrange(2)}", (START + timedelta(hours=i + 1)).isoformat()) for i in range(1500)]
    got = versions(apply(dim, updates(spark, rows)))
    want, current = [["hot", "s0", START]], "s0"
    for _, segment, at in rows:
        if segment != current:
            want.append(["hot", segment, ts(at)])
            current = segment
    assert [list(g[:3]) for g in got if g[0] == "hot"] == want
    hot = [g for g in got if g[0] == "hot"]
    assert all(a[3] == b[2] and not a[4] for a, b in zip(hot, hot[1:])) and hot[-1][4]


def test_overwrite_keeps_keys_and_old_values_where_new_is_null(spark):
    schema = "key bigint, id string, name string, city string, created_at timestamp, updated_at timestamp"
    dim = spark.createDataFrame([(1, "A", "a", "x", START, START), (2, "B", "b", "y", START, START), (3, None, "n", "z", START, START)], schema)
    new = spark.createDataFrame(
        [("A", "a1", None, ts("2024-02-01")), ("A", "a2", None, ts("2024-03-01")), ("B", "b", "y", ts("2024-02-01")),
         ("C", "c", "w", ts("2024-02-01")), (None, "no", "no", ts("2024-02-01"))],
        "id string, name string, city string, at timestamp")
    got = tuples(scd1_apply(dim, new, "id", "key", ["name", "city"], "at", AT), "key")
    assert got == [(1, "A", "a2", "x", START, AT), (2, "B", "b", "y", START, START), (3, None, "n", "z", START, START),
                   (4, "C", "c", "w", AT, AT)]


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", None, "q")], "k string, t int, v string")
    assert tuples(latest_per_key(df, "k", "t")) == [("a", 3, "y"), ("b", None, "q")]


def pit(spark, first_open):
    dim = spark.createDataFrame(
        [("A", "v1", ts("2024-01-10"), ts("2024-02-10")), ("A", "v2", ts("2024-02-10"), None), ("B", "w", ts("2024-01-10"), ts("2024-01-20"))],
        "customer_id string, segment string, effective_start_date timestamp, effective_end_date timestamp")
    facts = spark.createDataFrame(
        [(1, "A", ts("2024-01-01")), (2, "A", ts("2024-01-10")), (3, "A", ts("2024-02-09 23:59:59")), (4, "A", ts("2024-02-10")),
         (5, "B", ts("2024-01-20")), (6, "C", ts("2024-01-15")), (7, None, ts("2024-01-15")), (8, "B", None)],
        "n int, customer_id string, at timestamp_ntz")
    got = point_in_time_lookup(facts, dim, "customer_id", "at", ["segment"], first_open)
    return {r["n"]: r["segment"] for r in got.collect()}


def test_versions_are_valid_up_to_but_not_including_their_end(spark, many_chunks):
    want = {1: None, 2: "v1", 3: "v1", 4: "v2", 5: None, 6: None, 7: None, 8: None}
    assert pit(spark, False) == want
    # a fact without a time has no version, even if there is only one
    assert pit(spark, True) == want | {1: "v1"}


@pytest.mark.parametrize("first_open", [True, False])
def test_point_in_time_equals_a_range_join(spark, many_chunks, first_open):
    r = random.Random(11)
    spans = []
    for k in ("hot", "a", "b"):
        cuts = sorted(r.sample(range(1000), 40 if k == "hot" else 3))
        for i, c in enumerate(cuts):
            end = cuts[i + 1] if i + 1 < len(cuts) else None
            spans.append((k, f"{k}{i}", START + timedelta(hours=c), end and START + timedelta(hours=end), i == 0))
    dim = spark.createDataFrame([s[:4] for s in spans],
                                "customer_id string, version string, effective_start_date timestamp, effective_end_date timestamp")
    facts = [(i, r.choice(["hot"] * 6 + ["a", "b", "none"]), START + timedelta(hours=r.randrange(-50, 1100))) for i in range(3000)]
    df = spark.createDataFrame(facts, "n int, customer_id string, at timestamp_ntz")
    got = {x["n"]: x["version"] for x in point_in_time_lookup(df, dim, "customer_id", "at", ["version"], first_open).collect()}
    want = {}
    for n, k, t in facts:
        match = [v for key, v, s, e, first in spans
                 if key == k and (t >= s or (first and first_open)) and (e is None or t < e)]
        want[n] = match[0] if match else None
    assert got == want


@pytest.mark.parametrize("first_open", [True, False])
def test_arrays_and_sorted_rows_find_the_same_version(spark, monkeypatch, first_open):
    """A key with half of the facts and a long history, searched by halving and carried forward."""
    r = random.Random(12)
    spans = []
    for k, n in (("hot", 300), ("a", 1), ("b", 2), ("c", 7), ("d", 8), ("none", 0)):
        cuts = sorted(r.sample(range(1000), n))
        for i, c in enumerate(cuts):
            end = r.choice([None, START + timedelta(hours=c + r.randrange(1, 40))])  # gaps and overlaps
            spans.append((k, f"{k}{i}", START + timedelta(hours=c), end))
    spans += [(None, "x", START, None)]
    dim = spark.createDataFrame(spans, "customer_id string, version string, effective_start_date timestamp, effective_end_date timestamp")
    facts = [(i, r.choice(["hot"] * 5 + ["a", "b", "c", "d", "none", None]), r.choice([None, *[START + timedelta(hours=r.randrange(-50, 1100)) for _ in range(9)]])) for i in range(2000)]
    df = spark.createDataFrame(facts, "n int, customer_id string, at timestamp_ntz")

    def found():
        return tuples(point_in_time_lookup(df, dim, "customer_id", "at", ["version"], first_open).select("n", "version"))

    short = found()
    monkeypatch.setattr("tallyhouse.operators.scd.MOST_BROADCAST", 0)
    assert short == found() and any(v for _, v in short)


def test_a_fact_meets_one_row_of_its_key(spark):
    dim = spark.createDataFrame([("A", "v", ts("2024-01-10"), None)] * 2, "customer_id string, v string, effective_start_date timestamp, effective_end_date timestamp")
    facts = spark.createDataFrame([("A", ts("2024-02-01")), ("B", ts("2024-02-01"))], "customer_id string, at timestamp_ntz")
    got = point_in_time_lookup(facts, dim, "customer_id", "at", ["v"])
    assert tuples(got.select("customer_id", "v")) == [("A", "v"), ("B", None)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line and "effective_start_date" not in line]
    assert joins and not any("<=" in line for line in joins)
    empty = point_in_time_lookup(facts, dim.limit(0), "customer_id", "at", ["v"])
    assert tuples(empty.select("customer_id", "v")) == [("A", None), ("B", None)]
