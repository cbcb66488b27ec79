"""Chunked operators against plain Python, with one key that holds most of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import ordered
from tallyhouse.operators.keys import assign_keys, extend_keys
from tallyhouse.operators.ordered import CHUNK, carried_forward, in_chunks, with_neighbours, with_positions

pytestmark = pytest.mark.usefixtures("many_chunks")


@pytest.fixture(autouse=True)
def hundreds_of_rows_per_chunk(many_chunks, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_PER_CHUNK", 400)


def test_chunks_follow_the_rows_not_the_session(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        chunked = in_chunks(spark.range(4000).withColumnRenamed("id", "k"), "k")
        sizes = [r[1] for r in chunked.groupBy(CHUNK).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(sizes) == 10 and max(sizes) < 800


def rows(seed=3, n=4000):
    r = random.Random(seed)
    times = r.sample(range(10 * n), n)
    return [("hot" if r.random() < 0.6 else f"k{r.randrange(40)}", t, r.randrange(3) if r.random() < 0.3 else None) for t in times]


def test_a_hot_key_spans_chunks_in_order(spark):
    df = spark.createDataFrame(rows(), "k string, t bigint, v bigint")
    chunked = in_chunks(df, "k", "t")
    hot = chunked.filter("k = 'hot'").groupBy(CHUNK).agg(F.min("t"), F.max("t")).orderBy(CHUNK).collect()
    assert len(hot) > 2
    assert all(a[2] < b[1] for a, b in zip(hot, hot[1:]))


def test_positions_are_contiguous(spark):
    df = spark.createDataFrame(rows(), "k string, t bigint, v bigint")
    got = with_positions(df, "k", "t").select("k", "t", "position").collect()
    want = {(k, t): i for i, (k, t) in enumerate(sorted((k, t) for k, t, _ in rows()), start=1)}
    assert {(r[0], r[1]): r[2] for r in got} == want


def test_carried_forward_equals_brute_force(spark):
    df = spark.createDataFrame(rows(), "k string, t bigint, v bigint")
    got = {(r["k"], r["t"]): r["f"] for r in carried_forward(df, "k", ["t"], "v", "f").collect()}
    want, last = {}, {}
    for k, t, v in sorted(rows(), key=lambda x: (x[0], x[1])):
        if v is not None:
            last[k] = v
        want[(k, t)] = last.get(k)
    assert got == want


def test_rows_of_one_moment_are_divided_too(spark):
    data = [("hot", 5, None, i) for i in range(3000)] + [("hot", 4, 1, -1), ("a", 1, 2, -1), ("z", 9, None, -1)]
    df = spark.createDataFrame(data, "k string, t bigint, v bigint, n bigint")
    filled = carried_forward(df, "k", ["t"], "v", "f")
    assert {r[0]: r[1] for r in filled.groupBy("k").agg(F.min("f")).collect()} == {"hot": 1, "a": 2, "z": None}
    assert filled.filter("k = 'hot' and f = 1").count() == 3001
    written = filled.inputFiles()
    sizes = spark.read.parquet(*written).groupBy(CHUNK).count().collect()
    assert max(r[1] for r in sizes) < 1500


def test_neighbours_equal_brute_force(spark):
    df = spark.createDataFrame(rows(), "k string, t bigint, v bigint")
    got = {(r["k"], r["t"]): (r["previous"] and tuple(r["previous"]), r["following"] and tuple(r["following"]))
           for r in with_neighbours(df, "k", ["t"], ["t", "v"]).collect()}
    data = sorted(rows(), key=lambda x: (x[0], x[1]))
    for i, (k, t, _) in enumerate(data):
        before = data[i - 1][1:] if i and data[i - 1][0] == k else None
        after = data[i + 1][1:] if i + 1 < len(data) and data[i + 1][0] == k else None
        assert got[(k, t)] == (before, after)


def test_keys_start_with_null(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    assert {r["k"]: r["key"] for r in assign_keys(df, "k", "key").collect()} == {None: 1, "a": 2, "b": 3}


def test_extended_keys_leave_old_ones_alone(spark):
    old = spark.createDataFrame([(1, None), (2, "b"), (7, "c")], "key bigint, k string")
    new = spark.createDataFrame([("a",), ("b",), (None,), ("d",)], "k string")
    assert {r["k"]: r["key"] for r in extend_keys(old, new, "k", "key").collect()} == {"a": 8, "d": 9}
    none = spark.createDataFrame([], "key bigint, k string")
    assert sorted(r["key"] for r in extend_keys(none, new, "k", "key").collect()) == [1, 2, 3, 4]


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, t bigint, v bigint")
    assert with_positions(df, "k", "t").count() == 0
    assert carried_forward(df, "k", ["t"], "v", "f").count() == 0
    assert with_neighbours(df, "k", ["t"], ["v"]).count() == 0
