"""Merge on read: newest row wins before and after compaction, repeated batches, bytes written, plans."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tallyhouse.operators.merge_on_read import MergeTable

SCHEMA = "id string, value long, at timestamp_ntz, day date"
START = datetime(2024, 1, 1)


def rows_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def row(key, value, hour, day=0):
    return (key, value, None if hour is None else START + timedelta(hours=hour), date(2024, 1, 1 + day))


def folded(base, batches):
    """The same rule, one change after the other."""
    kept = {r[0]: r for r in base if r[0] is not None}
    for batch in batches:
        newest = {}
        for r in batch:
            if r[0] is not None:
                best = newest.get(r[0])
                newest[r[0]] = r if best is None or (r[2] is not None, r[2] or START, r[1]) > (best[2] is not None, best[2] or START, best[1]) else best
        for key, r in newest.items():
            old = kept.get(key)
            if old is None or old[2] is None or r[2] is not None and r[2] >= old[2]:
                kept[key] = r
    return sorted([*kept.values(), *(r for r in base if r[0] is None)], key=repr)


def found(table):
    return sorted((tuple(r) for r in table.read().collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    return MergeTable(spark, str(tmp_path / "t"), rows_of(spark, []).schema, "id", "at", "day")


@pytest.mark.parametrize("with_base", [True, False])
def test_random_changes_before_and_after_compactions(spark, table, with_base):
    draw = random.Random(4)
    base = [row(f"k{i}", i, draw.randrange(50), i % 3) for i in range(60)] + [row(None, 1, 2), row(None, 1, 2)] if with_base else []
    if with_base:
        table.create(rows_of(spark, base))
    batches = []
    for n in range(1, 6):
        batch = [row(draw.choice([None, *(f"k{i}" for i in range(90))]), draw.randrange(1000), draw.choice([None, *range(60)]), draw.randrange(4)) for _ in range(40)]
        batches.append(batch)
        assert table.append(rows_of(spark, batch), n)
        assert found(table) == folded(base, batches)
        if n in (2, 3, 5):
            assert table.compact() and found(table) == folded(base, batches)
    assert not table.compact()


def test_repeated_batches_change_nothing(spark, table):
    table.create(rows_of(spark, [row("a", 1, 1)]))
    assert table.append(rows_of(spark, [row("a", 2, 2), row("b", 3, 1)]), 1)
    assert not table.append(rows_of(spark, [row("a", 9, 9)]), 1)
    before = found(table)
    assert table.compact() and not table.append(rows_of(spark, [row("a", 9, 9)]), 1)
    assert found(table) == before == [row("a", 2, 2), row("b", 3, 1)]
    with pytest.raises(ValueError):
        table.append(rows_of(spark, []), 0)


def test_half_written_folders_are_not_seen(spark, table):
    table.create(rows_of(spark, [row("a", 1, 1)]))
    table.append(rows_of(spark, [row("a", 2, 2)]), 1)
    for unfinished in ("delta=000000000002", "base=000000000002"):
        folder = Path(table.path) / unfinished
        rows_of(spark, [row("a", 5, 5)]).write.parquet(str(folder))
        (folder / "_SUCCESS").unlink()
    assert found(table) == [row("a", 2, 2)]
    assert table.append(rows_of(spark, [row("a", 3, 3)]), 2) and found(table) == [row("a", 3, 3)]


def test_old_folders_serve_running_readers_until_cleaned(spark, table):
    table.create(rows_of(spark, [row("a", 1, 1), row("b", 1, 1, 2)]))
    table.append(rows_of(spark, [row("a", 2, 2, 1)]), 1)
    reader = table.read()
    table.compact()
    assert tuples(reader.select("id", "value")) == [("a", 2), ("b", 1)]
    assert table.clean() == ["base=000000000000", "delta=000000000001"] and table.clean() == []
    assert found(table) == [row("a", 2, 2, 1), row("b", 1, 1, 2)]


def test_compaction_when_due(spark, table):
    assert not table.compact_when_due()
    table.create(rows_of(spark, [row(f"k{i}", i, 1) for i in range(2000)]))
    table.append(rows_of(spark, [row("k1", 5, 2)]), 1)
    assert not table.compact_when_due(most_deltas=2, most_share=10)
    table.append(rows_of(spark, [row("k2", 5, 2)]), 2)
    assert table.compact_when_due(most_deltas=2, most_share=10)
    table.append(rows_of(spark, [row(f"k{i}", i, 3) for i in range(2000)]), 3)
    assert table.compact_when_due(most_deltas=9, most_share=0.5) and table.read().count() == 2000


def test_nothing_written_gives_no_rows(spark, table):
    assert found(table) == [] and table.clean() == []


def written_bytes(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))


def test_a_batch_writes_in_proportion_to_its_rows(spark, table):
    noise = F.xxhash64("id")
    big = spark.range(40_000).select(F.col("id").cast("string").alias("id"), noise.alias("value"), F.lit(START).cast("timestamp_ntz").alias("at"), F.lit(date(2024, 1, 1)).alias("day"))
    table.create(big)
    table.append(big.limit(400).withColumn("value", F.col("value") + 1), 1)
    base, delta = (written_bytes(f"{table.path}/{name}") for name in ("base=000000000000", "delta=000000000001"))
    assert delta < base / 20


def test_the_base_is_not_shuffled_for_small_batches(spark, table):
    table.create(rows_of(spark, [row(f"k{i}", i, 1) for i in range(50)]))
    table.append(rows_of(spark, [row("k1", 5, 2)]), 1)
    result = table.read()
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final
