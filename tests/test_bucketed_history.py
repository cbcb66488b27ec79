import re
import uuid

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tallyhouse.operators.history import BucketedHistory
from tallyhouse.operators.incremental import upsert
from tallyhouse.sources import tables

SCHEMA = "id string, at int, what string"


@pytest.fixture
def kept(spark, tmp_path):
    tables.create_database(spark, "histories", str(tmp_path))
    name = f"histories.h{uuid.uuid4().hex}"
    return BucketedHistory(spark, name, SCHEMA, "id", F.col("at"), buckets=3, root=str(tmp_path / "rows"))


@pytest.fixture
def no_broadcast(spark):
    """A batch too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def rows(spark, *cells):
    return spark.createDataFrame(list(cells), SCHEMA)


def shuffled(df):
    """What stands below each shuffle of the plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    lines = text.split("\n")
    found = []
    for i, line in enumerate(lines):
        at = re.search(r"Exchange ", line)
        if at:
            below = []
            for deeper in lines[i + 1:]:
                if re.search(r"[A-Za-z(*]", deeper) and re.search(r"[A-Za-z(*]", deeper).start() <= at.start() - 3:
                    break
                below.append(deeper)
            found.append("\n".join(below))
    return text, found


def test_batches_in_any_order_and_again_equal_an_upsert(spark, kept):
    one = rows(spark, ("a", 1, "x"), ("b", 1, "x"), (None, 1, "x"), ("a", 2, "y"), ("c", None, "x"))
    two = rows(spark, ("a", 3, "z"), ("b", 0, "old"), ("d", 5, "x"), ("d", 5, "y"))
    for number, batch in [(1, one), (2, two), (1, one), (2, two)]:
        kept.append(batch, number)
    wanted = [("a", 3, "z"), ("b", 1, "x"), ("c", None, "x"), ("d", 5, "y")]
    assert tuples(kept.latest(), "id") == wanted
    started = upsert(spark.createDataFrame([], SCHEMA), one, "id", F.col("at"))
    assert tuples(upsert(started, two, "id", F.col("at")), "id") == wanted
    three = rows(spark, ("b", 1, "equally new"), ("e", 1, "x"))
    after = tuples(kept.upserted(three), "id")
    assert after == [("a", 3, "z"), ("b", 1, "equally new"), *wanted[2:], ("e", 1, "x")]
    assert tuples(kept.latest(), "id") == wanted
    kept.append(three, 3)
    assert tuples(kept.latest(), "id") == after


def test_compaction_changes_no_result_and_readers_go_on(spark, kept):
    kept.compact()
    assert kept.latest().count() == 0
    for number in range(4):
        kept.append(rows(spark, *((f"k{i}", number, f"v{number}") for i in range(number, 20))), number)
    reader, before = kept.latest(), tuples(kept.latest(), "id")
    kept.compact()
    assert tuples(kept.latest(), "id") == before
    kept.compact(buckets=5)
    assert tuples(kept.latest(), "id") == before == tuples(reader, "id")
    kept.append(rows(spark, ("k0", 9, "new")), 4)
    assert tuples(kept.latest().filter("id = 'k0'")) == [("k0", 9, "new")]


def test_ids_of_a_batch_against_the_history(spark, kept):
    nothing = kept.check(spark.createDataFrame([], SCHEMA))
    assert tuples(nothing) == [(0, 0, 0, 0, 0, 0)]
    kept.append(rows(spark, ("a", 1, "x"), ("b", 1, "x"), (None, 1, "x")), 1)
    batch = rows(spark, ("a", 1, "x"), ("a", 2, "x"), ("c", 1, "x"), ("c", 1, "x"), (None, 1, "x"), (None, 2, "x"))
    wanted = [(6, 2, 2, 2, 1, 2)]
    assert tuples(kept.check(batch)) == wanted
    kept.append(batch, 2)
    assert tuples(kept.check(batch, 2)) == wanted
    assert tuples(kept.check(batch)) == [(6, 2, 2, 2, 2, 4)]


def test_one_file_per_bucket_and_batch(spark, kept, tmp_path):
    kept.append(rows(spark, *((f"k{i}", 1, "x") for i in range(50))), 1)
    assert len(list((tmp_path / "rows").rglob("_batch=1/*.parquet"))) == 3


def test_the_history_is_never_shuffled(spark, kept, no_broadcast):
    for number in range(3):
        kept.append(rows(spark, *((f"k{i}", number, "x") for i in range(40))), number)
    batch = rows(spark, ("k1", 9, "y"), ("new", 1, "x"))
    text, below = shuffled(kept.latest())
    assert "Bucketed: true" in text and below == []
    for result in (kept.upserted(batch), kept.check(batch).select("known_ids", "total_rows")):
        text, below = shuffled(result)
        assert "Bucketed: true" in text and "SortMergeJoin" in text
        # only the batch stands below a shuffle by key; a total of one row is gathered after the join
        keyed = [b for b in below if "SortMergeJoin" not in b]
        assert keyed and not any("parquet" in b for b in keyed)
