"""Distinct counts from bitmaps, and the report that reads only the folders of its months."""

from __future__ import annotations

import random
from datetime import date, timedelta

from conftest import tuples
from pyspark.sql import functions as F

from tallyhouse.functions import dates
from tallyhouse.operators import dimensions, distinct
from tallyhouse.plans import catalog
from tallyhouse.session import stage

FOLDER = "/root/testdata/sf0.001"


def facts(seed, n=400, last=12):
    draw = random.Random(seed)
    return [(draw.choice([None, *range(20240101, 20240101 + last)]), draw.choice("ab"), draw.choice([None, 1, 2, 32768, 32769, 98_305, draw.randrange(1, 10**6)])) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "date_key long, kind string, customer_key long").repartition(5)


def counted(rows, group):
    seen = {}
    for r in rows:
        if r[0] is not None and r[2] is not None:
            seen.setdefault(group(r), set()).add(r[2])
    return sorted((*g, len(keys)) for g, keys in seen.items())


def test_spans_and_late_facts(spark):
    first, more = facts(1), facts(2)  # of the same days, many of them the same customers
    stored = stage(distinct.daily_bitmaps(frame(spark, first), "customer_key", by=["kind"]), "bitmaps")
    both = distinct.with_new_days(stored, distinct.daily_bitmaps(frame(spark, more), "customer_key", by=["kind"]))
    again = distinct.with_new_days(both, stored)
    rows = first + more
    for bitmaps in (both, again):
        assert tuples(distinct.distinct_over(bitmaps, "kind")) == counted(rows, lambda r: (r[1],))
        week = F.floor((F.col("date_key") - 20240101) / 7).alias("week")
        assert tuples(distinct.distinct_over(bitmaps, week)) == counted(rows, lambda r: ((r[0] - 20240101) // 7,))
        assert tuples(distinct.distinct_over(bitmaps, "kind", "date_key")) == counted(rows, lambda r: (r[1], r[0]))


def test_trailing_days(spark):
    rows = facts(3, 150, 28)
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(31)]
    calendar = spark.createDataFrame([(d,) for d in days], "full_date date").withColumn("date_key", dates.date_key(F.col("full_date")))
    bitmaps = distinct.daily_bitmaps(frame(spark, rows), "customer_key")
    wanted = []
    for d in days:
        keys = {r[2] for r in rows if r[0] and r[2] and timedelta(0) <= d - date(2024, 1, r[0] % 100) < timedelta(days=5)}
        if keys:
            wanted.append((d, len(keys)))
    assert tuples(distinct.trailing_distinct(bitmaps, calendar, 5)) == wanted


def test_no_facts(spark):
    bitmaps = distinct.daily_bitmaps(frame(spark, [(None, "a", 1), (20240101, "a", None)]), "customer_key")
    assert distinct.distinct_over(bitmaps, "date_key").collect() == []


def test_counts_come_from_the_stored_bitmaps_alone(spark):
    for name in ("distinct_by_month", "distinct_by_category"):
        plan = catalog.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan" in line]
        assert len(scans) == 1 and "keys" in scans[0] and "customer_key" not in scans[0]


def test_only_the_folders_of_the_quarter_are_read(spark):
    result = catalog.QUERIES["inc_fiscal_quarter"](spark, FOLDER)
    plan = result._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    rows = result.collect()
    fact = catalog._monthly_fact(spark, FOLDER)
    read = {r[0] for r in fact.join(dimensions.dim_date(spark).filter("fiscal_quarter = 3"), "date_key").select("txn_month").distinct().collect()}
    assert rows and 0 < len(read) < fact.select("txn_month").distinct().count() / 3
    scan = files_read(result)
    assert scan == len([f for f in fact.inputFiles() if any(f"txn_month={m}/" in f for m in read)])


def files_read(result):
    """Files of the fact that the finished plan has read, by the scan's own count."""
    gateway = result.sparkSession.sparkContext._gateway
    todo, most = [result._jdf.queryExecution().executedPlan()], 0
    while todo:
        plan = todo.pop()
        name = plan.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(plan.executedPlan())
        elif "QueryStage" in name:
            todo.append(plan.plan())
        if name.startswith("Scan parquet") and "txn_month" in plan.toString():
            most = max(most, plan.metrics().apply("numFiles").value())
        children = plan.children()
        todo += [children.apply(i) for i in range(children.size())]
    assert gateway is not None
    return most
