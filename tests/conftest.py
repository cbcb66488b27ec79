"""One local session for all tests, with its own folders."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyhouse.operators import ordered, scd  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tallyhouse-tests")
        .config("spark.sql.shuffle.partitions", "6")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # tables are tiny here, and compiling generated code would take most of the time
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def many_chunks(spark, monkeypatch):
    """Makes small data span several chunks, and keeps small shuffles from being merged."""
    monkeypatch.setattr(ordered, "ROWS_PER_CHUNK", 3)
    monkeypatch.setattr(scd, "MOST_BROADCAST", 0)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def tuples(df, *order):
    """Rows as plain tuples, ordered by the named columns or by all."""
    rows = [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]
    return rows
