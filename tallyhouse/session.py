"""Session helpers: the shared folder, and tables written to it to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "tallyhouse", **conf: object) -> SparkSession:
    """A session with adaptive execution and UTC; cluster settings come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64MB")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # stream state on local disk with snapshots in the checkpoint, not on the heap
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is used only for a local master with nothing configured.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tallyhouse-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier call has handed out."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tallyhouse/{app}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table survives lost executors, cuts the lineage, and gives the optimizer
    real sizes for its broadcast decisions.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """For a write of very many expressions: code is generated in methods short enough for the JVM to compile.

    It only interprets methods beyond 8,000 bytes, and Spark's own limit is far higher.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Rows of a narrow table that may be sent to every task, some 100 to 150 bytes each in memory.
MOST_SENT = 2_000_000


def sent_when_small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``MOST_SENT`` rows, else as it is.

    Spark's own threshold is in bytes of a file and may be far lower; past it every wide row of the other side is
    shuffled. Counting is free for a written table, so pass one.
    """
    return F.broadcast(df) if df.count() <= MOST_SENT else df


def release(spark: SparkSession) -> None:
    """Delete every table this application has written with :func:`stage`, when none is read again."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/tallyhouse/{spark.sparkContext.applicationId}"
    )
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
