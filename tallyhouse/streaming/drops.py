"""Daily drops as a stream: ingest, daily totals, dedup, lookup, upsert."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.fixed_values import BATCH_TIMESTAMP_FORMAT
from tallyhouse.functions.dates import day_start, instant, utc_date
from tallyhouse.operators.fact import lookup
from tallyhouse.operators.incremental import change_time, upsert_partitions, with_event_date
from tallyhouse.operators.merge_on_read import MergeTable
from tallyhouse.sources.files import CORRUPT, day_of_path

# a row may be a day late and files may come in another order: one day would be just enough
LATENESS = "2 days"
#: Rows of a trigger for which a stream's state has a partition.
ROWS_PER_STATE = 250_000


def read_drops(
    spark: SparkSession, path: str, day: str | dict[str, str],
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of CSV batch files, with ``batch_day`` from the file path.

    The cells are read as text and typed here, so whether a line fits does not depend on the columns
    a query asks for. A line with a cell that does not fit keeps its text in the last column;
    split with ``good_rows`` and ``broken_rows``.
    """
    types = schemas.column_types(schemas.DAILY_BATCH)
    reader = (
        spark.readStream.schema(", ".join(f"{c} string" for c in types))
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    text = reader.csv(path)
    typed = {c: _typed(F.col(c), t) for c, t in types.items()}
    misfits = [F.col(c).isNotNull() & typed[c].isNull() for c, t in types.items() if t != "string"]
    line = F.when(reduce(or_, misfits), F.to_csv(F.struct(*types)))
    return text.select(
        *(value.alias(c) for c, value in typed.items()),
        day_of_path(F.col("_metadata.file_path"), day).alias("batch_day"),
        line.alias(CORRUPT),
    )


def _typed(text: Column, kind: str) -> Column:
    """A cell's value, or NULL if it does not fit."""
    if kind == "timestamp_ntz":
        return F.try_to_timestamp(text, F.lit(BATCH_TIMESTAMP_FORMAT)).cast(kind)
    return text if kind == "string" else text.try_cast(kind)


def _timed(stream: DataFrame, lateness: str) -> DataFrame:
    """Adds the watermarked event time."""
    event_time = instant(F.col("transaction_timestamp"))
    return stream.withColumn("event_time", event_time).withWatermark("event_time", lateness)


def daily_totals(stream: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Totals per event day; rows later than the watermark allows are dropped."""
    return (
        _timed(stream, lateness)
        .groupBy(F.window("event_time", "1 day").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.sum("amount").alias("total_amount"),
            F.count_if(F.col("transaction_timestamp") < day_start(F.col("batch_day")))
            .alias("late_rows"),
        )
        .select(
            utc_date(F.col("day.start")).alias("event_date"),
            "transaction_count", "total_amount", "late_rows",
        )
    )


def without_repeats(stream: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The first row of every transaction id; state is kept only as long as the watermark asks."""
    unique = _timed(stream, lateness).dropDuplicatesWithinWatermark(["transaction_id"])
    return unique.drop("event_time")


def with_dimension(
    stream: DataFrame, dim: DataFrame, on: str, natural_key: str, take: str
) -> DataFrame:
    """Surrogate key of a static dimension; rows without a match are kept."""
    return lookup(stream, dim, on, natural_key, take)


def with_changing_dimension(
    stream: DataFrame, known: DataFrame, announced: DataFrame, on: str, natural_key: str, take: str,
    announced_at: str = "announced_at", wait: str = "2 days", lateness: str = LATENESS, spread: int = 8,
) -> DataFrame:
    """Surrogate key of a dimension whose members may arrive during the stream, even after their facts.

    ``known`` are the members at the start. ``announced`` is a stream of further ones (``natural_key``, ``take``,
    ``announced_at``). A fact of a known member passes at once, and so does one without a member or a
    time. Others wait: a member announced up to ``wait`` after the fact's event time is found, whichever of the two
    is delivered first; a fact passes with NULL once the watermark rules such an announcement out. Of several
    announcements of a member the first to be delivered counts; those without key or time are ignored. A known
    member stays as known, whatever is announced.

    The watermark follows the slower stream, so a quiet dimension has to send rows now and then (without a key, say)
    or waiting facts stay. Facts behind the watermark are dropped, as in the other streams here. State holds the
    facts that wait and the announced members ``spread`` times over, the latter for the life of the stream: facts are
    dealt over ``spread`` parts per member, so a new member with very many facts is not one task's.
    """
    rows = lookup(_timed(stream, lateness), known, on, natural_key, take)
    waits = F.col(take).isNull() & F.col(on).isNotNull() & F.col("event_time").isNotNull()
    number = F.xxhash64(*stream.columns)
    rows = rows.withColumns({
        "_waits": waits,
        # a fact that does not wait meets no one, so its place is free to choose
        "_on": F.when(waits, F.col(on)).otherwise(number.cast("string")),
        "_part": F.pmod(number, F.lit(spread)).cast("int"),
    })
    # one test of both columns: a test of the name alone would be moved below the watermark, which has to see all rows
    complete = F.array_size(F.array_compact(F.array(F.col("_member"), F.col("_announced").cast("string")))) == 2
    first = (
        announced.select(
            F.col(natural_key).alias("_member"), F.col(take).alias("_found"),
            instant(F.col(announced_at)).alias("_announced"),
        )
        .withWatermark("_announced", lateness)
        .filter(complete)
        .dropDuplicates(["_member"])
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    )
    joined = rows.join(
        first,
        F.col("_waits") & (F.col("_on") == F.col("_member")) & (F.col("_part") == F.col("_copy"))
        & (F.col("_announced") <= F.col("event_time") + F.expr(f"INTERVAL {wait}")),
        "left",
    )
    return joined.select(*stream.columns, F.coalesce(take, "_found").alias(take))


def state_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions of the state of a stream that takes so many rows per trigger.

    Every trigger loads and commits each of them, even one without rows, so a session's shuffle partitions, meant for
    batch work, may cost far more than the rows do.
    """
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_STATE))


@contextmanager
def _state_in(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """A stream started within has state of so many partitions; None leaves it to the session.

    A stream takes the session's settings when it starts, and keeps this one in its checkpoint.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(partitions or before))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def append_to_files(
    stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
    partitions: int | None = None,
) -> None:
    """Run an append stream over everything available, into Parquet files.

    ``partitions`` of its state, if it has one, as by :func:`state_partitions`.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _state_in(stream.sparkSession, partitions):
        query = writer.start(path)
    query.awaitTermination()


def update_table(
    totals: DataFrame, path: str, checkpoint: str
) -> None:
    """Run an aggregating stream; every trigger's changed rows go to a folder of its own.

    Rewriting the folder of a trigger makes a repeated trigger harmless.
    """

    def write(batch: DataFrame, trigger: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/trigger={trigger}")

    (
        totals.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def current_rows(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The newest version of every row written by :func:`update_table`."""
    written = spark.read.parquet(path)
    content = F.struct(*(c for c in written.columns if c != "trigger"))
    newest = written.groupBy(F.col(key).alias("_key")).agg(
        F.max_by(content, "trigger").alias("row")
    )
    return newest.select("row.*")


def upsert_stream(
    stream: DataFrame, path: str, checkpoint: str,
    key: str = "transaction_id", newest_by: Column | None = None, keys_stay: bool = False,
) -> None:
    """Run a stream of batches into a dataset partitioned by event date, newest row per key.

    Only touched partitions are rewritten, and applying a trigger twice changes nothing. With
    ``keys_stay``, for keys whose event date never changes, a trigger costs only the partitions it
    touches; without, it also looks for its keys in the whole dataset.
    """

    def merge(batch: DataFrame, trigger: int) -> None:
        rows = with_event_date(batch)
        # makes the dataset exist before the first merge
        rows.limit(0).write.mode("ignore").partitionBy("event_date").parquet(path)
        upsert_partitions(batch.sparkSession, path, rows, key, "event_date", newest_by, keys_stay)

    (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(merge)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def merge_stream(
    stream: DataFrame, path: str, checkpoint: str, key: str = "transaction_id",
    newest_by: Column | None = None, most_deltas: int = 8,
) -> MergeTable:
    """Run a stream of batches into a table that is merged when read; returns that table.

    A trigger writes its own rows and nothing else; now and then one compacts. A repeated trigger
    changes nothing.
    """
    rows = with_event_date(stream)
    order = change_time() if newest_by is None else newest_by
    table = MergeTable(stream.sparkSession, path, rows.schema, key, order, part="event_date")
    return _merged(rows, table, checkpoint, "append", most_deltas)


def merge_totals(
    totals: DataFrame, path: str, checkpoint: str, key: str, most_deltas: int = 8, partitions: int | None = None
) -> MergeTable:
    """Run an aggregating stream into a table that is merged when read; returns that table.

    A trigger writes the rows it changed, and a later trigger's row of a key replaces an earlier one's. What a
    reader meets is one base and at most ``most_deltas`` folders, however many triggers there were. A repeated trigger
    changes nothing. ``partitions`` are those of the state, as by :func:`state_partitions`.
    """
    # all equally new, of which the later trigger's counts
    table = MergeTable(totals.sparkSession, path, totals.schema, key, F.lit(0))
    return _merged(totals, table, checkpoint, "update", most_deltas, partitions)


def _merged(
    rows: DataFrame, table: MergeTable, checkpoint: str, mode: str, most_deltas: int, partitions: int | None = None
) -> MergeTable:
    def merge(batch: DataFrame, trigger: int) -> None:
        # the batch belongs to a session of its own, the table to the caller's
        table.append(batch, trigger + 1)
        table.compact_when_due(most_deltas)

    writer = (
        rows.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(merge)
        .trigger(availableNow=True)
    )
    with _state_in(rows.sparkSession, partitions):
        query = writer.start()
    query.awaitTermination()
    return table
