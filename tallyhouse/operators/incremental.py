"""Incremental loads: extract, upsert, change feeds, routing, repair."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.fixed_values import EST_SHIFT_MINUTES
from tallyhouse.functions.dates import shift_minutes
from tallyhouse.operators import quality
from tallyhouse.operators.conform import audit_time
from tallyhouse.operators.scd import latest_per_key
from tallyhouse.session import stage
from tallyhouse.sources.tables import write_by_partition


def change_time() -> Column:
    """Update time, or event time where the update time is missing."""
    return F.coalesce(F.col("updated_at"), F.col("transaction_timestamp"))


def changed_since(batches: DataFrame, high_water: Column | datetime | str) -> DataFrame:
    """Rows changed after the high-water mark.

    Late rows pass on their update time and rows without one on their event time.
    """
    mark = high_water if isinstance(high_water, Column) else F.lit(high_water)
    return batches.filter(change_time() > mark.cast("timestamp_ntz"))


def high_water_mark(batches: DataFrame) -> DataFrame:
    """The mark to remember after loading these rows."""
    return batches.agg(F.max(change_time()).alias("high_water"))


def _newer_side(old: DataFrame, new: DataFrame, key: str, newest_by: Column) -> DataFrame:
    """Full outer join of two tables that are unique on ``key``; the newer row wins whole.

    Old rows without a key match nothing and would all meet in one task of the join, so they
    pass by it; file statistics make the second scan that finds them cheap.
    """
    left = old.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_old_key"), newest_by.alias("_old_at"),
        F.struct(*old.columns).alias("_old"),
    )
    right = new.select(
        F.col(key).alias("_new_key"), newest_by.alias("_new_at"),
        F.struct(*old.columns).alias("_new"),
    )
    both = left.join(right, F.col("_old_key") == F.col("_new_key"), "full_outer")
    stale = F.col("_old").isNotNull() & (
        F.col("_new").isNull() | F.coalesce(F.col("_new_at") < F.col("_old_at"), F.lit(False))
    )
    chosen = F.when(stale, F.col("_old")).otherwise(F.col("_new"))
    merged = both.select(chosen.alias("row")).select("row.*")
    return merged.unionByName(old.filter(F.col(key).isNull()))


def _newest_changes(changes: DataFrame, key: str, newest_by: Column) -> DataFrame:
    return latest_per_key(changes.filter(F.col(key).isNotNull()), key, newest_by)


def upsert(
    target: DataFrame, changes: DataFrame, key: str, newest_by: Column | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Insert or replace by key; the newest change wins, and never loses to an older one.

    ``newest_by`` is an expression over columns of both tables, by default the change time.
    Changes without a key are ignored: they could not be applied twice without doubling. With
    ``buckets``, those of a target bucketed by the key, only the changes are shuffled.
    """
    order = change_time() if newest_by is None else newest_by
    newest = _newest_changes(changes.select(*target.columns), key, order)
    if buckets:
        newest = newest.repartition(buckets, key)
    return _newer_side(target, newest, key, order)


def upsert_partitions(
    spark: SparkSession, path: str, changes: DataFrame, key: str, part: str,
    newest_by: Column | None = None, keys_stay: bool = False,
) -> None:
    """Upsert into a partitioned dataset, rewriting only the partitions concerned.

    These are the partitions the changes belong to and those that hold a changed key now. With
    ``keys_stay`` a key is known never to change its partition, which saves looking for it in the
    key column of the whole dataset. The new content is complete in the shared folder before a
    partition is replaced, because a dataset cannot be overwritten while it is read.
    """
    stored = spark.read.schema(changes.schema).parquet(path)
    order = change_time() if newest_by is None else newest_by
    newest = stage(_newest_changes(changes, key, order), "changes")
    parts = newest.select(part)
    if not keys_stay:
        parts = parts.union(stored.join(newest.select(key), key, "left_semi").select(part))
    # names of folders: at most as many as the dataset has partitions. As literals they prune
    # the scan, while a join with them would read every partition.
    concerned = [row[0] for row in parts.distinct().collect()]
    present = stored.filter(_one_of(part, concerned))
    merged = stage(_newer_side(present, newest.select(*stored.columns), key, order), "merged")
    write_by_partition(merged, path, part, only_touched=True)
    # a partition whose rows all moved away is not overwritten and is dropped afterwards; in
    # this order nothing is ever missing, and applying the changes again completes a failed run
    filled = {row[0] for row in merged.select(part).distinct().collect()}
    for value in set(concerned) - filled:
        _drop_partition(spark, path, part, value)


def _one_of(column: str, values: list) -> Column:
    """Membership in a list that may hold NULL."""
    known = [v for v in values if v is not None]
    test = F.col(column).isin(known) if known else F.lit(False)
    return test | F.col(column).isNull() if len(known) < len(values) else test


def _drop_partition(spark: SparkSession, path: str, part: str, value: object) -> None:
    jvm = spark.sparkContext._jvm
    names = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    name = names.getPartitionPathString(part, None if value is None else str(value))
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def apply_changes(
    target: DataFrame, feed: DataFrame, key: str, sequence: str,
    operation: str = "op", soft_delete: bool = False,
) -> DataFrame:
    """Apply a feed of inserts (I), updates (U) and deletes (D).

    Only the change with the highest sequence per key counts. Deleting an absent key does
    nothing, and changes without a key are ignored. With ``soft_delete`` deleted rows stay, marked by ``is_deleted``.
    """
    values = [c for c in target.columns if c != "is_deleted"]
    keyed = feed.filter(F.col(key).isNotNull()).select(*values, sequence, operation)
    newest = latest_per_key(keyed, key, sequence)
    arriving = newest.select(
        F.col(key).alias("_key"), F.col(operation).alias("_op"), F.struct(*values).alias("_new")
    )
    flag = F.col("is_deleted") if "is_deleted" in target.columns else F.lit(False)
    # rows without a key match nothing; they pass by the join, where they would share one task
    present = target.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_old_key"), F.struct(*values).alias("_old"), flag.alias("_gone")
    )
    both = present.join(arriving, F.col("_old_key") == F.col("_key"), "full_outer")
    deleted = F.coalesce(F.col("_op") == "D", F.lit(False))
    absent_delete = deleted & F.col("_old").isNull()
    rows = both.filter(~absent_delete).select(
        F.when(deleted | F.col("_new").isNull(), F.col("_old")).otherwise(F.col("_new"))
        .alias("row"),
        F.when(F.col("_op").isNull(), F.coalesce("_gone", F.lit(False))).otherwise(deleted)
        .alias("is_deleted"),
    ).select("row.*", "is_deleted")
    keyless = target.filter(F.col(key).isNull()).select(*values, flag.alias("is_deleted"))
    rows = rows.unionByName(keyless)
    return rows if soft_delete else rows.filter(~F.col("is_deleted")).drop("is_deleted")


def not_deleted(rows: DataFrame) -> DataFrame:
    """The default view of a table with soft deletes."""
    return rows.filter(~F.col("is_deleted"))


def with_event_date(rows: DataFrame) -> DataFrame:
    """Adds the partition column of late-data routing."""
    return rows.withColumn("event_date", F.to_date("transaction_timestamp"))


def normalise_time_zone(
    batches: DataFrame, mode: str | Column = "any_lag", minutes: int = EST_SHIFT_MINUTES
) -> DataFrame:
    """Event times of shifted rows moved back; ``zone_fixed`` marks them.

    The default is for the batch that is known to be shifted. For several batches, pass the
    column of :func:`quality.with_zone_mode`, so that late rows of other batches stay as they are.
    """
    shifted = quality.is_zone_shifted(mode)
    return batches.withColumn("zone_fixed", shifted).withColumn(
        "transaction_timestamp",
        F.when(F.col("zone_fixed"), shift_minutes(F.col("transaction_timestamp"), minutes))
        .otherwise(F.col("transaction_timestamp")),
    )


DEFECTS = {
    "late": lambda mode: quality.is_late() & ~quality.is_zone_shifted(mode),
    "missing_update": lambda mode: quality.is_update_missing(),
    "renamed": lambda mode: quality.is_renamed(),
    "zone_shifted": quality.is_zone_shifted,
}


def dim_data_quality(spark: SparkSession, load_ts: datetime | None = None) -> DataFrame:
    """One row per combination of defects; the key is a bit mask plus 1."""
    names = list(DEFECTS)
    masks = spark.range(1 << len(names)).withColumnRenamed("id", "_mask")
    bit = {n: F.col("_mask").bitwiseAND(F.lit(1 << i)) != 0 for i, n in enumerate(names)}
    label = F.concat_ws(", ", *(F.when(flag, n) for n, flag in bit.items()))
    return masks.select(
        (F.col("_mask") + 1).cast("bigint").alias("dq_key"),
        F.when(F.col("_mask") == 0, "clean").otherwise(label).alias("dq_issue"),
        *(flag.alias(f"is_{n}") for n, flag in bit.items()),
        audit_time(load_ts).alias("created_at"),
    )


def with_quality_key(rows: DataFrame, zone_mode: str | Column = "day_border") -> DataFrame:
    """Adds ``dq_key``; NULL for rows without a defect.

    For shifts inside a day, pass the column of :func:`quality.with_zone_mode`.
    """
    mask = reduce(
        lambda a, b: a + b,
        [
            F.when(test(zone_mode), 1 << i).otherwise(0)
            for i, test in enumerate(DEFECTS.values())
        ],
    )
    return rows.withColumn("dq_key", F.when(mask > 0, mask + 1).cast("bigint"))
