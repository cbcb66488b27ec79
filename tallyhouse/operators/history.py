"""A growing history in buckets of its key: a new batch is moved to the history, never the history to the batch."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.incremental import change_time, upsert
from tallyhouse.operators.scd import latest_per_key
from tallyhouse.session import shared_folder

BATCH = "_batch"


class BucketedHistory:
    """Rows of a key over many batches, in a fixed number of buckets of the key's hash.

    A batch is one partition of the catalog table, with a file per bucket. A join or aggregation on the key takes the
    buckets as they lie, so that only the batch is shuffled, however long the history grows. Choose ``buckets`` so
    that a bucket of the whole history fits a task; ``compact`` may change the number.

    Within a batch the newest row of a key is kept, found with aggregation before the shuffle: a key that holds
    a third of a batch is one row of its bucket. Rows without a key are not kept, as they could not be applied twice
    without doubling; :meth:`check` counts them. ``newest_by`` is an expression over the columns, by default
    the change time. Of versions equally new the one of the later batch counts.
    """

    def __init__(
        self, spark: SparkSession, name: str, schema: str, key: str, newest_by: Column | None = None,
        buckets: int = 64, root: str | None = None,
    ) -> None:
        self._spark, self._name, self._schema, self._key = spark, name, schema, key
        self._order = change_time() if newest_by is None else newest_by
        self._folder = f"{root or shared_folder(spark) + '/tables'}/{name.replace('.', '/')}"
        if not spark.catalog.tableExists(name):
            self._point_at(self._create(buckets))

    def append(self, batch: DataFrame, number: int) -> None:
        """Add a batch under its number; adding it again replaces it."""
        rows = batch.filter(F.col(self._key).isNotNull())
        self._write(latest_per_key(rows, self._key, self._order), self._table(), number)

    def latest(self) -> DataFrame:
        """The newest row per key, without a shuffle."""
        return latest_per_key(self._spark.table(self._name), self._key, self._order, BATCH).drop(BATCH)

    def upserted(self, batch: DataFrame) -> DataFrame:
        """What :meth:`latest` would give with this batch applied, without writing it."""
        return upsert(self.latest(), batch, self._key, self._order, self._buckets(self._table()))

    def check(self, batch: DataFrame, number: int | None = None) -> DataFrame:
        """One row on the ids of a batch: among themselves and against the history.

        total_rows, missing_ids (rows without one), unique_ids, extra_rows (repeats within the batch), known_ids
        (ids that the history has) and known_rows (rows of the batch with such an id). With ``number`` only
        batches of a smaller number count as history, so that a batch may be checked after it was added.
        """
        history = self._spark.table(self._name)
        if number is not None:
            history = history.filter(F.col(BATCH) < number)
        known = history.groupBy(F.col(self._key).alias("_known")).agg(F.lit(True).alias("_seen"))
        # grouped with a count per id before the shuffle, so a hot id, or none, is one row of it
        per_id = batch.groupBy(self._key).agg(F.count(F.lit(1)).alias("_n"))
        # Spark would otherwise bring both sides to the greater number of partitions
        dealt = per_id.repartition(self._buckets(self._table()), self._key)
        found = dealt.join(known, F.col(self._key) == F.col("_known"), "left")
        n, has_id = F.col("_n"), F.col(self._key).isNotNull()

        def total(value: Column, name: str) -> Column:
            return F.coalesce(F.sum(value), F.lit(0)).alias(name)

        return found.agg(
            total(n, "total_rows"),
            total(F.when(~has_id, n), "missing_ids"),
            F.count(self._key).alias("unique_ids"),
            total(F.when(has_id, n - 1), "extra_rows"),
            F.count("_seen").alias("known_ids"),
            total(F.when(F.col("_seen"), n), "known_rows"),
        )

    def compact(self, buckets: int | None = None) -> None:
        """Rewrite the history as its newest rows in one batch, the last one's.

        With the number of buckets kept, nothing is shuffled. Readers change to the new table in one step; the
        old one stays until dropped, so that queries under way can end.
        """
        last = self._spark.table(self._name).agg(F.max(BATCH)).head()[0]
        if last is None:
            return
        present = self._buckets(self._table())
        table = self._create(buckets or present)
        self._write(self.latest(), table, last, moved=buckets not in (None, present))
        self._point_at(table)

    def _create(self, buckets: int) -> str:
        version = uuid.uuid4().hex
        table = f"{self._name}__{version}"
        self._spark.sql(
            f"CREATE TABLE {table} ({self._schema}, {BATCH} BIGINT) USING parquet PARTITIONED BY ({BATCH}) "
            f"CLUSTERED BY (`{self._key}`) SORTED BY (`{self._key}`) INTO {buckets} BUCKETS "
            f"LOCATION '{self._folder}/version-{version}'"
        )
        return table

    def _point_at(self, table: str) -> None:
        change = "ALTER" if self._spark.catalog.tableExists(self._name) else "CREATE"
        self._spark.sql(f"{change} VIEW {self._name} AS SELECT * FROM {table}")

    def _table(self) -> str:
        """The table that the view names."""
        text = self._spark.sql(f"DESCRIBE FORMATTED {self._name}").filter("col_name = 'View Text'")
        return text.head()["data_type"].rsplit(" ", 1)[-1]

    def _buckets(self, table: str) -> int:
        described = self._spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Num Buckets'")
        return int(described.head()["data_type"])

    def _write(self, rows: DataFrame, table: str, number: int, moved: bool = True) -> None:
        rows = rows.select(*self._spark.table(table).drop(BATCH).columns)
        # one task and one file per bucket
        dealt = rows.repartition(self._buckets(table), self._key) if moved else rows
        self._spark.sql(
            f"INSERT OVERWRITE {table} PARTITION ({BATCH} = {int(number)}) SELECT * FROM {{rows}}", rows=dealt
        )
