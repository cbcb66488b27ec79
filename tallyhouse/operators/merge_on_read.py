"""Upserts merged when read: a base, folders of changes beside it, and compaction.

Writing a batch costs as much as the batch: its newest row per key goes to a folder ``delta=<sequence>``. Reading
takes the newest row per key of all deltas, replaces those rows in the base and adds the keys the base has not. The
base itself is not shuffled while the deltas are small enough to broadcast, which Spark decides by their measured size;
compaction keeps them small. It writes the merged rows to a folder ``base=<sequence>`` and leaves the old folders to
readers that have begun; :meth:`MergeTable.clean` removes them.

A folder counts once it is complete (its ``_SUCCESS`` is there), so a reader sees all of a batch or nothing, and a
compaction takes effect in one step. A batch whose sequence is already there or in the base is not written again.

The newest row has the largest ``newest_by``, a missing one being older than all; among equals the later batch counts,
and within a batch the content. Changes without a key are ignored; rows of the first base without a key stay.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.operators.scd import latest_per_key
from tallyhouse.sources.tables import write_by_partition

#: Deltas after which :meth:`MergeTable.compact_when_due` compacts, and their bytes as a share of the base's.
MOST_DELTAS, MOST_SHARE = 8, 0.5
_FOLDER = re.compile(r"(base|delta)=(\d+)$")


class MergeTable:
    """Rows unique on ``key`` under a path, with the base partitioned by ``part`` if given.

    Keys are met by a digest first: a long, by which the files of base and deltas are sorted.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, key: str, newest_by: str | Column,
        part: str | None = None,
    ) -> None:
        self.spark, self.path, self.schema, self.key, self.part = spark, path.rstrip("/"), schema, key, part
        self._at = F.col(newest_by) if isinstance(newest_by, str) else newest_by
        self._stored = StructType([*schema.fields]).add("_digest", "long")

    # --- folders ---------------------------------------------------------------------------------

    def _hadoop(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _complete(self) -> dict[str, list[int]]:
        """Sequences of the complete folders, in order."""
        jvm, root, files = self._hadoop()
        found: dict[str, list[int]] = {"base": [], "delta": []}
        if files.exists(root):
            for status in files.listStatus(root):
                named = _FOLDER.search(status.getPath().getName())
                if named and files.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                    found[named[1]].append(int(named[2]))
        return {kind: sorted(numbers) for kind, numbers in found.items()}

    def _live(self, upto: int | None = None) -> tuple[int | None, list[int]]:
        """The sequence of the base, and of the deltas it does not hold, of those up to a sequence."""
        found = self._complete()
        if upto is not None:
            found = {kind: [n for n in numbers if n <= upto] for kind, numbers in found.items()}
        base = found["base"][-1] if found["base"] else None
        return base, [n for n in found["delta"] if base is None or n > base]

    def _bytes(self, *folders: str) -> int:
        jvm, _, files = self._hadoop()
        return sum(files.getContentSummary(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{f}")).getLength() for f in folders)

    # --- writing ---------------------------------------------------------------------------------

    def _with_digest(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.schema.names, F.xxhash64(self.key).alias("_digest"))

    def create(self, rows: DataFrame) -> None:
        """The first base, unique on the key but for rows without one. Deltas begin at sequence 1."""
        self._write_base(rows, 0)

    def _write_base(self, rows: DataFrame, sequence: int) -> None:
        stored = self._with_digest(rows)
        path = f"{self.path}/base={sequence:012d}"
        if self.part:
            write_by_partition(stored, path, self.part)
        else:
            stored.repartitionByRange("_digest").sortWithinPartitions("_digest").write.mode("overwrite").parquet(path)

    def append(self, changes: DataFrame, sequence: int, unique: bool = False) -> bool:
        """Write a batch of changes; False if the batch is there already.

        With ``unique``, for changes known to have one row per key, they are written without being shuffled.
        """
        if sequence < 1:
            raise ValueError("sequences begin at 1")
        base, deltas = self._live()
        if sequence in deltas or base is not None and sequence <= base:
            return False
        newest = changes.filter(F.col(self.key).isNotNull()).select(*self.schema.names)
        if not unique:
            newest = latest_per_key(newest, self.key, self._at)
        delta = self._with_digest(newest).sortWithinPartitions("_digest")
        delta.write.mode("overwrite").parquet(f"{self.path}/delta={sequence:012d}")
        return True

    # --- reading ---------------------------------------------------------------------------------

    def _deltas(self, sequences: list[int], *columns: str) -> DataFrame:
        """The newest row per key of the deltas, with its digest; all columns, or the key and some."""
        stored = StructType([*self._stored.fields]).add("delta", "long")
        paths = [f"{self.path}/delta={n:012d}" for n in sequences]
        rows = self.spark.read.schema(stored).option("basePath", self.path).parquet(*paths)
        kept = list(dict.fromkeys([self.key, *(columns or self._stored.names)]))
        if len(sequences) == 1:
            # a delta has one row per key
            return rows.select(*kept)
        if columns:
            # so none are equally new, and content that is not asked for need not settle which is taken
            order = F.struct(self._at.alias("at"), F.col("delta"))
            newest = rows.groupBy(self.key).agg(F.max_by(F.struct(*kept), order).alias("row"))
            return newest.select("row.*")
        return latest_per_key(rows, self.key, self._at, "delta").drop("delta")

    def changes(self, sequence: int) -> DataFrame:
        """The rows that a batch brought, as long as its folder is there."""
        return self._deltas([sequence]).select(*self.schema.names)

    def read(self, upto: int | None = None, columns: list[str] | None = None) -> DataFrame:
        """All rows, as of the folders that are complete now; with ``upto``, as of that sequence.

        With ``columns`` only these, so that rows met in deltas are shuffled with no others.
        """
        base, deltas = self._live(upto)
        wanted = columns or self.schema.names
        if base is None and not deltas:
            return self.spark.createDataFrame([], self.schema).select(*wanted)
        if base is None:
            return self._deltas(deltas, *(columns or ())).select(*wanted)
        stored = self.spark.read.schema(self._stored).parquet(f"{self.path}/base={base:012d}")
        if not deltas:
            return stored.select(*wanted)
        return self._merged(stored, self._deltas(deltas)).select(*wanted)

    def _merged(self, stored: DataFrame, changes: DataFrame) -> DataFrame:
        columns = self.schema.names
        new = changes.select(
            F.col("_digest").alias("_new_digest"), F.col(self.key).alias("_new_key"), self._at.alias("_new_at"),
            F.struct(*columns).alias("_new"),
        )
        same = (F.col("_digest") == F.col("_new_digest")) & (F.col(self.key) == F.col("_new_key"))
        at, new_at = self._at, F.col("_new_at")
        newer = F.col("_new").isNotNull() & (at.isNull() | F.coalesce(new_at >= at, F.lit(False)))
        replaced = stored.join(new, same, "left").select(
            F.when(newer, F.col("_new")).otherwise(F.struct(*columns)).alias("row")
        )
        # the keys of the base that the changes meet are at most as many as the changes
        met = stored.join(new.select("_new_digest", "_new_key"), same, "left_semi").select("_digest", self.key)
        added = changes.join(met, ["_digest", self.key], "left_anti")
        return replaced.select("row.*").unionByName(added.select(*columns))

    # --- compaction ------------------------------------------------------------------------------

    def compact(self) -> bool:
        """Write a base that holds all complete deltas; False if there is none to take in."""
        _, deltas = self._live()
        if not deltas:
            return False
        self._write_base(self.read(), deltas[-1])
        return True

    def compact_when_due(self, most_deltas: int = MOST_DELTAS, most_share: float = MOST_SHARE) -> bool:
        """Compact if the deltas are many, or heavy against the base."""
        base, deltas = self._live()
        if not deltas:
            return False
        heavy = False
        if base is not None:
            size = self._bytes(*(f"delta={n:012d}" for n in deltas))
            heavy = size > most_share * self._bytes(f"base={base:012d}")
        return self.compact() if heavy or len(deltas) >= most_deltas else False

    def clean(self) -> list[str]:
        """Delete the folders that the present base replaces, when no reader uses them; returns their names."""
        found = self._complete()
        if not found["base"]:
            return []
        present = found["base"][-1]
        old = [f"base={n:012d}" for n in found["base"][:-1]] + [f"delta={n:012d}" for n in found["delta"] if n <= present]
        jvm, _, files = self._hadoop()
        for name in old:
            files.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"), True)
        return old
