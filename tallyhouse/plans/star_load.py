"""Daily batches into a star, one at a time, with a ledger that lets a broken load be taken up again.

A load has a sequence number. It notes what it is going to load, writes the batch's conformed rows, the members that
are new, the facts, and last of all its line in the ledger. Every step writes to a folder of that sequence, and readers
stop at the last sequence of the ledger, so a load that breaks leaves nothing to be seen; loading the same batch again
takes the same number and keeps or replaces what lies there. A batch of the ledger is not loaded again. While a broken
load waits, another batch is refused, for its rows would meet the folders of the first. One load runs at a time.

Surrogate keys are given once and never change: new members are numbered on from the highest. A merchant has the
smallest of the names met so far, as in a full rebuild. A transaction met again is replaced if it is newer.

A dimension may instead be fed on its own (``fed``): facts then keep a NULL key until their member comes, and
:meth:`StarLoad.load_members` gives them the key. Its cost follows the facts that wait and the new members.

A batch costs its own rows and a look at the dimensions; what was loaded earlier is not read, but for compaction.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse import schemas, session
from tallyhouse.operators import dimensions
from tallyhouse.operators.conform import conform_batch
from tallyhouse.operators.fact import SILVER_KEYS, Dimensions, build_fact
from tallyhouse.operators.incremental import change_time, with_event_date
from tallyhouse.operators.keys import extend_keys
from tallyhouse.operators.merge_on_read import MergeTable
from tallyhouse.session import stage

#: Natural key, surrogate key and schema per dimension.
_FORMS = {
    "dim_customers": ("customer_id", "customer_key", schemas.DIM_CUSTOMERS),
    "dim_merchants": ("merchant_id", "merchant_key", schemas.DIM_MERCHANTS),
    "dim_payment_methods": ("payment_method_name", "payment_method_key", schemas.DIM_PAYMENT_METHODS),
    "dim_transaction_status": ("status_name", "status_key", schemas.DIM_TRANSACTION_STATUS),
    "dim_location": ("location_type", "location_key", schemas.DIM_LOCATION),
}
_MEMBER = "key bigint, natural string, name string"


class StarLoad:
    """A star below ``path``; ``columns`` are those of the batches."""

    def __init__(
        self, spark: SparkSession, path: str, columns: list[str] | None = None, fed: tuple[str, ...] = ()
    ) -> None:
        self.spark, self.path, self.fed = spark, path.rstrip("/"), fed
        types = schemas.column_types(schemas.DAILY_BATCH) | {"batch_day": "date"}
        empty = spark.createDataFrame([], ", ".join(f"{c} {types[c]}" for c in columns or types if c in types))
        rows = with_event_date(conform_batch(empty, batch_id="none"))
        self.silver = MergeTable(spark, f"{self.path}/silver", rows.schema, "transaction_id", change_time(), "event_date")
        fact = StructType([
            *schemas.struct(schemas.FACT_TRANSACTIONS), *schemas.struct("changed_at timestamp_ntz, event_date date"),
        ])
        self.fact = MergeTable(spark, f"{self.path}/fact", fact, "transaction_id", "changed_at", "event_date")

    # --- ledger ----------------------------------------------------------------------------------

    def _rows(self, folder: str, schema: str) -> DataFrame:
        """What the loads have written to a folder, with the sequence as ``batch``."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        path = hadoop.Path(f"{self.path}/{folder}")
        full = f"{schema}, batch bigint"
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).parquet(f"{self.path}/{folder}")

    def ledger(self) -> DataFrame:
        """A row per finished load: its id and its sequence."""
        return self._rows("ledger", "batch_id string")

    def committed(self) -> int:
        """The sequence of the last finished load, 0 before the first."""
        return self.ledger().agg(F.coalesce(F.max("batch"), F.lit(0))).head()[0]

    def _note(self, folder: str, batch_id: str, sequence: int) -> None:
        line = self.spark.createDataFrame([(batch_id,)], "batch_id string").coalesce(1)
        line.write.mode("overwrite").parquet(f"{self.path}/{folder}/batch={sequence}")

    def _begin(self, batch_id: str) -> int | None:
        """The sequence of a load, or None if it is finished."""
        if self.ledger().filter(F.col("batch_id") == batch_id).head():
            return None
        sequence = self.committed() + 1
        begun = self._rows("intents", "batch_id string").filter(F.col("batch") == sequence).head()
        if begun and begun["batch_id"] != batch_id:
            raise RuntimeError(f"load {begun['batch_id']!r} has begun and is not finished; load it first")
        self._note("intents", batch_id, sequence)
        return sequence

    # --- members ---------------------------------------------------------------------------------

    def _members(self, dim: str, upto: int) -> DataFrame:
        """key, natural and name of the members up to a load."""
        rows = self._rows(dim, _MEMBER).filter(F.col("batch") <= upto)
        return rows.groupBy("natural").agg(F.min("key").alias("key"), F.min("name").alias("name"))

    def _add_members(self, dim: str, members: DataFrame, sequence: int) -> None:
        """Write members that are new, and known ones with a smaller name."""
        known = self._members(dim, sequence - 1)
        added = extend_keys(known, members, "natural", "key").select("key", "natural", "name")
        if dim == "dim_merchants":
            before = known.select("key", "natural", F.col("name").alias("_name"))
            again = members.join(before, "natural").filter("name < _name OR _name IS NULL AND name IS NOT NULL")
            added = added.unionByName(again.select("key", "natural", "name"))
        added.write.mode("overwrite").parquet(f"{self.path}/{dim}/batch={sequence}")

    def _dims(self, upto: int, load_ts: datetime | None) -> Dimensions:
        extra = {
            "dim_customers": {"effective_start_date": F.lit(load_ts).cast("timestamp"), "is_current": F.lit(True)},
            "dim_merchants": {"is_active": F.lit(False)},
            "dim_transaction_status": dimensions.status_attributes(),
        }
        built = []
        for dim, (natural, key, schema) in _FORMS.items():
            rows = self._members(dim, upto).withColumnsRenamed({"natural": natural, "key": key, "name": "merchant_name"})
            built.append(dimensions.shaped(rows, schema, extra.get(dim), load_ts))
        return Dimensions(*built, dimensions.dim_date(self.spark))

    def _sent(self, dims: Dimensions, upto: int) -> Dimensions:
        """Dimensions up to a load, those of bounded size with a broadcast hint, so that facts are not shuffled.

        The lines of members that loads have written are at least as many as the members, and counting them is free.
        """
        found = [dims.customers, dims.merchants, dims.payment_methods, dims.transaction_status, dims.location]
        lines = [self._rows(dim, _MEMBER).filter(F.col("batch") <= upto).select(F.lit(dim).alias("dim")) for dim in _FORMS]
        counted = dict(reduce(DataFrame.union, lines).groupBy("dim").count().collect())
        return Dimensions(
            *(F.broadcast(d) if counted.get(dim, 0) <= session.MOST_SENT else d for dim, d in zip(_FORMS, found)), dims.date
        )

    # --- loads -----------------------------------------------------------------------------------

    def load(self, batch: DataFrame, batch_id: str, load_ts: datetime | None = None) -> bool:
        """Load a batch; False if the ledger has it."""
        sequence = self._begin(batch_id)
        if sequence is None:
            return False
        conformed = with_event_date(conform_batch(batch, load_ts=load_ts, batch_id=batch_id))
        self.silver.append(conformed, sequence)
        rows = self.silver.changes(sequence)
        # members count from all rows of the batch, also those that newer ones replace; read once, for all dimensions
        named = stage(conformed.select(*SILVER_KEYS.values(), "merchant_name"), "members")

        def add(dim: str) -> None:
            name = F.min("merchant_name") if dim == "dim_merchants" else F.lit(None).cast("string")
            members = named.groupBy(F.col(SILVER_KEYS[dim]).alias("natural")).agg(name.alias("name"))
            self._add_members(dim, members, sequence)

        with ThreadPoolExecutor(len(_FORMS)) as pool:
            list(pool.map(add, [dim for dim in _FORMS if dim not in self.fed]))
        self._add_facts(rows, sequence, load_ts)
        self._finish(batch_id, sequence)
        return True

    def _add_facts(self, rows: DataFrame, sequence: int, load_ts: datetime | None) -> None:
        # the rows are unique on their id, and members on their key, so facts need not be shuffled once more
        dims = self._sent(self._dims(sequence, load_ts), sequence)
        facts = build_fact(rows, dims, load_ts, {"changed_at": change_time(), "event_date": F.col("event_date")})
        self.fact.append(facts, sequence, unique=True)

    def load_members(self, dim: str, members: DataFrame, batch_id: str, load_ts: datetime | None = None) -> bool:
        """Load members of a fed dimension (``natural``, ``name``) and give waiting facts their keys."""
        if dim not in self.fed:
            raise ValueError(f"{dim} gets its members from the batches")
        sequence = self._begin(batch_id)
        if sequence is None:
            return False
        unique = members.groupBy("natural").agg(F.min("name").alias("name"))
        self._add_members(dim, unique, sequence)
        key = _FORMS[dim][1]
        new = self._rows(dim, _MEMBER).filter(F.col("batch") == sequence).select("natural", F.col("key").alias("_key"))
        ids = self.silver.read(sequence - 1).select("transaction_id", F.col(SILVER_KEYS[dim]).alias("natural"))
        found = ids.join(new, "natural").select("transaction_id", "_key")
        waiting = self.fact.read(sequence - 1).filter(F.col(key).isNull())
        self.fact.append(waiting.join(found, "transaction_id").withColumn(key, F.col("_key")), sequence)
        self._finish(batch_id, sequence)
        return True

    def _finish(self, batch_id: str, sequence: int) -> None:
        self._note("ledger", batch_id, sequence)
        self.silver.compact_when_due()
        self.fact.compact_when_due()

    # --- reading ---------------------------------------------------------------------------------

    def star(
        self, load_ts: datetime | None = None, columns: list[str] | None = None
    ) -> dict[str, DataFrame | Dimensions]:
        """The fact, or some of its columns, and the dimensions as of the last finished load."""
        upto = self.committed()
        fact = self.fact.read(upto, columns or [*schemas.column_types(schemas.FACT_TRANSACTIONS)])
        return {"fact": fact, "dims": self._sent(self._dims(upto, load_ts), upto)}
