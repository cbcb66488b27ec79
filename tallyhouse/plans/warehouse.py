"""Layer tables of a source, each written once and reused."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import fields
from datetime import datetime
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.operators import dimensions
from tallyhouse.operators.conform import RENAMED, conform_raw
from tallyhouse.operators.fact import Dimensions, build_fact
from tallyhouse.session import sent_when_small, stage
from tallyhouse.sources import files, tables, testtables


def sent_members(dims: Dimensions) -> Dimensions:
    """Written dimensions; those of bounded size are broadcast, whatever Spark's threshold, so facts are not shuffled."""
    return Dimensions(**{f.name: sent_when_small(getattr(dims, f.name)) for f in fields(dims)})


class Warehouse:
    """Conformed table, dimensions and fact of one raw table.

    A layer is computed when first asked for and written to the shared folder. The joins and
    distinct passes of the build thus run once, and every report is a narrow scan of the fact.
    ``narrow`` makes the raw table with some of its columns and all of its rows, for what needs no more.
    """

    def __init__(
        self, raw: DataFrame, load_ts: datetime | None = None, narrow: Callable[..., DataFrame] | None = None
    ) -> None:
        self.raw = raw
        self.load_ts = load_ts
        self.narrow = narrow or raw.select

    @property
    def spark(self) -> SparkSession:
        return self.raw.sparkSession

    @cached_property
    def silver(self) -> DataFrame:
        return stage(conform_raw(self.raw, load_ts=self.load_ts), "silver")

    def silver_of(self, *columns: str) -> DataFrame:
        """Some columns of all conformed rows: of the written table if there is one, else not written first."""
        if "silver" in self.__dict__:
            return self.silver.select(*columns)
        back = {new: old for old, new in RENAMED.items()}
        return conform_raw(self.narrow(*(back.get(c, c) for c in columns)), load_ts=self.load_ts, columns=[*columns])

    @cached_property
    def customers(self) -> DataFrame:
        return stage(dimensions.dim_customers(self.silver, self.load_ts), "dim_customers")

    @cached_property
    def merchant_names(self) -> DataFrame:
        """Rows per merchant and name, from which merchants and the checks of their names come."""
        rows = self.silver_of("merchant_id", "merchant_name")
        return stage(dimensions.merchant_names(rows), "merchant_names")

    @cached_property
    def merchants(self) -> DataFrame:
        return stage(dimensions.dim_merchants(self.merchant_names, self.load_ts), "dim_merchants")

    @cached_property
    def payment_methods(self) -> DataFrame:
        dim = dimensions.dim_payment_methods(self.silver, self.load_ts)
        return stage(dim, "dim_payment_methods")

    @cached_property
    def transaction_status(self) -> DataFrame:
        dim = dimensions.dim_transaction_status(self.silver, self.load_ts)
        return stage(dim, "dim_transaction_status")

    @cached_property
    def location(self) -> DataFrame:
        return stage(dimensions.dim_location(self.silver, self.load_ts), "dim_location")

    @cached_property
    def date(self) -> DataFrame:
        return stage(dimensions.dim_date(self.spark), "dim_date")

    @property
    def dims(self) -> Dimensions:
        """All dimensions; those still missing are built by concurrent Spark jobs."""
        builds = ["customers", "merchants", "payment_methods", "transaction_status", "location",
                  "date"]
        missing = [name for name in builds if name not in self.__dict__]
        if missing:
            _ = self.silver  # all of them read it
            with ThreadPoolExecutor(len(missing)) as pool:
                list(pool.map(lambda name: getattr(self, name), missing))
        return Dimensions(
            customers=self.customers, merchants=self.merchants,
            payment_methods=self.payment_methods, transaction_status=self.transaction_status,
            location=self.location, date=self.date,
        )

    @cached_property
    def fact(self) -> DataFrame:
        dims = sent_members(self.dims)
        return stage(build_fact(self.silver, dims, self.load_ts), "fact")


_LOADED = datetime(2024, 12, 1)
_warehouses: dict[tuple[str, str], Warehouse] = {}


def warehouse_of(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse over the test tables of a folder, one per application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _warehouses:
        raw = testtables.raw_transactions(spark, folder)
        narrow = partial(testtables.raw_transactions, spark, folder, same_rows=True)
        _warehouses[key] = Warehouse(raw, _LOADED, narrow)
    return _warehouses[key]


def load_bronze(
    spark: SparkSession, paths: str | list[str], prefix: str = "", root: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Raw CSV into the bronze table; lines that do not fit go to a table of their own.

    Returns the two tables, good rows first.
    """
    layer = tables.create_layers(spark, prefix, root)
    raw = files.read_raw_csv(spark, paths)
    good = tables.replace_table(
        files.good_rows(raw), f"{layer['bronze']}.raw_transactions", root=root
    )
    broken = tables.replace_table(
        files.broken_rows(raw), f"{layer['bronze']}.broken_lines", root=root
    )
    return good, broken


def build_warehouse(
    spark: SparkSession, raw: DataFrame, prefix: str = "", load_ts: datetime | None = None,
    root: str | None = None,
) -> dict[str, DataFrame]:
    """Full rebuild into catalog tables: bronze, then silver, the dimensions and the fact.

    Each table is replaced as a whole and read back before the next one is built on it; the
    dimensions are built by concurrent Spark jobs.
    """
    layer = tables.create_layers(spark, prefix, root)

    def put(level: str, name: str, df: DataFrame) -> DataFrame:
        return tables.replace_table(df, f"{layer[level]}.{name}", root=root)

    bronze = put("bronze", "raw_transactions", raw)
    silver = put("silver", "cleaned_transactions", conform_raw(bronze, load_ts=load_ts))
    builds = {
        "dim_customers": lambda: dimensions.dim_customers(silver, load_ts),
        "dim_merchants": lambda: dimensions.dim_merchants(
            stage(dimensions.merchant_names(silver), "merchant_names"), load_ts
        ),
        "dim_payment_methods": lambda: dimensions.dim_payment_methods(silver, load_ts),
        "dim_transaction_status": lambda: dimensions.dim_transaction_status(silver, load_ts),
        "dim_location": lambda: dimensions.dim_location(silver, load_ts),
        "dim_date": lambda: dimensions.dim_date(spark),
    }
    with ThreadPoolExecutor(len(builds)) as pool:
        built = list(pool.map(lambda name: put("gold", name, builds[name]()), builds))
    # written first: sampling the borders of a layout would do the lookups once more
    fact = stage(build_fact(silver, sent_members(Dimensions(*built)), load_ts), "fact")
    # laid out by time, as most reports ask for spans of dates
    laid = tables.clustered(fact, "transaction_timestamp", spread="transaction_id")
    return {
        "raw_transactions": bronze,
        "cleaned_transactions": silver,
        **dict(zip(builds, built)),
        "fact_transactions": put("gold", "fact_transactions", laid),
    }
