"""Catalog tables: layers, atomic replacement, physical layout, column metadata."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import shared_folder

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"


def create_database(spark: SparkSession, name: str, root: str | None = None) -> None:
    """Create a database if missing; ``root`` places it in a given folder."""
    place = f" LOCATION '{root}/{name}.db'" if root else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def create_layers(
    spark: SparkSession, prefix: str = "", root: str | None = None
) -> dict[str, str]:
    """Create the three layer databases if missing; returns layer to database name."""
    names = {layer: f"{prefix}{layer}" for layer in (BRONZE, SILVER, GOLD)}
    for name in names.values():
        create_database(spark, name, root)
    return names


def replace_table(
    df: DataFrame, table: str, partition_by: list[str] | None = None, root: str | None = None
) -> DataFrame:
    """Create or replace a Parquet table from a query.

    The new version is written to a folder of its own and the table is pointed at it afterwards,
    so readers never see half a table and the query may read the table it replaces. A table with
    partitions or a new schema is registered anew.
    """
    spark = df.sparkSession
    base = root or f"{shared_folder(spark)}/tables"
    path = f"{base}/{table.replace('.', '/')}/version-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    written = spark.read.parquet(path)
    same_form = spark.catalog.tableExists(table) and (
        spark.table(table).schema.simpleString() == written.schema.simpleString()
    )
    if same_form and not partition_by:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path, source="parquet")
        if partition_by:
            spark.catalog.recoverPartitions(table)
    return spark.table(table)


def replace_view(
    df: DataFrame, name: str, partition_by: list[str] | None = None, root: str | None = None
) -> DataFrame:
    """Create or replace a stable view over a versioned Parquet dataset.

    The view is pointed at the new version in one step of the catalog, also when partitions or columns
    change, so a reader finds the version before or the version after, never none. A reader that has begun
    goes on with its version until :func:`remove_old_versions`. The query may read what it replaces. Use a
    name that no table has.
    """
    spark = df.sparkSession
    base = root or f"{shared_folder(spark)}/tables"
    version = uuid.uuid4().hex
    path = f"{base}/{name.replace('.', '/')}/version-{version}"
    if partition_by:
        write_by_partition(df, path, *partition_by)
    else:
        df.write.parquet(path)
    # declared, as types guessed from the names of partition folders may not be those of the query
    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name}__{version} ({declared}) USING parquet {parts} LOCATION '{path}'")
    if partition_by:
        spark.catalog.recoverPartitions(f"{name}__{version}")
    columns = ", ".join(f"`{c}`" for c in df.columns)
    # ALTER changes the entry of the catalog; CREATE OR REPLACE drops it for a moment
    change = "ALTER" if spark.catalog.tableExists(name) else "CREATE"
    spark.sql(f"{change} VIEW {name} AS SELECT {columns} FROM {name}__{version}")
    return spark.table(name)


def remove_old_versions(spark: SparkSession, table: str, root: str | None = None) -> int:
    """Delete the folders of replaced versions once no query reads them; returns how many."""
    base = root or f"{shared_folder(spark)}/tables"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{base}/{table.replace('.', '/')}")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    details = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name IN ('Location', 'View Text')")
    current = "version-" + re.search(r"(?:version-|__)([0-9a-f]{32})", details.head()["data_type"])[1]
    old = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName() != current]
    for path in old:
        spark.sql(f"DROP TABLE IF EXISTS {table}__{path.getName().removeprefix('version-')}")
        files.delete(path, True)
    return len(old)


def read_layer_table(spark: SparkSession, layer: str, name: str) -> DataFrame:
    return spark.table(f"{layer}.{name}")


def clustered(df: DataFrame, *keys: str, spread: str | None = None) -> DataFrame:
    """Rows laid out in key order so that file statistics let scans skip.

    ``spread`` (a near-unique column) is added to the range keys, so that a single hot key is
    still divided over several files.
    """
    ranges = [*keys, spread] if spread else list(keys)
    return df.repartitionByRange(*ranges).sortWithinPartitions(*keys)


#: Bits per key of a place on the curve.
CURVE_BITS = 8


def curve_place(df: DataFrame, *keys: str, bits: int = CURVE_BITS) -> Column:
    """Place of a row on a curve through the space of whole-number keys.

    The span of each key is cut into ``2 ** bits`` equal ranges, which suits surrogate keys and date keys, and the
    bits of the ranges' numbers are interleaved, the first key's first. Rows near each other on the curve are near in
    every key. A missing key counts as the smallest. One pass finds the bounds, two numbers per key. A place with
    fewer bits is the beginning of one with more.
    """
    if bits * len(keys) > 62:
        raise ValueError("a place must fit a long")
    spans = df.agg(*(f(k).cast("bigint") for k in keys for f in (F.min, F.max))).head()
    ranges = []
    for i, key in enumerate(keys):
        lo, hi = (int(x or 0) for x in spans[2 * i:2 * i + 2])
        ranges.append(F.expr(f"coalesce(CAST(((`{key}` - {lo}L) * {1 << bits}L) div {hi - lo + 1}L AS BIGINT), 0L)"))
    place = F.lit(0).cast("bigint")
    for i in range(bits):
        for j, found in enumerate(ranges):
            bit = F.shiftright(found, i).bitwiseAND(F.lit(1).cast("bigint"))
            place = place.bitwiseOR(F.shiftleft(bit, i * len(keys) + len(keys) - 1 - j))
    return place


def clustered_on_curve(
    df: DataFrame, *keys: str, spread: str | None = None, files: int | None = None
) -> DataFrame:
    """Rows laid out along :func:`curve_place`, so that a filter on any one of the keys skips files.

    With n files and k keys, some ``n ** ((k - 1) / k)`` files hold a given value of a key. ``spread`` is as for
    :func:`clustered`: it divides a hot place over several files.
    """
    placed = df.withColumn("_place", curve_place(df, *keys))
    ranges = ["_place", spread] if spread else ["_place"]
    dealt = placed.repartitionByRange(files, *ranges) if files else placed.repartitionByRange(*ranges)
    return dealt.sortWithinPartitions("_place", *keys).drop("_place")


def write_by_partition(
    df: DataFrame, path: str, *parts: str, only_touched: bool = False
) -> None:
    """Write a partitioned Parquet dataset.

    Rows are rebalanced by partition first: small partitions end in one file each, and adaptive
    execution splits a partition that holds most of the rows over several tasks.
    """
    writer = df.hint("rebalance", *parts).write.mode("overwrite")
    mode = "dynamic" if only_touched else "static"
    writer.option("partitionOverwriteMode", mode).partitionBy(*parts).parquet(path)


def month_of(moment: Column) -> Column:
    """Partition value ``yyyy-MM`` of a timestamp."""
    return F.date_format(moment, "yyyy-MM")


def table_columns(spark: SparkSession, table: str) -> DataFrame:
    """Name, type and position of the columns of a catalog table."""
    columns = [
        (table, c.name, c.dataType, i)
        for i, c in enumerate(spark.catalog.listColumns(table), start=1)
    ]
    schema = "table_name string, column_name string, data_type string, position int"
    return spark.createDataFrame(columns, schema)
