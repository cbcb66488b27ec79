"""CSV readers for raw and daily data, and file writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from tallyhouse import schemas
from tallyhouse.fixed_values import BATCH_TIMESTAMP_FORMAT, RAW_TIMESTAMP_FORMAT
from tallyhouse.session import stage

CORRUPT = "_corrupt_record"


def _csv_reader(spark: SparkSession, timestamp_format: str):
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("timestampFormat", timestamp_format)
        .option("timestampNTZFormat", timestamp_format)
    )


def _parsed(reader, ddl: str, paths: str | list[str], day: Column | None = None) -> DataFrame:
    """All columns of the lines, and the text of those that do not fit, written once.

    Spark parses only the columns a query asks for, so which lines fit would depend on the query. In
    the written table it does not, and any selection and count agrees.
    """
    schema = schemas.struct(ddl).add(StructField(CORRUPT, StringType()))
    reader = reader.schema(schema).option("mode", "PERMISSIVE")
    lines = reader.option("columnNameOfCorruptRecord", CORRUPT).csv(paths)
    return stage(lines if day is None else lines.withColumn("batch_day", day), "csv_lines")


def read_raw_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw transactions with the declared schema; broken lines keep their text in a last column."""
    return _parsed(_csv_reader(spark, RAW_TIMESTAMP_FORMAT), schemas.RAW_TRANSACTIONS, paths)


def read_raw_csv_detected(
    spark: SparkSession, paths: str | list[str], multi_line: bool = False
) -> DataFrame:
    """Raw transactions with detected types, or with the declared ones where these do not fit.

    Either way lines that do not fit keep their text, as with :func:`read_raw_csv`. Detection costs
    an extra pass over the files, so prefer that.
    """
    reader = _csv_reader(spark, RAW_TIMESTAMP_FORMAT).option("multiLine", multi_line)
    reader = reader.option("preferTimestampNTZ", True)
    found = dict(reader.option("inferSchema", True).csv(paths).dtypes)
    wanted = schemas.column_types(schemas.RAW_TRANSACTIONS)
    widening = {"int": {"bigint", "double"}, "bigint": {"double"}, "void": set(wanted.values())}
    fits = set(found) == set(wanted) and all(
        found[c] == t or t in widening.get(found[c], set()) for c, t in wanted.items()
    )
    if not fits:
        return read_raw_csv(spark, paths)
    detected = ", ".join(f"`{c}` {'string' if t == 'void' else t}" for c, t in found.items())
    lines = _parsed(reader.option("inferSchema", False), detected, paths)
    return lines.select(*(F.col(c).cast(t).alias(c) for c, t in wanted.items()), CORRUPT)


def good_rows(lines: DataFrame) -> DataFrame:
    """Lines that fitted the schema."""
    return lines.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def broken_rows(lines: DataFrame) -> DataFrame:
    """Text of the lines that did not fit and what could be read of them, for quarantine."""
    read = [c for c in lines.columns if c != CORRUPT]
    broken = lines.filter(F.col(CORRUPT).isNotNull())
    return broken.select(F.col(CORRUPT).alias("line"), F.struct(*read).alias("parsed"))


def day_of_path(path: Column, day: str | dict[str, str]) -> Column:
    """The day of a batch file, or NULL.

    ``day`` is a one-group pattern for paths that hold ``2024-11-01`` or ``20241101``, or the day of
    each file name, as in ``{"day1_transactions.csv": "2024-11-01"}``.
    """
    if isinstance(day, dict):
        name = F.element_at(F.split(path, "/"), -1)
        text = F.coalesce(*(F.when(name == n, F.lit(d)) for n, d in day.items()), F.lit(""))
    else:
        text = F.regexp_extract(path, day, 1)
    digits = F.replace(text, F.lit("-"), F.lit(""))
    return F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("date")


def read_batch_csv(
    spark: SparkSession, paths: str | list[str], day: str | dict[str, str]
) -> DataFrame:
    """Daily batches with ``batch_day`` from the file path, see :func:`day_of_path`.

    Lines that do not fit keep their text in a column; split with :func:`good_rows` and
    :func:`broken_rows`.
    """
    reader = _csv_reader(spark, BATCH_TIMESTAMP_FORMAT)
    return _parsed(reader, schemas.DAILY_BATCH, paths, day_of_path(F.col("_metadata.file_path"), day))


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """CSV with a header, UTF-8, timestamps to the second."""
    writer = (
        df.write.option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("timestampFormat", BATCH_TIMESTAMP_FORMAT)
        .option("timestampNTZFormat", BATCH_TIMESTAMP_FORMAT)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


#: Lines of a compressed file, which one task reads.
LINES_PER_FILE = 1_000_000


def write_raw_csv(df: DataFrame, path: str, compressed: bool = False) -> None:
    """Raw transactions as CSV in the raw timestamp format; compressed files hold a bounded number of lines."""
    writer = (
        df.write.option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("timestampNTZFormat", RAW_TIMESTAMP_FORMAT)
    )
    if compressed:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE)
    writer.csv(path)


def write_report(report: DataFrame, path: str, form: str = "json") -> None:
    """A check report in long form, as JSON lines or Parquet."""
    report.write.format(form).save(path)
