"""What several operators share: white space, word counts, and tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.session import scratch_path

#: One or more characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE_SPACE = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]


def whole_text(text: str | Column) -> Column:
    """The text, or an empty one for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: str | Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def without_white_space(text: str | Column) -> Column:
    """The text without its ASCII white space; six byte searches are faster than a pattern."""
    result = whole_text(text)
    for white in WHITE_SPACE:
        result = F.replace(result, F.lit(white), F.lit(""))
    return result


def quoted(name: str) -> str:
    """A column's name that may hold dots and backticks."""
    return f"`{name.replace('`', '``')}`"


#: Files whose numbers are sent to every task (some 10 MB).
MOST_FILES = 100_000
#: Bits of a row's number within its file.
ROW_BITS = 40


def with_row_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number that tells its rows apart, and the name of that column.

    Rows of Parquet files have one already, by file and place within it, which every scan finds again, so that no
    copy is needed. Other rows are written once. A file may be read only once by ``docs``.
    """
    name = "_row"
    while name in map(str.lower, docs.columns):
        name += "_"
    scratch = Scratch(docs.sparkSession, "rows")
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias(f"{name}f"), F.col("_metadata.row_index").alias(f"{name}i"))
    except AnalysisException:  # not read from Parquet files
        return scratch.write(docs.withColumn(name, F.monotonically_increasing_id()), "keyed"), name
    in_order = Window.orderBy(f"{name}f")  # a row per file
    files = placed.select(f"{name}f").distinct().withColumn(f"{name}n", F.row_number().over(in_order).cast("long"))
    files = scratch.write(files, "files")
    few = files.limit(MOST_FILES + 1).count() <= MOST_FILES
    key = F.shiftleft(F.col(f"{name}n"), ROW_BITS) + F.col(f"{name}i")
    keyed = placed.join(F.broadcast(files) if few else files, f"{name}f")
    return keyed.select(*map(quoted, docs.columns), key.alias(name)), name


#: Row keys that may be sent to every task: 16 MB.
MOST_IDS = 2_000_000


def without_rows(keyed: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """``keyed`` without its column ``key`` and without the rows whose keys are the one column of ``dropped``, which is
    written first.

    Up to ``MOST_IDS`` keys go to the tasks that read the documents, so that texts stay where they are; more are
    joined by shuffle.
    """
    keys = Scratch(keyed.sparkSession, "dropped").write(dropped, "keys")
    few = keys.limit(MOST_IDS + 1).count() <= MOST_IDS
    return keyed.join(F.broadcast(keys) if few else keys, key, "left_anti").drop(key)


#: What a task holds at once of rows with whole texts or sets: rows of a Parquet batch, bytes of an Arrow batch.
BOUNDED = {
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """For writes that read whole texts or sets of shingles: batches of a few MB, which a task holds several times over.

    Spark's own 4,096 rows of Parquet and 64 MB of Arrow are meant for narrow rows. The settings are as before afterwards.
    """
    before = {key: spark.conf.get(key) for key in BOUNDED}
    try:
        for key, value in BOUNDED.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


class Scratch:
    """Tables written to the shared folder on behalf of one run of an operator.

    Each written table survives lost executors and cuts the lineage. Tables that the result no
    longer reads are released, so that the folder holds little more than what is still needed.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.name = name
        self._paths: dict[int, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.name}-{name}")
        df.write.parquet(path)
        written = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(written)] = path
        return written

    def release(self, *tables: DataFrame) -> None:
        """Delete the files of tables that nothing will read again."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(self._paths.pop(id(table)))
            path.getFileSystem(conf).delete(path, True)
