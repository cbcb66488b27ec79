"""Allow and block rules on URLs.

Each URL is expanded into expressions: a suffix of its host (on label borders) followed by a prefix of
its path. Rules are such expressions too. Both sides carry a SHA-256 digest; they meet on its first
32 bits, the full digests are then compared, and of the rules that fit the one with precedence
decides. Only suffixes with as many labels and prefixes as long as some rule has are expanded, so the
number of expressions per URL follows the rules, not the URL's length.

Rules are broadcast when there are no more than ``MOST_BROADCAST``; larger lists are copied over salts,
so that an expression which a third of all URLs share is spread over tasks.

Precedence: the longest rule (host and path together), then the longer host, then block before allow. A
URL that no rule fits is allowed (``default`` says so), with a null rule. A null URL or one without
``://`` has an empty host and path and fits no rule. Repeated rows are judged each for itself; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BROADCAST = 100_000
SALTS = 32
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path of a URL; both empty without ``://``."""
    whole = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    host = F.regexp_extract(whole, _PARTS, 1)
    return F.translate(host, _UPPER, _UPPER.lower()), F.regexp_extract(whole, _PARTS, 2)


def _expressions(labels: list[int], lengths: list[int]) -> Column:
    """Host suffixes of so many labels, each with path prefixes of so many characters."""
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(F.array(*map(F.lit, labels)), lambda n: n <= F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n),
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def _digests(df: DataFrame, column: str) -> DataFrame:
    full = F.sha2(F.col(column), 256)
    return df.withColumn("digest", full).withColumn("short", F.substring("digest", 1, 8))


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
    default: str = "allow", most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """Each page's id, host, path, deciding ``rule`` and ``verdict``.

    ``rules`` has the columns host, path and verdict. The lists of label counts and path lengths in use
    come to the driver; a host has 127 labels at most, and path lengths are distinct small numbers.
    """
    host, path = host_and_path(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    known = rules.filter("host <> ''").select(
        F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("host_length"),
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("path_length"),
    )
    shape = known.agg(F.collect_set("labels").alias("labels"), F.collect_set("path_length").alias("lengths")).head()
    if not shape["labels"]:
        return _result(rows.withColumn("best", F.lit(None).cast("struct<rule:string,verdict:string>")), id_col, default)
    judged = _digests(known, "rule").select(
        "short", "digest",
        F.struct(F.length("rule").alias("length"), "host_length", (F.col("verdict") == "block").alias("block"), "rule", "verdict").alias("fits"),
    )
    expressions = rows.withColumn("expression", F.explode_outer(_expressions(sorted(shape["labels"]), sorted(shape["lengths"]))))
    expressions = _digests(expressions, "expression").drop("expression")
    keys = ["short"]
    if known.limit(most_broadcast + 1).count() <= most_broadcast:
        judged = F.broadcast(judged)
    else:
        keys = ["short", "salt"]
        judged = judged.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        expressions = expressions.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    right = judged.withColumnRenamed("digest", "rule_digest")
    met = expressions.join(right, keys, "left")
    confirmed = F.when(F.col("digest") == F.col("rule_digest"), F.col("fits"))
    best = met.groupBy("row", "page_id", "host", "path").agg(F.max(confirmed).alias("best"))
    return _result(best, id_col, default)


def _result(best: DataFrame, id_col: str, default: str) -> DataFrame:
    return best.select(
        F.col("page_id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def given_rules(spark) -> DataFrame:
    return spark.createDataFrame(RULES, "host string, path string, verdict string")


#: The same rows in SQL.
ORACLE = r"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
r(rule_host, rule_path, judged) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(judged, 'allow') AS verdict
FROM p LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule_host || rule_path) DESC) = 1
"""
