"""Slowly changing dimensions: overwrite, versions, and point-in-time lookup."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.conform import audit_time
from tallyhouse.operators.fact import SPREAD
from tallyhouse.operators.keys import extend_keys
from tallyhouse.operators.ordered import carried_forward, with_neighbours, with_positions
from tallyhouse.session import stage


def latest_per_key(rows: DataFrame, key: str, *newest: str | Column) -> DataFrame:
    """One row per key, the newest by the given order; equal ones are settled by their content.

    A maximum with map-side pre-aggregation, so a key with very many rows stays cheap.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in newest]
    ranked = F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)),
                      F.struct(*rows.columns).alias("row"))
    top = rows.groupBy(key).agg(F.max(ranked).alias("top"))
    # the key itself is kept, not its copy in the row: a join on it then needs no new shuffle
    return top.select(*(F.col(c) if c == key else F.col(f"top.row.{c}") for c in rows.columns))


def scd1_apply(
    dim: DataFrame,
    updates: DataFrame,
    natural_key: str,
    key_name: str,
    attributes: list[str],
    newest_by: str | None = None,
    load_ts: datetime | None = None,
) -> DataFrame:
    """Overwrite attributes in place; surrogate keys stay, unseen natural keys are added.

    A NULL in the update keeps the old value. With several updates per key the newest wins.
    """
    known = updates.filter(F.col(natural_key).isNotNull())
    order = [newest_by] if newest_by else attributes
    newest = latest_per_key(known, natural_key, *order).select(natural_key, *attributes)
    arriving = newest.select(
        F.col(natural_key).alias("_key"), *(F.col(a).alias(f"_new_{a}") for a in attributes)
    )
    joined = dim.join(arriving, dim[natural_key] == F.col("_key"), "left")
    differs = reduce(
        lambda a, b: a | b,
        [
            F.col(f"_new_{a}").isNotNull() & ~F.col(f"_new_{a}").eqNullSafe(F.col(a))
            for a in attributes
        ],
    )
    values = {a: F.coalesce(f"_new_{a}", a) for a in attributes}
    values["updated_at"] = F.when(differs, audit_time(load_ts)).otherwise(F.col("updated_at"))
    kept = joined.select(*(values.get(c, F.col(c)).alias(c) for c in dim.columns))
    added = extend_keys(dim, newest, natural_key, key_name)
    stamped = added.withColumns(
        {"created_at": audit_time(load_ts), "updated_at": audit_time(load_ts)}
    )
    return kept.unionByName(_shaped(stamped, dim))


def _shaped(rows: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` in order, missing ones as typed NULL."""
    return rows.select(
        *(
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType)
            .alias(f.name)
            for f in like.schema
        )
    )


def _changed(tracked: list[str], before: Column) -> Column:
    return reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(before[c]) for c in tracked])


def scd2_apply(
    dim: DataFrame,
    updates: DataFrame,
    natural_key: str,
    key_name: str,
    tracked: list[str],
    at: str,
    load_ts: datetime | None = None,
) -> DataFrame:
    """Close the open version and insert new ones where a tracked attribute changes.

    ``updates`` has the natural key, the tracked columns and the time ``at``. Several updates of
    a key in one batch form a chain. Updates that change nothing, or are not newer than the open
    version, are ignored, so applying a batch twice is harmless. Versions are valid from their
    start up to, not including, their end.
    """
    arriving = (
        updates.filter(F.col(natural_key).isNotNull() & F.col(at).isNotNull())
        .groupBy(natural_key, F.col(at).cast("timestamp").alias("_at"))
        .agg(F.max(F.struct(*tracked)).alias("_values"))
        .select(natural_key, "_at", "_values.*")
    )
    carried = [
        c for c in dim.columns
        if c not in {natural_key, key_name, *tracked, "effective_start_date",
                     "effective_end_date", "is_current", "created_at", "updated_at"}
    ]
    open_now = dim.filter(F.col("is_current"))
    known = open_now.select(
        F.col(natural_key).alias("_key"), F.col("effective_start_date").alias("_since"), *carried
    )
    newer = stage(
        arriving.join(known, arriving[natural_key] == F.col("_key"), "left")
        .filter(F.col("_since").isNull() | (F.col("_at") > F.col("_since")))
        .drop("_key", "_since"),
        "updates",
    )
    touched = newer.select(F.col(natural_key).alias("_touched")).distinct()
    is_touched = F.col("is_current") & (F.col(natural_key) == F.col("_touched"))
    untouched = dim.join(touched, is_touched, "left_anti")
    bases = open_now.join(touched, F.col(natural_key) == F.col("_touched"), "left_semi")

    chain = bases.withColumns(
        {"_at": F.col("effective_start_date"), "_new": F.lit(0)}
    ).unionByName(newer.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    compared = with_neighbours(chain, natural_key, ["_at", "_new"], tracked)
    versions = compared.filter(
        (F.col("_new") == 0) | F.col("previous").isNull() | _changed(tracked, F.col("previous"))
    ).drop("previous", "following")
    linked = with_neighbours(versions, natural_key, ["_at", "_new"], ["_at"])
    ends = F.col("following")["_at"]

    closed = linked.filter(F.col("_new") == 0).withColumns(
        {
            "effective_end_date": F.coalesce(ends, F.col("effective_end_date")),
            "is_current": ends.isNull(),
            "updated_at": F.when(ends.isNotNull(), audit_time(load_ts)).otherwise(
                F.col("updated_at")
            ),
        }
    )
    inserted = linked.filter(F.col("_new") == 1).withColumns(
        {
            "effective_start_date": F.col("_at"),
            "effective_end_date": ends,
            "is_current": ends.isNull(),
            "created_at": audit_time(load_ts),
            "updated_at": audit_time(load_ts),
        }
    )
    top = dim.select(F.coalesce(F.max(key_name), F.lit(0))).scalar()
    numbered = with_positions(inserted, natural_key, "_at", into="_nth").withColumn(
        key_name, F.col("_nth") + top
    )
    return untouched.unionByName(_shaped(closed, dim)).unionByName(_shaped(numbered, dim))


#: Versions that may be sent to every task of a point-in-time lookup.
MOST_BROADCAST = 200_000
#: Versions of a key that may stand in one row of such a lookup.
MOST_PER_KEY = 10_000


def point_in_time_lookup(
    facts: DataFrame,
    versions: DataFrame,
    natural_key: str,
    at: str,
    take: list[str],
    first_version_open: bool = True,
) -> DataFrame:
    """Attributes of the version that was valid when the fact happened; NULL if there is none.

    A history of at most ``MOST_BROADCAST`` versions is sent to the facts, which stay where they are, as one
    sorted array per key. A longer one is met in the same form by shuffling the facts once by key, busy keys split at
    run time. Only if a key has more than ``MOST_PER_KEY`` versions, facts and versions are sorted together and the
    version is carried forward, so neither a busy key nor a key with many versions multiplies rows. With
    ``first_version_open`` the first version of a key also covers the time before it. A fact without a time has no
    version.
    """
    first = versions.groupBy(F.col(natural_key).alias("_key")).agg(
        F.min("effective_start_date").alias("_first")
    )
    starts = F.col("effective_start_date").cast("timestamp_ntz")
    if first_version_open:
        versions = versions.join(first, versions[natural_key] == F.col("_key"), "left")
        # NULL sorts before every time
        starts = F.when(F.col("effective_start_date") > F.col("_first"), starts)
    marks = versions.filter(F.col(natural_key).isNotNull()).select(
        F.col(natural_key).alias("_k"),
        starts.alias("_t"),
        F.lit(0).alias("_kind"),
        F.struct(
            F.col("effective_end_date").cast("timestamp_ntz").alias("until"), *take
        ).alias("_version"),
    )
    per_key = marks.groupBy("_k").count()
    total, longest = per_key.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).head()
    if total <= MOST_BROADCAST or longest <= MOST_PER_KEY:
        return _met_by_arrays(facts, marks, natural_key, at, take, longest, total <= MOST_BROADCAST)
    events = facts.select(
        F.col(natural_key).alias("_k"),
        F.col(at).cast("timestamp_ntz").alias("_t"),
        F.lit(1).alias("_kind"),
        F.struct(*facts.columns).alias("_fact"),
    )
    together = marks.unionByName(events, allowMissingColumns=True)
    filled = carried_forward(together, "_k", ["_t", "_kind"], "_version", "_valid")
    valid = F.col("_valid")
    holds = F.col("_t").isNotNull() & (valid["until"].isNull() | (F.col("_t") < valid["until"]))
    return filled.filter(F.col("_kind") == 1).select(
        "_fact.*", *(F.when(holds, valid[c]).alias(c) for c in take)
    )


def _met_by_arrays(
    facts: DataFrame, marks: DataFrame, natural_key: str, at: str, take: list[str], longest: int, sent: bool
) -> DataFrame:
    """The lookup by a sorted array per key, of ``longest`` versions at most, searched by halving.

    The arrays are sent to the facts, or with ``sent`` false met by a shuffle, in which facts without a key are spread.

    A fact meets one row, whatever the versions of its key, and looks at the logarithm of their number. The last
    version that has started holds until its end.
    """
    listed = marks.groupBy("_k").agg(F.sort_array(F.collect_list(F.struct("_t", "_version"))).alias("_all"))
    histories = listed.select(
        "_k", F.transform("_all", lambda x: x["_t"]).alias("_starts"),
        F.transform("_all", lambda x: x["_version"]).alias("_versions"),
    )
    same = F.col(natural_key) == F.col("_k")
    if sent:
        met = facts.join(F.broadcast(histories), same, "left")  # bounded by MOST_BROADCAST
    else:
        apart = F.pmod(F.xxhash64(*facts.columns), F.lit(SPREAD)).cast("int")
        place = F.when(F.col(natural_key).isNull(), apart).otherwise(0)
        met = facts.join(histories.withColumn("_place", F.lit(0)), same & (place == F.col("_place")), "left")
    moment, begun = F.col(at).cast("timestamp_ntz"), F.col("_begun")
    placed = met.select(*(facts[c] for c in facts.columns), "_starts", "_versions", F.lit(0).alias("_begun"))
    # how many versions have begun, a power of two at a time; a projection each, so that all is compiled
    for stride in (1 << i for i in reversed(range(longest.bit_length()))):
        start = F.get("_starts", begun + (stride - 1))
        more = (begun + stride <= F.size("_starts")) & (start.isNull() | (start <= moment))
        placed = placed.withColumn("_begun", F.when(more, begun + stride).otherwise(begun))
    found = placed.withColumn("_valid", F.when(moment.isNotNull() & (begun > 0), F.get("_versions", begun - 1)))
    until = F.col("_valid")["until"]
    holds = until.isNull() | (moment < until)
    return found.select(*facts.columns, *(F.when(holds, F.col("_valid")[c]).alias(c) for c in take))
