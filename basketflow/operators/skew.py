"""Joins and groupings that hold when one key carries a large share of the rows."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.session import materialize

# Rows of one key that a single task takes without trouble. Keys with more are split.
HOT_ROWS = 10_000_000
SAMPLES_PER_CUT = 50
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan; without statistics it errs on the large side."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", text).groups()
    return int(number) * _UNITS[unit]


def small_enough(df: DataFrame, max_bytes: int | None = None) -> bool:
    limit = broadcast_limit(df.sparkSession) if max_bytes is None else max_bytes
    return planned_bytes(df) <= limit


def hot_keys(df: DataFrame, keys: list[str], limit: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``limit`` rows and the number of ``parts`` of that size they make.

    Counts are combined before the shuffle, so finding a hot key does not suffer from it. The
    written table has at most ``rows / limit`` entries, which is what may be broadcast.
    """
    counts = df.groupBy(*[F.col(k).alias(f"_hot_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.ceil(F.col("_n") / limit).cast("int").alias("_parts")
    return materialize(counts.filter(F.col("_n") > limit).select("*", parts), "hot-keys")


def with_parts(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``_n`` and ``_parts`` of hot keys to their rows, null elsewhere; a missing key can be hot too."""
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    return df.join(F.broadcast(hot), same, "left").drop(*[f"_hot_{k}" for k in keys])


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str = "inner",
    spread: list[str] | None = None,
    max_bytes: int | None = None,
    hot_from: DataFrame | None = None,
    limit: int = HOT_ROWS,
) -> DataFrame:
    """Join rows to a table that is unique on ``on``.

    A lookup side whose planned size is within the broadcast limit is broadcast. Beyond it both
    sides are shuffled, and the rows of a key with more than ``limit`` rows are dealt out over as
    many copies of its one lookup row as it has parts. ``spread`` names columns that differ between
    rows of the same key (default: all others). The part is a hash of the row, so a retried task
    deals its rows the same way. ``hot_from`` names a cheaper table to count keys in, when ``rows``
    is the outcome of an aggregate.
    """
    if small_enough(lookup, max_bytes):
        return rows.join(F.broadcast(lookup), on, how)
    hot = hot_keys(rows if hot_from is None else hot_from, [on], limit)
    if hot.isEmpty():
        return rows.join(lookup, on, how)
    row_hash = F.xxhash64(*(spread or [c for c in rows.columns if c != on]))
    dealt = F.coalesce(F.pmod(row_hash, F.col("_parts")).cast("int"), F.lit(0))
    left = with_parts(rows, hot, [on]).withColumn("_salt", dealt).drop("_n", "_parts")
    last = F.coalesce("_parts", F.lit(1)) - 1
    right = with_parts(lookup, hot, [on]).withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_n", "_parts")
    return left.join(right, [on, "_salt"], how).drop("_salt")


def _cut_points(rows: DataFrame, hot_days: DataFrame, keys: list[str], tie: str) -> DataFrame:
    """Per hot day, values of ``tie`` that cut it into its parts, in blocks of about equal number.

    They come from a hash sample of some ``SAMPLES_PER_CUT`` rows per part.
    """
    span = 1 << 30
    chance = F.col("_parts") * SAMPLES_PER_CUT / F.col("_n")
    sampled = with_parts(rows, hot_days, keys).filter(F.pmod(F.xxhash64(tie), F.lit(span)) < chance * span)
    ordered = sampled.groupBy(*keys, "_parts").agg(F.array_sort(F.collect_list(tie)).alias("s"))
    every = F.transform(
        F.sequence(F.lit(1), F.col("_parts") - 1),
        lambda i: F.get("s", F.floor(i * F.size("s") / F.col("_parts")).cast("int")),
    )
    block = F.ceil(F.sqrt("_parts")).cast("int").alias("_block")
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("c") - 1) / F.col("_block")).cast("int")),
        lambda b: F.slice("c", b * F.col("_block") + 1, F.col("_block")),
    )
    return ordered.select(*keys, F.array_distinct(every).alias("c"), block).select(*keys, "_block", blocks.alias("_cuts"))


def with_pieces(
    df: DataFrame, group: str, day: str, tie: str, limit: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """Cut the histories of groups with more than ``limit`` rows into consecutive pieces along (``day``, ``tie``).

    Adds ``_day`` and ``_slot``, which together number the pieces of a group in order: null and 0 for
    ordinary groups, which stay whole; the day and 0 for hot groups; and slots 0, 1, 2, … within a
    day that itself has more than ``limit`` rows. Also returns the hot groups, or None, so that
    callers can stitch the pieces of just these.
    """
    no_day = F.lit(None).cast(df.schema[day].dataType)
    hot = hot_keys(df, [group], limit)
    if hot.isEmpty():
        return df.withColumns({"_day": no_day, "_slot": F.lit(0)}), None
    groups = hot.select(F.col(f"_hot_{group}").alias(group))
    out = with_parts(df, hot, [group]).withColumn("_day", F.when(F.col("_parts").isNotNull(), F.col(day))).drop("_n", "_parts")
    named = groups.select(F.col(group).alias("_group"))
    inside = df.join(F.broadcast(named), F.col(group).eqNullSafe(F.col("_group")), "left_semi")
    hot_days = hot_keys(inside, [group, day], limit)
    if hot_days.isEmpty():
        return out.withColumn("_slot", F.lit(0)), groups
    cuts = materialize(_cut_points(inside, hot_days, [group, day], tie), "cuts")
    # A row is compared with the first value of each block, then within one block.
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(day).eqNullSafe(F.col("_of"))
    placed = out.join(F.broadcast(cuts.withColumnsRenamed({group: "_group", day: "_of"})), same, "left").drop("_group", "_of")
    started = F.size(F.filter("_cuts", lambda b: b[0] <= F.col(tie)))
    within = F.size(F.filter(F.get("_cuts", F.col("_started") - 1), lambda c: c <= F.col(tie)))
    slot = F.when(F.col("_started") > 0, (F.col("_started") - 1) * F.col("_block") + within).otherwise(0)
    return (
        placed.withColumn("_started", started).withColumn("_slot", slot).drop("_cuts", "_started", "_block"),
        groups,
    )
