"""Digests of snapshots by key range, so that only what differs is read and joined.

A snapshot is written in buckets of its key's hash. A bucket's digest is its number of rows and the
exclusive or of two 64-bit hashes of every row: the order of rows doesn't count. Digests of sixteen
neighbours make the digest above them, up to one for the whole snapshot. Two snapshots are compared
from the top, and only below nodes that differ; rows of equal buckets are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.sources.files import write_table
from basketflow.streaming.change_feed import change_feed

BUCKETS = 256
FAN_OUT_BITS = 4


def _bucket(keys: list[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_snapshot(df: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Write rows by bucket and their digests; the digests, one row (level, node, n, a, b) per node.

    Level 0 has the buckets. ``buckets`` has to be a power of two and the same for all snapshots that
    are compared.
    """
    if buckets & (buckets - 1):
        raise ValueError(f"the number of buckets is a power of two, not {buckets}")
    dealt = df.withColumn("_bucket", _bucket(keys, buckets)).hint("rebalance", "_bucket")
    dealt.write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/rows")
    return write_table(digests(df, keys, buckets), f"{path}/digests")


def digests(df: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(level, node, n, a, b) of every node that has rows, combined before the shuffle."""
    columns = sorted(df.columns)
    # A missing value is hashed apart: the hash of a row would pass over it.
    marks = [F.coalesce(F.col(c).isNull().cast("int"), F.lit(0)) for c in columns]
    rows = df.select(
        _bucket(keys, buckets).alias("node"),
        F.xxhash64(*columns, *marks).alias("a"),
        F.xxhash64(F.lit(1), *marks, *reversed(columns)).alias("b"),
    )
    level = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    nodes = F.explode(
        F.array(*[
            F.struct(F.lit(up).alias("level"), F.shiftright("node", up * FAN_OUT_BITS).alias("node"))
            for up in range(_height(buckets) + 1)
        ])
    ).alias("at")
    return (
        level.select(nodes, "n", "a", "b").groupBy("at.level", "at.node")
        .agg(F.sum("n").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    )


def _height(buckets: int) -> int:
    return -(-(buckets.bit_length() - 1) // FAN_OUT_BITS)


def differing_buckets(before: DataFrame, after: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Buckets whose digests differ, from the root down; one small job per level that differs."""
    nodes = [0]
    for level in range(_height(buckets), -1, -1):
        here = (F.col("level") == level) & F.col("node").isin(nodes)
        one, other = (d.filter(here).select("node", F.struct("n", "a", "b").alias("digest")) for d in (before, after))
        joined = one.withColumnRenamed("digest", "old").join(other.withColumnRenamed("digest", "new"), "node", "full")
        found = [r["node"] for r in joined.filter(~F.col("old").eqNullSafe(F.col("new"))).select("node").collect()]
        if not found or level == 0:
            return sorted(found)
        nodes = [n << FAN_OUT_BITS | i for n in found for i in range(1 << FAN_OUT_BITS)]
    return []


def changes_between(spark: SparkSession, before: str, after: str, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The change rows that turn one written snapshot into another, from the buckets that differ.

    Rows that differ in a bucket of equal digests would be missed: that takes two hashes of 64 bits,
    and the number of rows, to agree by chance.
    """
    old, new = (spark.read.parquet(f"{path}/digests") for path in (before, after))
    nodes = differing_buckets(old, new, buckets)
    rows = [spark.read.parquet(f"{path}/rows").filter(F.col("_bucket").isin(nodes)).drop("_bucket") for path in (before, after)]
    return change_feed(rows[0], rows[1], keys)
