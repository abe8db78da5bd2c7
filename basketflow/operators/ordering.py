"""Exact global ranks without a single-task window.

Buckets need the keys at which they begin only (``selection``). For row numbers, a global sort
range-partitions the rows; ``monotonically_increasing_id`` after it holds partition number and row
number, so the rank of a row is the rows in earlier partitions plus its row number. Only one count
per partition reaches the driver. Sort keys must be unique: then the ranges are balanced however
often a leading value repeats, and ranks are the same on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.operators.selection import Order, before, keys_at
from basketflow.session import materialize

_ROW_BITS = 33


def _with_positions(df: DataFrame, orders: dict[str, list[Column]]) -> DataFrame:
    for name, keys in orders.items():
        df = df.orderBy(*keys).withColumn(name, F.monotonically_increasing_id())
    return materialize(df, "positions")


def _partition_counts(placed: DataFrame, names: list[str]) -> dict[str, list[tuple[int, int]]]:
    """(partition, rows) of each sort in partition order; bounded by the number of partitions."""
    labelled = F.explode(
        F.array(*[F.struct(F.lit(n).alias("name"), F.shiftright(n, _ROW_BITS).alias("part")) for n in names])
    )
    counted = placed.select(labelled.alias("p")).groupBy("p.name", "p.part").count().collect()
    return {n: sorted((r["part"], r["count"]) for r in counted if r["name"] == n) for n in names}


def with_ntiles(df: DataFrame, buckets: int, orders: dict[str, Order]) -> DataFrame:
    """Add ``ntile(buckets)`` over the whole table for each named order, which must end in a unique key.

    Nothing is sorted: the keys at which buckets begin are found by selection in the written table,
    and a bucket number is the count of such keys at or before the row's own. Of unequal buckets the
    larger ones come first.
    """
    table = materialize(df, "ranked")
    size, larger = divmod(table.count(), buckets)
    starts = [b * size + min(b, larger) for b in range(1, buckets)]
    tiles = {}
    for name, order in orders.items():
        tile = F.lit(1)
        found = keys_at(table, order, starts)
        for start in starts:
            if start in found:
                tile = tile + (~before(order, found[start])).cast("int")
        tiles[name] = tile
    return table.withColumns(tiles)


def with_row_index(df: DataFrame, keys: list[Column], name: str, start: int = 1) -> DataFrame:
    """Add the dense global row number in ``keys`` order, counted from ``start``."""
    placed = _with_positions(df, {"_at": keys})
    before, rows = start, []
    for part, count in _partition_counts(placed, ["_at"])["_at"]:
        rows.append((part, before))
        before += count
    spark = df.sparkSession
    offsets = spark.createDataFrame(rows, "_part long, _before long")
    row_number = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_part", F.shiftright("_at", _ROW_BITS))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + row_number)
        .drop("_part", "_at", "_before")
    )
