"""Purchases in an order that leaves out most files for one customer, one article or a few days.

Customers, articles and days are ranked, and the bits of the three ranks are interleaved: purchases
that are near in all three lie near each other. Files and row groups then span a small part of each,
and their statistics leave them out of reads that ask for any of the three.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.operators.bitmaps import value_numbers
from basketflow.operators.skew import lookup_join
from basketflow.session import materialize

DIMENSIONS = ("customer_id", "article_id", "t_dat")
# Bits of each rank that are interleaved, rows of a file and bytes of a row group.
BITS = 12
FILE_ROWS = 4_000_000
ROW_GROUP_BYTES = 8 << 20


def interleaved(ranks: list[Column], bits: int = BITS) -> Column:
    """One number of the bits of all ranks by turns, highest bits first."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for place, rank in enumerate(reversed(ranks)):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(one, bit * len(ranks) + place))
    return out


def with_place(
    df: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS, values: DataFrame | None = None
) -> DataFrame:
    """Add ``_place``, the interleaved bits of the ranks; a missing value ranks before all others.

    Ranks are dense numbers of the distinct values scaled to ``bits`` bits, so that every dimension has
    the same weight. A customer or article with a large share of the rows is dealt out in the joins.
    ``values``, if given, has the dimensions of all rows as a written table: they are read several times.
    """
    values = df if values is None else values
    ranked, ranks = df, []
    for i, column in enumerate(dimensions):
        numbers = value_numbers(values, column)
        count = numbers.count()
        others = [c for c in df.columns if c != column]
        scaled = F.floor((F.col("number") - 1) * F.lit(float((1 << bits) - 1)) / max(1, count - 1)).cast("long")
        named = numbers.select(column, scaled.alias(f"_rank{i}"))
        ranked = lookup_join(ranked, named, column, "left", spread=others, hot_from=values)
        ranks.append(F.coalesce(F.col(f"_rank{i}"), F.lit(0).cast("long")))
    return ranked.withColumn("_place", interleaved(ranks, bits)).drop(*[f"_rank{i}" for i in range(len(dimensions))])


def write_clustered(
    df: DataFrame,
    path: str,
    dimensions: tuple[str, ...] = DIMENSIONS,
    files: int | None = None,
    file_rows: int = FILE_ROWS,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Write ``df`` in clustered order: consecutive ranges of the order to the files, sorted inside.

    A file is what one task sorts: there is one per ``file_rows`` rows, or ``files`` if these are more.
    """
    values = materialize(df.select(*dimensions), "dimensions")
    count = max(files or 1, -(-values.count() // file_rows))
    # Rows in one place are told apart, so that a crowded place is spread over files, too.
    keys = ["_place", *dimensions]
    placed = with_place(df, dimensions, values=values)
    dealt = placed.repartitionByRange(count, *keys).sortWithinPartitions(*keys).drop("_place")
    dealt.write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(path)


def read_clustered(spark: SparkSession, path: str, **chosen: object) -> DataFrame:
    """The rows with the chosen values: a value, a list of values, or a (first, last) pair per column."""
    df = spark.read.parquet(path)
    for column, value in chosen.items():
        if isinstance(value, tuple):
            df = df.filter(F.col(column).between(F.lit(value[0]), F.lit(value[1])))
        elif isinstance(value, list):
            df = df.filter(F.col(column).isin(value))
        else:
            df = df.filter(F.col(column) == F.lit(value))
    return df
