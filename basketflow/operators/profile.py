"""Table profiles: null counts, statistics, histograms, segment counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.operators.selection import quantiles_of
from basketflow.session import materialize


def _long_form(one_row: DataFrame, name: str, rows: list[tuple[str, list[Column]]], columns: list[str]) -> DataFrame:
    """Turn the single row of a global aggregate into one row per entry."""
    entries = [
        F.struct(F.lit(label).alias(name), *[v.alias(c) for v, c in zip(values, columns, strict=True)])
        for label, values in rows
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def data_quality(df: DataFrame) -> DataFrame:
    """Row count, column count and nulls per column, from one aggregate over one scan."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"_n{i}") for i, c in enumerate(df.columns)],
    )
    rows = [
        (c, [F.col("_rows"), F.lit(len(df.columns)), F.col(f"_n{i}")]) for i, c in enumerate(df.columns)
    ]
    return _long_form(counted, "column_name", rows, ["row_count", "column_count", "null_count"])


def global_profile(transactions: DataFrame) -> DataFrame:
    """Date range and distinct customers and articles, one pass per distinct count."""
    articles = transactions.agg(F.count_distinct("article_id").alias("n")).scalar()
    return transactions.agg(
        F.min("t_dat").alias("min_date"),
        F.max("t_dat").alias("max_date"),
        F.count_distinct("customer_id").alias("num_customers"),
    ).withColumn("num_articles", articles)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def feature_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Mean, sample deviation, minimum and maximum of every numeric column, one row each."""
    columns = columns or numeric_columns(df)
    aggs = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        aggs += [
            F.mean(value).alias(f"_mean{i}"),
            F.stddev(value).alias(f"_std{i}"),
            F.min(value).alias(f"_min{i}"),
            F.max(value).alias(f"_max{i}"),
        ]
    rows = [(c, [F.col(f"_{s}{i}") for s in ("mean", "std", "min", "max")]) for i, c in enumerate(columns)]
    return _long_form(df.agg(*aggs), "feature", rows, ["mean", "std", "min", "max"])


QUARTILES = [0.25, 0.5, 0.75]


def feature_summary(df: DataFrame, columns: list[str], approximate: bool = False, accuracy: int = 10_000) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum of chosen columns.

    Quartiles are exact at any size: the value of rank ceil(share * count), found by selection in a
    written copy of the columns. ``approximate`` takes them from mergeable sketches instead, within
    ``rows / accuracy`` ranks, in the one pass of the other figures.
    """
    table = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    table = table if approximate else materialize(table, "summarised")
    exact = {} if approximate else quantiles_of(table, columns, QUARTILES)
    aggs, quartiles = [], {}
    for i, c in enumerate(columns):
        aggs += [
            F.count(c).alias(f"_count{i}"),
            F.mean(c).alias(f"_mean{i}"),
            F.stddev(c).alias(f"_std{i}"),
            F.min(c).alias(f"_min{i}"),
            F.max(c).alias(f"_max{i}"),
        ]
        if approximate:
            aggs.append(F.percentile_approx(c, QUARTILES, accuracy).alias(f"_q{i}"))
            quartiles[c] = [F.get(f"_q{i}", j) for j in range(len(QUARTILES))]
        else:
            quartiles[c] = [F.lit(v).cast("double") for v in exact[c]]
    rows = [
        (c, [F.col(f"_count{i}"), F.col(f"_mean{i}"), F.col(f"_std{i}"), F.col(f"_min{i}"), *quartiles[c], F.col(f"_max{i}")])
        for i, c in enumerate(columns)
    ]
    return _long_form(table.agg(*aggs), "feature", rows, ["count", "mean", "std", "min", "p25", "p50", "p75", "max"])


def feature_histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between minimum and maximum, the upper edge in the last bin; empty bins show 0.

    Reads ``df`` twice, for the edges and for the counts: pass a written table.
    """
    value = F.col(column).cast("double")
    present = df.select(value.alias("v")).filter("v is not null")
    lo, hi = F.min("v"), F.max("v")
    # A constant column gets a unit-wide range around its value.
    constant = lo == hi
    edges = F.struct(
        F.when(constant, lo - 0.5).otherwise(lo).alias("start"),
        (F.when(constant, 1.0).otherwise(hi - lo) / bins).alias("width"),
    )
    range_of = present.agg(edges.alias("e")).scalar()
    start, width = F.col("e")["start"], F.col("e")["width"]
    in_bin = F.least(F.floor((F.col("v") - start) / width), F.lit(bins - 1)).cast("int")
    counts = present.withColumn("e", range_of).groupBy(in_bin.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), range_of.alias("e"))
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (start + F.col("bin") * width).alias("bin_start"),
        (start + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )


def segment_distribution(df: DataFrame, segment: str = "age_group") -> DataFrame:
    return df.groupBy(segment).agg(F.count(F.lit(1)).alias("num_customers")).orderBy(segment)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, in one job."""
    counts = [df.agg(F.count(F.lit(1)).alias("num_rows")).select(F.lit(n).alias("table_name"), "num_rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
