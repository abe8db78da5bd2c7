"""Search for a part of a text without reading all texts: posting lists of trigrams.

The index holds, for every three characters in a row, the keys of the rows whose text has them. A row
that contains a searched text has all its trigrams; the rows that have them are looked up, read by
key, and searched. Postings lie in buckets by trigram, sorted inside, and rows are sorted by key: file
statistics leave out most of both. A searched text of less than three characters has no trigram, and
all texts are searched for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.operators.filters import contains_text

GRAM = 3
BUCKETS = 64
# Keys that are handed to the scan of the rows; more are joined.
KEYS_IN_SCAN = 1_000
# Rows of a file, and of a row group's bytes: small ones leave out more.
ROW_GROUP_BYTES = 1 << 20


def trigrams(text: Column) -> Column:
    """The distinct runs of three characters; none of a missing or shorter text."""
    signs = F.split(text, "")
    places = F.sequence(F.lit(1), F.size(signs) - (GRAM - 1))
    runs = F.transform(places, lambda i: F.concat(*[F.element_at(signs, i + k) for k in range(GRAM)]))
    return F.when(F.char_length(text) >= GRAM, F.array_distinct(runs))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.hash(gram), F.lit(BUCKETS)).alias("bucket")


def write_index(df: DataFrame, key: str, columns: list[str], path: str) -> None:
    """Write the rows, sorted by their unique ``key``, and the postings of the texts in ``columns``.

    A frequent trigram is spread over the writers of its bucket.
    """
    rows = df.repartitionByRange(key).sortWithinPartitions(key)
    rows.write.option("parquet.block.size", ROW_GROUP_BYTES).mode("overwrite").parquet(f"{path}/rows")
    texts = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("text")) for c in columns])).alias("t")
    grams = df.select(F.col(key).alias("key"), texts).select("key", F.col("t.name").alias("column"), F.explode(trigrams(F.col("t.text"))).alias("gram"))
    dealt = grams.select(_bucket(F.col("gram")), "gram", "column", "key").hint("rebalance", "bucket")
    postings = dealt.sortWithinPartitions("bucket", "gram", "column", "key").write.partitionBy("bucket")
    postings.option("parquet.block.size", ROW_GROUP_BYTES).mode("overwrite").parquet(f"{path}/postings")


def _parts(spark: SparkSession, search: str) -> list[tuple[int, str]]:
    """(bucket, trigram) of a searched text, by the same expressions as in the index."""
    gram = F.explode(trigrams(F.lit(search))).alias("gram")
    return [tuple(r) for r in spark.range(1).select(gram).select(_bucket(F.col("gram")), "gram").collect()]


def candidates(spark: SparkSession, path: str, search: str) -> DataFrame | None:
    """(key) of the rows with all trigrams of ``search`` in one column; None if it has none."""
    parts = _parts(spark, search)
    if not parts:
        return None
    postings = spark.read.parquet(f"{path}/postings").filter(
        F.col("bucket").isin(sorted({b for b, _ in parts})) & F.col("gram").isin([g for _, g in parts])
    )
    # A trigram is listed once per row and column.
    whole = postings.groupBy("column", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(parts))
    return whole.select("key").distinct()


def search_index(spark: SparkSession, path: str, key: str, search: str, *columns: str) -> DataFrame:
    """The indexed rows of which some column contains ``search``, as ``contains_text`` finds them."""
    rows = spark.read.parquet(f"{path}/rows")
    found = contains_text(search, *columns)
    keys = candidates(spark, path, search) if search else None
    if keys is None:
        return rows.filter(found)
    few = [r["key"] for r in keys.limit(KEYS_IN_SCAN + 1).collect()]
    if len(few) <= KEYS_IN_SCAN:
        return rows.filter(F.col(key).isin(few) & found)
    return rows.join(keys.withColumnRenamed("key", key), key, "left_semi").filter(found)
