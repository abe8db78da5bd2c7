"""Reading raw files and tables, writing tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.functions.dates import MONTH, PURCHASE_DAY, as_date, in_months
from basketflow.session import delete_folder
from basketflow.sources.schemas import CORRUPT

# Equal rows are numbered in runs of this length.
_RUN = 100_000


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    mode: str = "PERMISSIVE",
    keep_corrupt: bool = False,
) -> DataFrame:
    """CSV with a header. A declared schema saves the extra pass over the files that inference costs.

    ``keep_corrupt`` adds the text of unreadable lines, so that bad rows can be counted and shown
    instead of turning into silent nulls.
    """
    reader = spark.read.option("header", True).option("mode", mode)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a parquet folder when ``name`` is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def write_table(
    df: DataFrame, name: str, path: str | None = None, bucket_by: str | None = None, buckets: int = 0
) -> DataFrame:
    """Replace a table, schema included, and read it back.

    ``name`` is a catalog table or a parquet folder; ``path`` places a catalog table's files. A
    catalog table bucketed by a key is joined and grouped on that key without a shuffle.
    """
    if "/" in name:
        df.write.mode("overwrite").parquet(name)
        return read_table(df.sparkSession, name)
    if bucket_by:
        # Rows meet by bucket, so that few tasks write to each; a large bucket is split over several.
        bucket = F.pmod(F.hash(bucket_by), F.lit(buckets)).alias("_bucket")
        dealt = df.withColumn("_bucket", bucket).hint("rebalance", "_bucket").drop("_bucket")
        writer = dealt.write.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    else:
        writer = df.write
    if path:
        writer = writer.option("path", path)
    writer.mode("overwrite").saveAsTable(name)
    return read_table(df.sparkSession, name)


def write_version(df: DataFrame, name: str, folder: str, check: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """Replace a catalog table by a new version in a folder of its own under ``folder``.

    The version is written once and checked there; then the table is pointed at it and the versions
    before are deleted. If the check fails the table stays as it was. Readers that have begun on the
    old version should be done before the next one.
    """
    spark = df.sparkSession
    path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        written = spark.read.parquet(path)
        if check:
            check(written)
    except Exception:
        delete_folder(spark, path)
        raise
    before = spark.catalog.tableExists(name)
    old = _location(spark, name) if before else None
    if before and spark.table(name).schema == written.schema:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path, "parquet")
    spark.catalog.refreshTable(name)
    if old and urlsplit(old).path.startswith(urlsplit(folder).path.rstrip("/") + "/"):
        delete_folder(spark, old)
    return spark.table(name)


def _location(spark: SparkSession, name: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def write_by_month(transactions: DataFrame, path: str) -> None:
    """Write purchases partitioned by ``year_month``.

    Rebalancing gathers each month in few writers and splits a large month at the advisory
    partition size, so neither many tiny files nor one task with a whole large month arise.
    """
    transactions.hint("rebalance", "year_month").write.mode("overwrite").partitionBy("year_month").parquet(path)


def read_by_month(
    spark: SparkSession,
    path: str,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """Purchases between two dates from a table written by ``write_by_month``.

    The month predicate is derived from the dates, so only the folders in range are listed. Operators
    that take a date range add theirs, too, while the column ``year_month`` is there.
    """
    out = spark.read.option("basePath", path).parquet(path)
    out = out.withColumn(MONTH, F.col(MONTH).cast("string"))
    first = F.col(PURCHASE_DAY) >= as_date(start) if start is not None else F.lit(True)
    last = F.col(PURCHASE_DAY) <= as_date(end) if end is not None else F.lit(True)
    return out.filter(first & last & in_months(out, PURCHASE_DAY, start, end))


def row_text(df: DataFrame) -> Column:
    """The values of a row as one text, each behind its length: rows that differ differ in it."""
    texts = [F.col(c).cast("string") for c in df.columns]
    return F.concat_ws("|", *[F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts])


def with_surrogate_key(df: DataFrame, name: str = "transaction_id", text: Column | None = None) -> DataFrame:
    """A unique id per row that is the same on every load: a digest of the row and a number.

    Equal rows are numbered from 1. They are counted and written out again rather than ranked, so
    rows that repeat without limit meet in no task. ``text`` is what the digest is of: by default all
    values; rows that differ must differ in it.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    runs = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"), F.lit(_RUN).cast("long")))
    cut = counted.withColumn("_from", runs)
    numbers = F.explode(F.sequence(F.col("_from"), F.least("_n", F.col("_from") + _RUN - 1)))
    numbered = cut.withColumn("_number", numbers)
    key = F.concat_ws("-", F.md5(text if text is not None else row_text(df)), F.col("_number").cast("string"))
    return numbered.select(*df.columns, key.alias(name))


def submission(predictions: DataFrame) -> DataFrame:
    """customer_id and its list as one space-joined text."""
    return predictions.select("customer_id", F.concat_ws(" ", F.col("predicted_articles").cast("array<string>")).alias("prediction"))


def write_submission(predictions: DataFrame, path: str, single_file: bool = False) -> None:
    out = submission(predictions)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).csv(path)
