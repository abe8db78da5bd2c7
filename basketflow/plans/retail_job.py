"""The data job: raw files to tables, tables to summaries, summaries to serving snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.config import ServingTable
from basketflow.functions.dates import with_date_features
from basketflow.operators import gold
from basketflow.operators.profile import data_quality
from basketflow.session import materialize, scratch_scope
from basketflow.sources import schemas
from basketflow.sources.files import read_by_month, read_csv, with_surrogate_key, write_by_month, write_table
from basketflow.sources.serving import ServingStore, verify_tables


# The share of lines of a file set that may be unreadable.
MAX_REJECTED = 0.01


class TooManyRejects(ValueError):
    """More lines than allowed do not fit the declared schema."""


def read_checked(spark: SparkSession, path: str, schema: T.StructType, rejects: str, max_rejected: float = MAX_REJECTED) -> DataFrame:
    """The readable rows of a CSV file set; the others are written to ``rejects`` as they stood.

    The files are parsed once, into a scratch table. Raises if too large a share is unreadable.
    """
    lines = materialize(read_csv(spark, path, schema, keep_corrupt=True), "lines")
    bad = F.col(schemas.CORRUPT).isNotNull()
    total, rejected = lines.agg(F.count(F.lit(1)), F.count(F.when(bad, 1))).first()
    if rejected:
        lines.filter(bad).select(schemas.CORRUPT).write.mode("overwrite").parquet(rejects)
    if rejected > max_rejected * total:
        raise TooManyRejects(f"{rejected} of {total} lines of {path} do not fit; see {rejects}")
    return lines.filter(~bad).drop(schemas.CORRUPT)


def ingest(spark: SparkSession, raw: dict[str, str], out: str, max_rejected: float = MAX_REJECTED) -> dict[str, DataFrame]:
    """Articles, customers and purchases from CSV files to parquet; purchases get date columns and an id.

    Unreadable lines are kept aside under ``rejects``; null counts of all columns go to ``quality``,
    and every table is verified to be there. Purchase ids are the same on every load.
    """
    with scratch_scope(spark, "ingest"):

        def read(name: str, schema: T.StructType) -> DataFrame:
            return read_checked(spark, raw[name], schema, f"{out}/rejects/{name}", max_rejected)

        tables = {
            "articles": write_table(read("articles", schemas.ARTICLES), f"{out}/articles"),
            "customers": write_table(read("customers", schemas.CUSTOMERS), f"{out}/customers"),
        }
        purchases = with_date_features(with_surrogate_key(read("transactions", schemas.TRANSACTIONS)))
        write_by_month(purchases, f"{out}/transactions")
        tables["transactions"] = read_by_month(spark, f"{out}/transactions")
        checks = [data_quality(df).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
        write_table(reduce(DataFrame.unionByName, checks), f"{out}/quality")
        counts = {r["table_name"]: r["num_rows"] for r in verify_tables(spark, tables).collect()}
        empty = [name for name, n in counts.items() if not n]
        if empty:
            raise LookupError(f"empty tables: {', '.join(empty)}")
    return tables


def build_gold(tables: dict[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """Write the summary tables and return them as read back."""
    articles, customers, purchases = tables["articles"], tables["customers"], tables["transactions"]
    frames = {
        "product_sales_summary": gold.product_sales_summary(purchases, articles),
        "customer_demographics": gold.customer_demographics(customers, purchases),
        "time_series_sales": gold.time_series_daily(purchases),
        "category_insights": gold.category_insights(purchases, articles),
    }
    return {name: write_table(df, f"{out}/{name}") for name, df in frames.items()}


# The keys of the published tables.
SERVING_KEYS = {
    "articles": ["article_id"],
    "customers": ["customer_id"],
    "transactions": ["transaction_id"],
    "product_sales_summary": ["article_id"],
    "customer_demographics": ["customer_id"],
    "time_series_sales": ["date"],
    "category_insights": ["product_group_name", "product_type_name"],
}


def publish_all(store: ServingStore, tables: dict[str, DataFrame], catalog: str, schema: str) -> DataFrame:
    configs = [
        ServingTable(name, f"{catalog}.{schema}.{name}_synced", keys)
        for name, keys in SERVING_KEYS.items()
        if name in tables
    ]
    return store.publish_many(configs, tables, skip_if_exists=False)
