"""Queries over sources and sinks."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.config import ServingTable
from basketflow.functions.dates import with_date_features
from basketflow.operators import features, gold, recommend
from basketflow.operators.profile import row_counts
from basketflow.registry import models
from basketflow.registry.common import DAILY, DEMOGRAPHICS, MODELS, SALES, Inputs, query, r4, rounded, sql
from basketflow.session import materialize, scratch_path
from basketflow.sources import clustered, files, keyed, schemas
from basketflow.sources.namespace import Namespace, ensure_namespace
from basketflow.sources.serving import ServingStore, verify_tables
from basketflow.streaming import digests as snapshots
from basketflow.streaming.change_feed import as_log, change_feed
from basketflow.streaming.publish import refreshed, start_refresh


@query("csv_ingest", sql(select="SELECT * FROM articles"))
def csv_ingest(x: Inputs) -> DataFrame:
    path = scratch_path(x.spark, "articles-csv")
    x.articles.select(*schemas.ARTICLES.fieldNames()).write.option("header", True).csv(path)
    return files.read_csv(x.spark, path, schemas.ARTICLES)


@query("table_read", "SELECT * FROM customer")
def table_read(x: Inputs) -> DataFrame:
    return files.read_table(x.spark, f"{x.sf_dir}/customer.parquet")


@query("table_overwrite", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def table_overwrite(x: Inputs) -> DataFrame:
    """Overwrites a table of another schema under the same name."""
    orders = files.read_table(x.spark, f"{x.sf_dir}/orders.parquet")
    name, path = f"overwrite_{uuid.uuid4().hex}", scratch_path(x.spark, "overwrite")
    files.write_table(orders.select("o_orderkey", "o_orderpriority"), name, path)
    return files.write_table(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), name, path)


@query(
    "partitioned_write",
    sql(
        select="""SELECT strftime(t_dat, '%Y-%m') AS year_month, count(*) AS num_rows, round(sum(price) + 1e-9, 4) AS revenue,
        count(DISTINCT t_dat) AS num_days FROM t WHERE t_dat BETWEEN DATE '1995-01-15' AND DATE '2001-07-20' GROUP BY 1"""
    ),
)
def partitioned_write(x: Inputs) -> DataFrame:
    path = scratch_path(x.spark, "by-month")
    files.write_by_month(with_date_features(x.t), path)
    return (
        files.read_by_month(x.spark, path, "1995-01-15", "2001-07-20")
        .groupBy("year_month")
        .agg(
            F.count(F.lit(1)).alias("num_rows"),
            r4(F.sum("price")).alias("revenue"),
            F.count_distinct("t_dat").alias("num_days"),
        )
    )


_KEYED = "t_dat, customer_id, article_id, sales_channel_id"


@query(
    "surrogate_key",
    sql(
        select=f"""SELECT *, md5(concat_ws('|', t_dat, customer_id, article_id, sales_channel_id)) || '-' ||
        row_number() OVER (PARTITION BY {_KEYED}) AS row_key FROM (SELECT {_KEYED} FROM t)"""
    ),
)
def surrogate_key(x: Inputs) -> DataFrame:
    """The ids themselves, of purchases without their price: several of them are equal."""
    columns = _KEYED.split(", ")
    rows = x.t.select(columns)
    return files.with_surrogate_key(rows, "row_key", F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))


@query(
    "submission_csv",
    sql(MODELS, select="SELECT customer_id, predicted_articles AS prediction FROM lists WHERE model_name = 'age_rules'"),
)
def submission_csv(x: Inputs) -> DataFrame:
    path = scratch_path(x.spark, "submission")
    files.write_submission(recommend.age_rules_predict(x.segments, models.segment_lists(x)), path)
    return x.spark.read.option("header", True).schema("customer_id string, prediction string").csv(path)


@query(
    "feature_table",
    sql(
        select="""SELECT c.customer_id, count(transaction_id) FILTER (t_dat >= DATE '2001-06-01') AS purchases_30d,
        count(transaction_id) AS purchases_lifetime, round(coalesce(sum(price), 0) + 1e-9, 4) AS total_spent_lifetime
        FROM customers c LEFT JOIN t ON t.customer_id = c.customer_id AND t_dat <= DATE '2001-07-01' GROUP BY 1"""
    ),
)
def feature_table(x: Inputs) -> DataFrame:
    wide = features.customer_windows(x.t_train, "2001-07-01")
    table = keyed.write_feature_table(wide, scratch_path(x.spark, "features"), ["customer_id"])
    columns = ["purchases_30d", "purchases_lifetime", "total_spent_lifetime"]
    found = keyed.lookup_features(x.customers.select("customer_id"), table, ["customer_id"])
    return rounded(features.zero_filled(found.select("customer_id", *columns), columns), "total_spent_lifetime")


def _store(x: Inputs) -> ServingStore:
    return ServingStore(x.spark, scratch_path(x.spark, "serving"))


def _fresh_schema() -> str:
    return f"retail_{uuid.uuid4().hex}"


@query(
    "serving_publish",
    sql(
        SALES,
        select="""SELECT s.article_id, product_group_name, num_transactions, total_revenue, unique_customers
        FROM sales s LEFT JOIN articles USING (article_id)""",
    ),
)
def serving_publish(x: Inputs) -> DataFrame:
    store, target = _store(x), f"shared.{_fresh_schema()}.product_sales_summary_synced"
    summary = gold.product_sales_summary(x.t, x.articles)
    store.publish(summary, target, ["article_id"])
    columns = ["article_id", "product_group_name", "num_transactions", "total_revenue", "unique_customers"]
    return rounded(store.read(target).select(*columns), "total_revenue")


def _publish_gold(x: Inputs) -> tuple[ServingStore, list[str], DataFrame]:
    store, schema = _store(x), _fresh_schema()
    # Order lines meet their orders once, for all tables.
    purchases = scratch_path(x.spark, "purchases")
    t = files.write_table(x.t, purchases)
    frames = {
        "product_sales_summary": gold.product_sales_summary(t, x.articles),
        "customer_demographics": gold.customer_demographics(x.customers, t),
        "time_series_sales": gold.time_series_daily(t),
    }
    keys = {"product_sales_summary": ["article_id"], "customer_demographics": ["customer_id"], "time_series_sales": ["date"]}
    configs = [ServingTable(n, f"shared.{schema}.{n}_synced", keys[n]) for n in frames]
    configs[1] = ServingTable("customer_demographics", configs[1].target, ["customer_id"], "TRIGGERED")
    # The channel is not a key of the purchases: this one has to fail without stopping the rest.
    configs.append(ServingTable(purchases, f"shared.{schema}.transactions_synced", ["sales_channel_id"]))
    report = store.publish_many(configs, frames)
    return store, [c.target for c in configs], report


_COUNTED = """
counted AS (
  SELECT 'product_sales_summary_synced' AS table_name, count(*) AS num_rows FROM sales
  UNION ALL SELECT 'customer_demographics_synced', count(*) FROM demographics
  UNION ALL SELECT 'time_series_sales_synced', count(*) FROM daily)
"""


@query(
    "serving_publish_many",
    sql(
        SALES,
        DEMOGRAPHICS,
        DAILY,
        _COUNTED,
        select="""SELECT table_name, true AS success, num_rows FROM counted
        UNION ALL SELECT 'transactions_synced', false, CAST(0 AS BIGINT)""",
    ),
)
def serving_publish_many(x: Inputs) -> DataFrame:
    store, targets, report = _publish_gold(x)
    rows = store.status(targets).select("target", F.coalesce("num_rows", F.lit(0)).alias("num_rows"))
    return report.join(rows, "target").select(
        F.substring_index("target", ".", -1).alias("table_name"), "success", "num_rows"
    )


@query(
    "serving_status",
    sql(
        SALES,
        DEMOGRAPHICS,
        DAILY,
        _COUNTED,
        select="""SELECT table_name, table_name <> 'time_series_sales_synced' AS present,
        CASE table_name WHEN 'product_sales_summary_synced' THEN 'SNAPSHOT' WHEN 'customer_demographics_synced' THEN 'TRIGGERED'
          ELSE '-' END AS policy,
        CASE WHEN table_name = 'time_series_sales_synced' THEN 0 ELSE num_rows END AS num_rows FROM counted
        UNION ALL SELECT 'transactions_synced', false, '-', 0""",
    ),
)
def serving_status(x: Inputs) -> DataFrame:
    store, targets, _ = _publish_gold(x)
    store.drop(targets[2])
    return store.status(targets).select(
        F.substring_index("target", ".", -1).alias("table_name"),
        F.col("exists").alias("present"),
        F.coalesce("policy", F.lit("-")).alias("policy"),
        F.coalesce("num_rows", F.lit(0).cast("long")).alias("num_rows"),
    )


@query(
    "ensure_namespace",
    sql(
        select="""SELECT 'shared.staging_retail.articles' AS table_name, count(*) AS num_rows FROM articles
        UNION ALL SELECT 'shared.staging_retail.customers', count(*) FROM customers"""
    ),
)
def ensure_namespace_query(x: Inputs) -> DataFrame:
    names = Namespace("shared", "retail", "staging")
    database = f"{names.qualified_schema}_{uuid.uuid4().hex}"
    ensure_namespace(x.spark, database, scratch_path(x.spark, "namespace"))
    ensure_namespace(x.spark, database)
    written = {}
    for name, df in {"articles": x.articles, "customers": x.customers}.items():
        written[names.table(name)] = files.write_table(df, f"{database}.{name}")
    return row_counts(written)


@query(
    "verify_tables",
    sql(
        select="""SELECT 'articles' AS table_name, count(*) AS num_rows FROM articles
        UNION ALL SELECT 'customers', count(*) FROM customers UNION ALL SELECT 'transactions', count(*) FROM t
        UNION ALL SELECT 'events', count(*) FROM events"""
    ),
)
def verify_tables_query(x: Inputs) -> DataFrame:
    return verify_tables(
        x.spark,
        {"articles": x.articles, "customers": x.customers, "transactions": x.t, "events": f"{x.sf_dir}/events.parquet"},
    )


@query(
    "incremental_publish",
    sql(
        select="""SELECT customer_id, t_dat, transaction_id, article_id, price FROM e
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY t_dat DESC, transaction_id DESC) = 1"""
    ),
)
def incremental_publish(x: Inputs) -> DataFrame:
    """Replays the purchase events as a stream of files, a few per micro-batch."""
    rows = x.e.select("customer_id", "t_dat", "transaction_id", "article_id", "price")
    source, target = scratch_path(x.spark, "stream-in"), scratch_path(x.spark, "stream-out")
    rows.repartitionByRange(8, "t_dat", "transaction_id").write.parquet(source)
    key, version = ["customer_id"], ["t_dat", "transaction_id"]
    stream = start_refresh(
        x.spark, source, target, scratch_path(x.spark, "stream-state"), rows.schema, key, version, files_per_batch=3
    )
    stream.awaitTermination()
    return refreshed(x.spark, target, rows.schema, key, version).select(*rows.columns)


def _window_summary(bounds: str) -> str:
    return f"""(SELECT customer_id, count(*) AS num_purchases, round(sum(price) + 1e-9, 4) AS total_spent FROM t
        WHERE t_dat BETWEEN {bounds} GROUP BY 1)"""


@query(
    "change_feed",
    sql(
        select=f"""SELECT customer_id, CASE WHEN a.num_purchases IS NULL THEN 'insert' WHEN b.num_purchases IS NULL THEN 'delete'
          ELSE 'update' END AS change, coalesce(b.num_purchases, a.num_purchases) AS num_purchases,
          coalesce(b.total_spent, a.total_spent) AS total_spent
        FROM {_window_summary("DATE '2001-01-01' AND DATE '2001-03-31'")} a
        FULL JOIN {_window_summary("DATE '2001-02-01' AND DATE '2001-04-30'")} b USING (customer_id)
        WHERE a.num_purchases IS DISTINCT FROM b.num_purchases OR a.total_spent IS DISTINCT FROM b.total_spent"""
    ),
)
def change_feed_query(x: Inputs) -> DataFrame:
    before, after = _window(x, "2001-01-01", "2001-03-31"), _window(x, "2001-02-01", "2001-04-30")
    return change_feed(before, after, ["customer_id"])


def _window(x: Inputs, first: str, last: str) -> DataFrame:
    rows = x.t.filter(F.col("t_dat").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return rows.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("num_purchases"), r4(F.sum("price")).alias("total_spent")
    )


_WINDOWS = [("2001-01-01", "2001-03-31"), ("2001-02-01", "2001-04-30"), ("2001-03-01", "2001-05-31"), ("2001-04-01", "2001-06-30")]


@query(
    "log_merge",
    sql(select=f"SELECT * FROM {_window_summary("DATE '2001-04-01' AND DATE '2001-06-30'")}"),
)
def log_merge(x: Inputs) -> DataFrame:
    """The last of four snapshots, rebuilt from the logs of changes between them, a batch each."""
    key, version = ["customer_id"], ["version"]
    snapshots = [materialize(_window(x, *w), "snapshot") for w in _WINDOWS]
    source, target, state = (scratch_path(x.spark, n) for n in ("log-in", "log-out", "log-state"))
    before = snapshots[0].limit(0)
    for number, after in enumerate(snapshots):
        log = as_log(change_feed(before, after, key), F.lit(number), "version")
        log.write.mode("append").parquet(source)
        # The new files, however many, are one batch.
        stream = start_refresh(x.spark, source, target, state, log.schema, key, version, compact_every=3, change="change")
        stream.awaitTermination()
        before = after
    return refreshed(x.spark, target, log.schema, key, version, "change").drop("version")


@query(
    "changes_between",
    sql(
        select=f"""SELECT customer_id, CASE WHEN a.num_purchases IS NULL THEN 'insert' WHEN b.num_purchases IS NULL THEN 'delete'
          ELSE 'update' END AS change, coalesce(b.num_purchases, a.num_purchases) AS num_purchases,
          coalesce(b.total_spent, a.total_spent) AS total_spent
        FROM {_window_summary("DATE '2001-01-01' AND DATE '2001-03-31'")} a
        FULL JOIN {_window_summary("DATE '2001-01-01' AND DATE '2001-04-01'")} b USING (customer_id)
        WHERE a.num_purchases IS DISTINCT FROM b.num_purchases OR a.total_spent IS DISTINCT FROM b.total_spent"""
    ),
)
def changes_between(x: Inputs) -> DataFrame:
    """Two written snapshots a day apart, compared by the digests of their key ranges."""
    paths = []
    for first, last in (("2001-01-01", "2001-03-31"), ("2001-01-01", "2001-04-01")):
        paths.append(scratch_path(x.spark, "digested"))
        snapshots.write_snapshot(materialize(_window(x, first, last), "window"), paths[-1], ["customer_id"])
    return snapshots.changes_between(x.spark, *paths, ["customer_id"])


@query(
    "clustered_purchases",
    sql(
        select="""SELECT 'customer' AS chosen, count(*) AS num_rows, CAST(sum(CAST(price AS DECIMAL(20, 4))) AS DOUBLE) AS revenue FROM t WHERE customer_id = 'Customer#000000007'
        UNION ALL SELECT 'article', count(*), CAST(sum(CAST(price AS DECIMAL(20, 4))) AS DOUBLE) FROM t WHERE article_id = 42
        UNION ALL SELECT 'week', count(*), CAST(sum(CAST(price AS DECIMAL(20, 4))) AS DOUBLE) FROM t WHERE t_dat BETWEEN DATE '2000-03-06' AND DATE '2000-03-12'
        UNION ALL SELECT 'all', count(*), CAST(sum(CAST(price AS DECIMAL(20, 4))) AS DOUBLE) FROM t"""
    ),
)
def clustered_purchases(x: Inputs) -> DataFrame:
    """Purchases of a customer, an article and a week from one clustered table; revenue as an exact sum."""
    path = scratch_path(x.spark, "clustered")
    clustered.write_clustered(x.t, path, files=8)
    chosen = {
        "customer": {"customer_id": "Customer#000000007"},
        "article": {"article_id": 42},
        "week": {"t_dat": (dt.date(2000, 3, 6), dt.date(2000, 3, 12))},
        "all": {},
    }
    parts = [
        clustered.read_clustered(x.spark, path, **wanted)
        .agg(F.count(F.lit(1)).alias("num_rows"), F.sum(F.col("price").cast("decimal(20,4)")).cast("double").alias("revenue"))
        .select(F.lit(name).alias("chosen"), "num_rows", "revenue")
        for name, wanted in chosen.items()
    ]
    return reduce(DataFrame.unionByName, parts)
