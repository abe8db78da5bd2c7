"""The dashboard's queries over the summary tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.functions.text import image_path, parse_id_list
from basketflow.operators.filters import (
    ALL,
    SHALLOW,
    between_dates,
    contains_text,
    equals_unless_all,
    page_counts,
    page_of,
    rows_with_ids,
)
from basketflow.operators.gold import period_sales
from basketflow.operators.skew import lookup_join

Day = dt.date | str | None


def bestsellers(
    articles: DataFrame,
    sales: DataFrame,
    start: Day = None,
    end: Day = None,
    category: str = ALL,
    limit: int = 20,
) -> DataFrame:
    """Articles by number of purchases; the dates bound an article's last purchase."""
    if not 1 <= limit <= 100:
        raise ValueError("limit must be between 1 and 100")
    listed = articles.filter(equals_unless_all({"product_group_name": category}))
    sold = between_dates(sales, "last_purchase_date", start, end)
    return (
        listed.select(
            "article_id", "prod_name", "product_type_name", "product_group_name", "colour_group_name", "department_name"
        )
        .join(
            sold.select("article_id", "num_transactions", "total_revenue", "unique_customers", "avg_price"), "article_id"
        )
        .orderBy(F.col("num_transactions").desc(), "article_id")
        .limit(limit)
    )


def demographics_by(demographics: DataFrame, column: str, with_purchases: bool = False) -> DataFrame:
    """Customers, mean spend (and mean purchases) per value of ``column``, nulls left out."""
    measures = [F.count(F.lit(1)).alias("num_customers"), F.avg("total_spent").alias("avg_spent")]
    if with_purchases:
        measures.append(F.avg("num_purchases").alias("avg_purchases"))
    return demographics.filter(F.col(column).isNotNull()).groupBy(column).agg(*measures).orderBy(column)


def period_of(granularity: str) -> Column:
    if granularity == "daily":
        return F.col("date")
    # The ISO week starts on Monday, so the days around New Year stay in one week.
    return F.trunc("date", {"weekly": "week", "monthly": "month"}[granularity])


def time_series_rollup(daily: DataFrame, granularity: str = "daily", start: Day = None, end: Day = None) -> DataFrame:
    """Daily rows summed per day, week or month.

    The distinct counts are sums of daily ones (a customer counts once per day), the mean value is
    the plain mean of the daily means; ``time_series_exact`` has the exact figures.
    """
    return (
        between_dates(daily, "date", start, end)
        .groupBy(period_of(granularity).alias("period"))
        .agg(
            F.min("date").alias("date"),
            F.sum("num_transactions").alias("num_transactions"),
            F.sum("total_revenue").alias("total_revenue"),
            F.sum("unique_customers").alias("unique_customers_sum"),
            F.sum("unique_products").alias("unique_products_sum"),
            F.avg("avg_transaction_value").alias("avg_transaction_value"),
        )
        .drop("period")
        .orderBy("date")
    )


def time_series_exact(
    transactions: DataFrame, granularity: str = "daily", start: Day = None, end: Day = None
) -> DataFrame:
    """The same periods from the purchases, with exact distinct counts and mean."""
    dated = between_dates(transactions, "t_dat", start, end).withColumn("date", F.col("t_dat"))
    periods = period_sales(dated.withColumn("period", period_of(granularity)), "period")
    return periods.drop("period").withColumnRenamed("first_date", "date").orderBy("date")


def product_explorer(
    articles: DataFrame,
    sales: DataFrame,
    search: str = "",
    category: str = ALL,
    colour: str = ALL,
    department: str = ALL,
    page: int = 1,
    page_size: int = 24,
) -> tuple[DataFrame, DataFrame]:
    """One page of articles with their sales (0 if unsold), and the total counts.

    The counts need the articles only: sales are unique per article and joined from the left.
    """
    listed = articles.filter(
        contains_text(search, "prod_name", "detail_desc")
        & equals_unless_all(
            {"product_group_name": category, "colour_group_name": colour, "department_name": department}
        )
    )
    rows = listed.join(
        sales.select("article_id", "num_transactions", "total_revenue", "unique_customers"), "article_id", "left"
    ).select(
        "article_id",
        "prod_name",
        "product_type_name",
        "product_group_name",
        "colour_group_name",
        "department_name",
        "detail_desc",
        F.coalesce("num_transactions", F.lit(0).cast("long")).alias("num_transactions"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
        F.coalesce("unique_customers", F.lit(0).cast("long")).alias("unique_customers"),
    )
    order = [(F.col("num_transactions"), True), (F.col("article_id"), False)]
    return page_of(rows, order, page, page_size, shallow=SHALLOW), page_counts(listed, page_size)


def transactions_with_articles(transactions: DataFrame, articles: DataFrame, max_bytes: int | None = None) -> DataFrame:
    names = articles.select("article_id", "prod_name", "product_group_name", "colour_group_name", "department_name")
    return lookup_join(transactions, names, "article_id", spread=["transaction_id"], max_bytes=max_bytes)


def transaction_lookup(
    transactions: DataFrame,
    articles: DataFrame,
    customer: str = "",
    category: str = ALL,
    department: str = ALL,
    start: Day = None,
    end: Day = None,
    page: int = 1,
    page_size: int = 20,
    known_articles: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Purchases with article names, newest first, one page and the total counts.

    Every predicate is applied to its own table, before the join. ``known_articles`` says that each
    purchase's article is listed: then the counts need no join unless articles are chosen.
    """
    bought = between_dates(transactions.filter(contains_text(customer, "customer_id")), "t_dat", start, end)
    listed = articles.filter(equals_unless_all({"product_group_name": category, "department_name": department}))
    rows = transactions_with_articles(bought, listed).select(
        "t_dat",
        "customer_id",
        "article_id",
        "price",
        "sales_channel_id",
        "prod_name",
        "product_group_name",
        "colour_group_name",
        "department_name",
        "transaction_id",
    )
    order = [(F.col("t_dat"), True), (F.col("transaction_id"), False)]
    # Whether a purchase is listed needs the ids of the chosen articles only, or no join at all.
    restricted = any(choice not in (None, ALL) for choice in (category, department))
    counted = rows_with_ids(bought, listed, "article_id") if restricted or not known_articles else bought
    # Day and id of a listed purchase are known without its article's names.
    return page_of(rows, order, page, page_size, counted, SHALLOW), page_counts(counted, page_size)


def customer_list(
    demographics: DataFrame, search: str = "", page: int = 1, page_size: int = 20
) -> tuple[DataFrame, DataFrame]:
    rows = demographics.filter(contains_text(search, "customer_id")).select(
        "customer_id", "age_bin", "club_member_status", "fashion_news_frequency", "total_spent", "num_purchases"
    )
    order = [(F.round("total_spent", 4), True), (F.col("customer_id"), False)]
    return page_of(rows, order, page, page_size, shallow=SHALLOW), page_counts(rows, page_size)


def filter_options(articles: DataFrame) -> DataFrame:
    """Choices of the three filters: ``ALL`` first, then the distinct values in order; one scan."""
    columns = {"category": "product_group_name", "color": "colour_group_name", "department": "department_name"}
    pairs = F.array(*[F.struct(F.lit(n).alias("filter"), F.col(c).alias("value")) for n, c in columns.items()])
    values = (
        articles.select(F.explode(pairs).alias("p"))
        .select("p.filter", F.lit(1).alias("position"), "p.value")
        .filter("value is not null")
        .distinct()
    )
    names = F.explode(F.array(*[F.lit(n) for n in columns]))
    first = articles.sparkSession.range(1).select(names.alias("filter"), F.lit(0).alias("position"), F.lit(ALL).alias("value"))
    return first.unionByName(values).orderBy("filter", "position", "value")


def prediction_enrichment(
    predictions: DataFrame,
    articles: DataFrame,
    customer_id: str | None = None,
    image_root: str = "/volume",
    top_n: int = 12,
    max_bytes: int | None = None,
) -> DataFrame:
    """Predictions written as text, one row per recommended article with its details, newest first.

    Ids that are no article keep their place as "Unknown Item". Works for one customer or for all
    (then unsorted): every list of a popularity model names the same few articles, which the lookup
    join spreads.
    """
    chosen = predictions if customer_id is None else predictions.filter(F.col("customer_id") == customer_id)
    items = chosen.select(
        "customer_id",
        "model_name",
        "model_version",
        "model_alias",
        "prediction_timestamp",
        "batch_id",
        F.posexplode(parse_id_list(F.col("predicted_articles"), top_n)).alias("position", "article_id"),
    )
    details = articles.select(
        F.col("article_id").cast("string").alias("article_id"), "prod_name", "product_group_name", "detail_desc"
    ).withColumn("known", F.lit(True))
    number = F.when(F.col("article_id").rlike("^[0-9]+$"), F.col("article_id")).otherwise("0")
    missing = F.col("known").isNull()
    unknown = F.concat(F.lit("Unknown Item ("), "article_id", F.lit(")"))
    out = lookup_join(
        items, details, "article_id", "left", spread=["customer_id", "model_name", "position"], max_bytes=max_bytes
    ).select(
        "customer_id",
        "model_name",
        "model_version",
        "model_alias",
        "prediction_timestamp",
        "batch_id",
        "position",
        "article_id",
        F.when(missing, unknown).otherwise(F.col("prod_name")).alias("name"),
        F.when(missing, "Unknown").otherwise(F.col("product_group_name")).alias("category"),
        F.when(missing, "").otherwise(F.col("detail_desc")).alias("description"),
        image_path(number, image_root).alias("image_path"),
    )
    if customer_id is None:
        return out
    return out.orderBy(F.col("prediction_timestamp").desc(), "model_name", "position")
