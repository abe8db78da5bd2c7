"""Summary tables per article, customer, day and category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.functions.bands import UNKNOWN, age_bin
from basketflow.operators.skew import lookup_join

# Article columns of the published summary.
ARTICLE_COLUMNS = [
    "product_code",
    "prod_name",
    "product_type_name",
    "product_group_name",
    "colour_group_name",
    "department_name",
    "index_group_name",
    "section_name",
    "garment_group_name",
]


def ratio(total: Column, n: Column) -> Column:
    return F.when(n > 0, total / n)


def article_sales(transactions: DataFrame) -> DataFrame:
    """Per article: purchases, revenue, distinct customers, mean price, last purchase.

    Counts (article, customer) pairs first: a best-seller is spread over its customers, and the
    distinct count becomes a plain count.
    """
    pairs = transactions.groupBy("article_id", "customer_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("price").alias("revenue"),
        F.count("price").alias("priced"),
        F.max("t_dat").alias("last"),
    )
    return (
        pairs.groupBy("article_id")
        .agg(
            F.sum("n").alias("num_transactions"),
            F.sum("revenue").alias("total_revenue"),
            F.count("customer_id").alias("unique_customers"),
            F.sum("priced").alias("priced"),
            F.max("last").alias("last_purchase_date"),
        )
        .withColumn("avg_price", ratio(F.col("total_revenue"), F.col("priced")))
        .drop("priced")
    )


def product_sales_summary(transactions: DataFrame, articles: DataFrame) -> DataFrame:
    sales = article_sales(transactions)
    return sales.join(articles.select("article_id", *ARTICLE_COLUMNS), "article_id", "left").select(
        "article_id",
        *ARTICLE_COLUMNS,
        "num_transactions",
        "total_revenue",
        "unique_customers",
        "avg_price",
        "last_purchase_date",
    )


def customer_purchases(transactions: DataFrame) -> DataFrame:
    pairs = transactions.groupBy("customer_id", "article_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("price").alias("spent"),
        F.max("t_dat").alias("last"),
        F.min("t_dat").alias("first"),
    )
    return pairs.groupBy("customer_id").agg(
        F.sum("n").alias("num_purchases"),
        F.sum("spent").alias("total_spent"),
        F.count("article_id").alias("unique_items"),
        F.max("last").alias("last_purchase_date"),
        F.min("first").alias("first_purchase_date"),
    )


def customer_demographics(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Customers without purchases keep zero counts and null dates."""
    return (
        customers.withColumn("age_bin", age_bin(F.col("age")))
        .join(customer_purchases(transactions), "customer_id", "left")
        .select(
            "customer_id",
            "age",
            "age_bin",
            "club_member_status",
            "fashion_news_frequency",
            "Active",
            "num_purchases",
            "total_spent",
            "unique_items",
            "last_purchase_date",
            "first_purchase_date",
        )
        .fillna(0, subset=["num_purchases", "total_spent", "unique_items"])
    )


def distinct_per(df: DataFrame, period: str, value: str, name: str) -> DataFrame:
    """Exact number of distinct values per period; a hot period is spread over its values."""
    return df.select(period, value).distinct().groupBy(period).agg(F.count(value).alias(name))


def period_sales(dated: DataFrame, period: str) -> DataFrame:
    """Purchases, revenue, distinct customers, distinct articles and mean price per period.

    One pass per distinct count, each over the columns it needs: two distinct counts in one
    aggregate would triple every row first.
    """
    sales = (
        dated.groupBy(period, "customer_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("price").alias("revenue"),
            F.count("price").alias("priced"),
            F.min("t_dat").alias("first"),
        )
        .groupBy(period)
        .agg(
            F.min("first").alias("first_date"),
            F.sum("n").alias("num_transactions"),
            F.sum("revenue").alias("total_revenue"),
            F.count("customer_id").alias("unique_customers"),
            ratio(F.sum("revenue"), F.sum("priced")).alias("avg_transaction_value"),
        )
    )
    products = distinct_per(dated, period, "article_id", "unique_products").withColumnRenamed(period, "_period")
    return sales.join(products, F.col(period).eqNullSafe(F.col("_period"))).drop("_period")


def time_series_daily(transactions: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per day. ``approximate`` swaps the two distinct counts for mergeable sketches."""
    dated = transactions.withColumn("date", F.col("t_dat"))
    if approximate:
        daily = dated.groupBy("date").agg(
            F.count(F.lit(1)).alias("num_transactions"),
            F.sum("price").alias("total_revenue"),
            F.approx_count_distinct("customer_id").alias("unique_customers"),
            F.approx_count_distinct("article_id").alias("unique_products"),
            F.avg("price").alias("avg_transaction_value"),
        )
    else:
        daily = period_sales(dated, "date")
    return daily.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "yyyy-MM").alias("year_month"),
        "num_transactions",
        "total_revenue",
        "unique_customers",
        "unique_products",
        "avg_transaction_value",
    ).orderBy("date")


def category_insights(transactions: DataFrame, articles: DataFrame) -> DataFrame:
    """The sales measures per (product group, product type); a missing name counts as "Unknown".

    Purchases shrink to (article, customer) pairs before they meet the articles.
    """
    pairs = transactions.groupBy("article_id", "customer_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("price").alias("revenue"),
        F.count("price").alias("priced"),
        F.max("t_dat").alias("last"),
    )
    categories = articles.select(
        "article_id",
        F.coalesce("product_group_name", F.lit(UNKNOWN)).alias("product_group_name"),
        F.coalesce("product_type_name", F.lit(UNKNOWN)).alias("product_type_name"),
    )
    named = lookup_join(pairs, categories, "article_id", spread=["customer_id"], hot_from=transactions)
    per_customer = named.groupBy("product_group_name", "product_type_name", "customer_id").agg(
        F.sum("n").alias("n"),
        F.sum("revenue").alias("revenue"),
        F.sum("priced").alias("priced"),
        F.max("last").alias("last"),
    )
    return per_customer.groupBy("product_group_name", "product_type_name").agg(
        F.sum("n").alias("num_transactions"),
        F.sum("revenue").alias("total_revenue"),
        F.count("customer_id").alias("unique_customers"),
        ratio(F.sum("revenue"), F.sum("priced")).alias("avg_price"),
        F.max("last").alias("last_purchase_date"),
    )
