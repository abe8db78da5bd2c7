"""Windowed customer and article features, recency-frequency-monetary scores, category preferences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.functions.bands import age_group
from basketflow.functions.dates import as_date, days_before
from basketflow.operators.gold import ratio
from basketflow.operators.ordering import with_ntiles
from basketflow.operators.skew import lookup_join
from basketflow.session import materialize

# Windows and columns of the published feature tables.
WINDOWS = (7, 30)
CUSTOMER_FEATURES = [
    "customer_id",
    "age",
    "age_group",
    "purchases_7d",
    "total_spent_7d",
    "unique_items_7d",
    "avg_price_7d",
    "purchases_30d",
    "total_spent_30d",
    "unique_items_30d",
    "avg_price_30d",
    "purchases_lifetime",
    "total_spent_lifetime",
    "unique_items_lifetime",
    "days_since_last_purchase",
    "customer_tenure_days",
    "purchase_frequency_30d",
    "recency_days",
    "frequency",
    "monetary_value",
    "recency_score",
    "frequency_score",
    "monetary_score",
    "rfm_score",
]
ARTICLE_FEATURES = [
    "article_id",
    "product_type_name",
    "product_group_name",
    "colour_group_name",
    "department_name",
    "index_group_name",
    "section_name",
    "popularity_7d",
    "unique_customers_7d",
    "avg_price_7d",
    "popularity_30d",
    "unique_customers_30d",
    "avg_price_30d",
    "popularity_lifetime",
    "unique_customers_lifetime",
    "days_since_last_sale",
    "popularity_trend",
]


def pair_windows(
    transactions: DataFrame, reference: dt.date | str, windows: tuple[int, ...] = WINDOWS
) -> DataFrame:
    """Per (customer, article): counts and sums of every window, in one scan.

    Both hot customers and hot articles are spread over their partners here; the next level only
    adds up numbers, and "distinct" becomes "pairs with a count".
    """
    ago = days_before(reference, F.col("t_dat"))
    per_window = []
    for w in windows:
        inside = ago <= w
        per_window += [
            F.count(F.when(inside, 1)).alias(f"n_{w}"),
            F.sum(F.when(inside, F.col("price"))).alias(f"sum_{w}"),
            F.count(F.when(inside, F.col("price"))).alias(f"priced_{w}"),
        ]
    return transactions.groupBy("customer_id", "article_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("price").alias("sum"),
        F.min("t_dat").alias("first"),
        F.max("t_dat").alias("last"),
        *per_window,
    )


def customer_windows(
    transactions: DataFrame, reference: dt.date | str, windows: tuple[int, ...] = WINDOWS, paired: bool = False
) -> DataFrame:
    """Counts, spend, distinct items and mean price per customer for each window and for all time.

    As in ``days_ago <= n``, rows after the reference date fall into every window; filter first.
    ``paired`` tells that ``transactions`` already is the outcome of ``pair_windows``.
    """
    aggs: list[Column] = []
    for w in windows:
        aggs += [
            F.sum(f"n_{w}").alias(f"purchases_{w}d"),
            F.sum(f"sum_{w}").alias(f"total_spent_{w}d"),
            F.count(F.when((F.col(f"n_{w}") > 0) & F.col("article_id").isNotNull(), 1)).alias(f"unique_items_{w}d"),
            ratio(F.sum(f"sum_{w}"), F.sum(f"priced_{w}")).alias(f"avg_price_{w}d"),
        ]
    pairs = transactions if paired else pair_windows(transactions, reference, windows)
    return pairs.groupBy("customer_id").agg(
        *aggs,
        F.sum("n").alias("purchases_lifetime"),
        F.sum("sum").alias("total_spent_lifetime"),
        F.count("article_id").alias("unique_items_lifetime"),
        F.min("first").alias("first_purchase_date"),
        F.max("last").alias("last_purchase_date"),
    )


def article_windows(
    transactions: DataFrame, reference: dt.date | str, windows: tuple[int, ...] = WINDOWS, paired: bool = False
) -> DataFrame:
    aggs: list[Column] = []
    for w in windows:
        aggs += [
            F.sum(f"n_{w}").alias(f"popularity_{w}d"),
            F.count(F.when((F.col(f"n_{w}") > 0) & F.col("customer_id").isNotNull(), 1)).alias(f"unique_customers_{w}d"),
            ratio(F.sum(f"sum_{w}"), F.sum(f"priced_{w}")).alias(f"avg_price_{w}d"),
        ]
    pairs = transactions if paired else pair_windows(transactions, reference, windows)
    return pairs.groupBy("article_id").agg(
        *aggs,
        F.sum("n").alias("popularity_lifetime"),
        F.count("customer_id").alias("unique_customers_lifetime"),
        F.min("first").alias("first_sale_date"),
        F.max("last").alias("last_sale_date"),
    )


def zero_filled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null becomes 0 on the named columns that exist."""
    return df.fillna({c: 0 for c in columns if c in df.columns})


def _numeric(prefixes: list[str], windows: tuple[int, ...]) -> list[str]:
    return [f"{p}_{w}d" for w in windows for p in prefixes]


def _complete_customers(customers: DataFrame, measured: DataFrame, reference: dt.date | str) -> DataFrame:
    joined = customers.join(measured, "customer_id", "left").withColumns(
        {
            "days_since_last_purchase": days_before(reference, F.col("last_purchase_date")),
            "customer_tenure_days": days_before(reference, F.col("first_purchase_date")),
        }
    )
    numeric = _numeric(["purchases", "total_spent", "unique_items", "avg_price"], WINDOWS) + [
        "purchases_lifetime",
        "total_spent_lifetime",
        "unique_items_lifetime",
        "days_since_last_purchase",
        "customer_tenure_days",
    ]
    return zero_filled(joined, numeric).withColumn(
        "purchase_frequency_30d",
        F.when(F.col("customer_tenure_days") > 0, F.col("purchases_30d") / 30.0).otherwise(0.0),
    )


def customer_features(transactions: DataFrame, customers: DataFrame, reference: dt.date | str) -> DataFrame:
    """Every customer with windowed purchase features; without purchases all numbers are 0."""
    return _complete_customers(customers, customer_windows(transactions, reference), reference)


def article_features(
    transactions: DataFrame, articles: DataFrame, reference: dt.date | str, paired: bool = False
) -> DataFrame:
    measured = article_windows(transactions, reference, paired=paired)
    joined = articles.join(measured, "article_id", "left").withColumn(
        "days_since_last_sale", days_before(reference, F.col("last_sale_date"))
    )
    numeric = _numeric(["popularity", "unique_customers", "avg_price"], WINDOWS) + [
        "popularity_lifetime",
        "unique_customers_lifetime",
        "days_since_last_sale",
    ]
    trend = ratio(F.col("popularity_7d"), F.col("popularity_30d"))
    return zero_filled(joined, numeric).withColumn("popularity_trend", F.coalesce(trend, F.lit(0.0)))


def article_feature_set(
    transactions: DataFrame, articles: DataFrame, reference: dt.date | str, paired: bool = False
) -> DataFrame:
    return article_features(transactions, articles, reference, paired).select(*ARTICLE_FEATURES)


def rfm_base(transactions: DataFrame, reference: dt.date | str) -> DataFrame:
    return transactions.groupBy("customer_id").agg(
        F.datediff(as_date(reference), F.max("t_dat")).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("price").alias("monetary_value"),
    )


def with_rfm_scores(base: DataFrame, buckets: int = 5) -> DataFrame:
    """Quintiles over all customers, 1 = best; ties go to the smaller customer_id.

    Spend is compared at four decimals, so that the order of a floating sum cannot decide a rank.
    """
    tie = (F.col("customer_id"), False)
    scored = with_ntiles(
        base,
        buckets,
        {
            "recency_score": [(F.col("recency_days"), False), tie],
            "frequency_score": [(F.col("frequency"), True), tie],
            "monetary_score": [(F.round("monetary_value", 4), True), tie],
        },
    )
    return scored.withColumn("rfm_score", F.concat("recency_score", "frequency_score", "monetary_score"))


def rfm_scores(transactions: DataFrame, reference: dt.date | str, buckets: int = 5) -> DataFrame:
    return with_rfm_scores(rfm_base(transactions, reference), buckets)


def customer_feature_set(
    transactions: DataFrame, customers: DataFrame, reference: dt.date | str, paired: bool = False
) -> DataFrame:
    """Windowed features, age group and RFM scores of every customer.

    Purchases are read once: the scores rank columns of the already aggregated features.
    """
    measured = materialize(customer_windows(transactions, reference, paired=paired), "customer-windows")
    base = measured.select(
        "customer_id",
        days_before(reference, F.col("last_purchase_date")).alias("recency_days"),
        F.col("purchases_lifetime").alias("frequency"),
        F.col("total_spent_lifetime").alias("monetary_value"),
    )
    features = _complete_customers(customers, measured, reference)
    return (
        features.withColumn("age_group", age_group(F.col("age")))
        .join(with_rfm_scores(base), "customer_id", "left")
        .select(*CUSTOMER_FEATURES)
    )


def top_categories(transactions: DataFrame, articles: DataFrame, top_n: int = 3) -> DataFrame:
    """Product groups each customer buys most; purchases shrink to pairs before the join."""
    pairs = transactions.groupBy("customer_id", "article_id").agg(F.count(F.lit(1)).alias("n"))
    groups = articles.select("article_id", "product_group_name")
    counts = (
        lookup_join(pairs, groups, "article_id", "left", spread=["customer_id"], hot_from=transactions)
        .groupBy("customer_id", "product_group_name")
        .agg(F.sum("n").alias("category_purchases"))
    )
    order = Window.partitionBy("customer_id").orderBy(
        F.col("category_purchases").desc(), F.col("product_group_name").asc_nulls_last()
    )
    return (
        counts.withColumn("category_rank", F.row_number().over(order))
        .filter(F.col("category_rank") <= top_n)
        .select("customer_id", "product_group_name", "category_purchases", "category_rank")
    )
