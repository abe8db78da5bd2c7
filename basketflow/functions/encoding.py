"""Numeric encodings that feed the purchase classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Codes of the four named product groups; any other group is 0.
PRODUCT_GROUP_CODES = {
    "Garment Upper body": 1,
    "Garment Lower body": 2,
    "Shoes": 3,
    "Accessories": 4,
}
# The model's inputs in order.
FEATURES = [
    "age",
    "is_subscribed",
    "is_active",
    "is_club_member",
    "product_type",
    "product_group_encoded",
    "garment_group",
    "colour_code",
]


def encode_customers(customers: DataFrame) -> DataFrame:
    """A missing ``FN`` counts as subscribed: only an explicit 0 does not."""
    return customers.select(
        "customer_id",
        F.coalesce("age", F.lit(0)).alias("age"),
        F.when(F.col("FN") == 0, 0).otherwise(1).alias("is_subscribed"),
        F.coalesce("Active", F.lit(0.0)).alias("is_active"),
        F.when(F.col("club_member_status") == "ACTIVE", 1).otherwise(0).alias("is_club_member"),
    )


def encode_articles(articles: DataFrame) -> DataFrame:
    group = F.lit(0)
    for name, code in PRODUCT_GROUP_CODES.items():
        group = F.when(F.col("product_group_name") == name, code).otherwise(group)
    return articles.select(
        "article_id",
        F.coalesce("product_type_no", F.lit(0)).alias("product_type"),
        group.alias("product_group_encoded"),
        F.coalesce((F.col("garment_group_no") / 1000).cast("int"), F.lit(0)).alias("garment_group"),
        F.coalesce("colour_group_code", F.lit(0)).alias("colour_code"),
    )
