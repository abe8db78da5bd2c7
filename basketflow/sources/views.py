"""The retail tables as views over the driver's test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.functions.text import zero_fill

# Fixed values of the fixture: p_partkey % 6 and c_custkey % 5 / % 4 pick from these; None is null.
PRODUCT_GROUPS = ["Garment Upper body", "Garment Lower body", "Shoes", "Accessories", "Underwear", None]
CLUB_STATUS = [None, "PRE-CREATE", "LEFT CLUB", "ACTIVE", "ACTIVE"]
NEWS_FREQUENCY = ["NONE", "Regularly", "Monthly", None]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str | None], index: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[index.cast("int")]


def customer_key(number: Column) -> Column:
    return F.concat(F.lit("Customer#"), zero_fill(number, 9))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select(
        key.alias("article_id"),
        F.expr("p_partkey div 10").alias("product_code"),
        F.col("p_name").alias("prod_name"),
        size.alias("product_type_no"),
        F.col("p_type").alias("product_type_name"),
        _pick(PRODUCT_GROUPS, key % 6).alias("product_group_name"),
        F.when(size % 7 != 0, size).alias("colour_group_code"),
        F.substring_index("p_name", " ", 1).alias("colour_group_name"),
        F.col("p_brand").alias("department_name"),
        F.col("p_type").alias("index_group_name"),
        (size % 5).alias("section_no"),
        F.concat(F.lit("Section "), (size % 5).cast("string")).alias("section_name"),
        F.when(key % 11 != 0, (1000 * (key % 4 + 1) + size).cast("int")).alias("garment_group_no"),
        F.concat(F.lit("Group "), (key % 4).cast("string")).alias("garment_group_name"),
        F.when(key % 13 != 0, F.concat_ws(" ", "p_name", "p_type")).alias("detail_desc"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("customer_id"),
        F.when(key % 37 != 0, (14 + key % 60).cast("int")).alias("age"),
        F.when(key % 3 == 1, 1.0).when(key % 3 == 2, 0.0).alias("FN"),
        F.when(key % 4 == 0, 1.0).alias("Active"),
        _pick(CLUB_STATUS, key % 5).alias("club_member_status"),
        _pick(NEWS_FREQUENCY, key % 4).alias("fashion_news_frequency"),
    )


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture T: one purchase per order line, dated by its order."""
    lines = table(spark, sf_dir, "lineitem")
    # What depends on the order alone is computed once per order, before the join.
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("t_dat"),
        customer_key(F.col("o_custkey")).alias("customer_id"),
    )
    parts = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "t_dat",
        "customer_id",
        F.col("l_partkey").alias("article_id"),
        F.col("l_extendedprice").alias("price"),
        (1 + F.col("l_suppkey") % 2).cast("int").alias("sales_channel_id"),
        F.concat_ws("-", *parts, F.col("l_shipdate").cast("date").cast("string")).alias("transaction_id"),
    )


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture E: the purchases among the events."""
    events = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return events.select(
        F.col("ts").cast("date").alias("t_dat"),
        customer_key(F.col("user_id")).alias("customer_id"),
        F.get_json_object("props", "$.k").cast("long").alias("article_id"),
        F.col("value").alias("price"),
        (1 + F.col("event_id") % 2).cast("int").alias("sales_channel_id"),
        F.col("event_id").alias("transaction_id"),
    )
