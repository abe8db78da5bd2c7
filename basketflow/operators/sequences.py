"""Purchase sequences and their encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.functions.lists import pad_left
from basketflow.operators.ordering import with_row_index
from basketflow.operators.skew import lookup_join

PADDING = 0


def customer_sequences(transactions: DataFrame, max_length: int = 10, min_length: int = 2) -> DataFrame:
    """Each customer's last ``max_length`` articles in purchase order, and the full history length.

    The rank limit is applied before the shuffle, so a customer of any activity sends at most
    ``max_length`` rows per task; the length is a separate map-side combined count.
    """
    latest = Window.partitionBy("customer_id").orderBy(F.col("t_dat").desc(), F.col("transaction_id").desc())
    kept = (
        transactions.select("customer_id", "t_dat", "transaction_id", "article_id")
        .withColumn("back", F.row_number().over(latest))
        .filter(F.col("back") <= max_length)
    )
    oldest_first = F.array_sort(F.collect_list(F.struct((-F.col("back")).alias("o"), "article_id")))
    sequences = kept.groupBy("customer_id").agg(F.transform(oldest_first, lambda s: s["article_id"]).alias("sequence"))
    lengths = (
        transactions.groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("sequence_length"))
        .filter(F.col("sequence_length") >= min_length)
    )
    return sequences.join(lengths, "customer_id")


def training_sequences(
    transactions: DataFrame, input_length: int = 10, target_length: int = 1, literal: bool = False
) -> DataFrame:
    """Histories of at least ``input_length + target_length`` purchases as (input, target).

    Keeps the last ``input_length + target_length`` articles and cuts them. ``literal`` keeps only
    the last ``input_length``, which leaves every target empty.
    """
    wanted = input_length + target_length
    sequences = customer_sequences(transactions, input_length if literal else wanted)
    return sequences.filter(F.col("sequence_length") >= wanted).select(
        "customer_id",
        F.slice("sequence", 1, input_length).alias("input_sequence"),
        F.slice("sequence", input_length + 1, target_length).alias("target_articles"),
    )


def article_vocabulary(articles: DataFrame) -> DataFrame:
    """Distinct article ids in ascending order, numbered from 1; 0 is padding and unknown."""
    ids = articles.select("article_id").filter("article_id is not null").distinct()
    return with_row_index(ids, [F.col("article_id")], "article_index")


def encode(df: DataFrame, vocabulary: DataFrame, spread: list[str], max_bytes: int | None = None) -> DataFrame:
    joined = lookup_join(df, vocabulary, "article_id", "left", spread=spread, max_bytes=max_bytes)
    return joined.withColumn("article_index", F.coalesce("article_index", F.lit(PADDING).cast("long")))


def decode(df: DataFrame, vocabulary: DataFrame, spread: list[str], max_bytes: int | None = None) -> DataFrame:
    """Article ids of indexes; null for padding and unknown indexes."""
    return lookup_join(df, vocabulary, "article_index", "left", spread=spread, max_bytes=max_bytes)


def pad_encode_sequences(
    sequences: DataFrame, vocabulary: DataFrame, length: int = 10, column: str = "sequence", max_bytes: int | None = None
) -> DataFrame:
    """Last ``length`` articles as vocabulary indexes, padded with 0 on the left."""
    trimmed = F.when(F.size(column) > length, F.slice(column, -length, length)).otherwise(F.col(column))
    items = sequences.select("customer_id", F.posexplode(trimmed).alias("at", "article_id"))
    coded = encode(items, vocabulary, ["customer_id", "at"], max_bytes)
    in_order = F.array_sort(F.collect_list(F.struct("at", "article_index")))
    return (
        coded.groupBy("customer_id")
        .agg(F.transform(in_order, lambda s: s["article_index"]).alias("coded"))
        .select("customer_id", pad_left(F.col("coded"), length, PADDING).alias("encoded"))
    )


def article_attribute_lookup(articles: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Vocabulary index → attribute record."""
    columns = ["article_id", "product_type_no", "product_group_name", "colour_group_code", "section_no", "garment_group_no"]
    return articles.join(vocabulary, "article_id").select("article_index", F.struct(*columns).alias("attributes"))
