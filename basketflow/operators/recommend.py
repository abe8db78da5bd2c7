"""Recommenders. Models are ranked lists kept as rows; arrays appear at the edge."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.config import DECAY, RECENT_DAYS, TOP_K, BlendWeights
from basketflow.functions import lists
from basketflow.functions.dates import PURCHASE_DAY, as_date, days_before
from basketflow.operators.filters import between_dates, known_segment
from basketflow.operators.skew import HOT_ROWS, lookup_join, with_pieces

Reference = dt.date | str | None


def _reference(transactions: DataFrame, reference: Reference) -> Column:
    """The given date, or the last purchase date as a scalar subquery."""
    if reference is not None:
        return as_date(reference)
    return transactions.agg(F.max("t_dat").alias("d")).scalar()


def recent(transactions: DataFrame, reference: Reference, n_days: int, open_end: bool = False) -> DataFrame:
    """Purchases from ``n_days`` before the reference date up to it; ``open_end`` keeps later ones too."""
    ref = _reference(transactions, reference)
    until = None if open_end or reference is None else ref
    return between_dates(transactions, PURCHASE_DAY, F.date_sub(ref, n_days), until)


def popular_items(
    transactions: DataFrame, n_days: int = RECENT_DAYS, reference: Reference = None, top_n: int = TOP_K
) -> DataFrame:
    return (
        recent(transactions, reference, n_days)
        .groupBy("article_id")
        .agg(F.count(F.lit(1)).alias("purchase_count"))
        .orderBy(F.col("purchase_count").desc(), "article_id")
        .limit(top_n)
    )


def segment_rows(df: DataFrame, customers: DataFrame, column: str, value: str, max_bytes: int | None = None) -> DataFrame:
    """Rows of the customers whose ``column`` is ``value``."""
    members = customers.filter(F.col(column) == value).select("customer_id")
    spread = [c for c in ("article_id", "transaction_id") if c in df.columns]
    return lookup_join(df, members, "customer_id", "left_semi", spread=spread, max_bytes=max_bytes)


def popular_items_by_segment(
    transactions: DataFrame,
    customers: DataFrame,
    column: str,
    value: str,
    n_days: int = RECENT_DAYS,
    reference: Reference = None,
    top_n: int = TOP_K,
) -> DataFrame:
    pairs = (
        recent(transactions, reference, n_days)
        .groupBy("customer_id", "article_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        segment_rows(pairs, customers, column, value)
        .groupBy("article_id")
        .agg(F.sum("n").alias("purchase_count"))
        .orderBy(F.col("purchase_count").desc(), "article_id")
        .limit(top_n)
    )


def decayed_popularity(
    transactions: DataFrame, reference: dt.date | str, n_days: int = RECENT_DAYS, alpha: float = DECAY
) -> DataFrame:
    """Purchase count and exponentially decayed score of every article bought in the window."""
    weight = F.exp(F.lit(-alpha) * days_before(reference, F.col("t_dat")))
    return (
        recent(transactions, reference, n_days)
        .groupBy("article_id")
        .agg(F.round(F.sum(weight), 9).alias("popularity_score"), F.count(F.lit(1)).alias("purchase_count"))
    )


def top_popular(popularity: DataFrame, top_n: int = TOP_K) -> DataFrame:
    return popularity.orderBy(F.col("popularity_score").desc(), "article_id").limit(top_n)


def popular_details(popularity: DataFrame, articles: DataFrame, top_n: int = 50) -> DataFrame:
    """The best articles with their names; the articles are reduced to those before the join.

    What is broadcast has at most ``top_n`` rows on either way; the catalogue is never shuffled.
    """
    top = top_popular(popularity, top_n)
    names = articles.select("article_id", "product_type_name", "product_group_name", "colour_group_name")
    named = names.join(F.broadcast(top.select("article_id")), "article_id", "left_semi")
    return top.join(F.broadcast(named), "article_id", "left").select(
        "article_id",
        "product_type_name",
        "product_group_name",
        "colour_group_name",
        "popularity_score",
        "purchase_count",
    )


def popularity_predict(customers: DataFrame, popularity: DataFrame, top_n: int = TOP_K) -> DataFrame:
    """The same list for every customer, attached as a scalar subquery."""
    best_first = F.array_sort(F.collect_list(F.struct((-F.col("popularity_score")).alias("o"), "article_id")))
    ranked = top_popular(popularity, top_n).agg(F.transform(best_first, lambda s: s["article_id"]).alias("l"))
    return customers.select("customer_id", ranked.scalar().alias("predicted_articles"))


def segment_top_n(
    transactions: DataFrame,
    segments: DataFrame,
    reference: dt.date | str,
    n_days: int = RECENT_DAYS,
    top_n: int = TOP_K,
    segment: str = "age_group",
    max_bytes: int | None = None,
) -> DataFrame:
    """Best-selling recent articles per segment: (segment, article_id, segment_purchases, rank).

    Purchases shrink to (customer, article) pairs before they meet the segments.
    """
    pairs = (
        recent(transactions, reference, n_days)
        .groupBy("customer_id", "article_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = known_segment(segments.select("customer_id", segment), segment)
    counts = (
        lookup_join(
            pairs,
            known,
            "customer_id",
            spread=["article_id"],
            max_bytes=max_bytes,
            hot_from=recent(transactions, reference, n_days),
        )
        .groupBy(segment, "article_id")
        .agg(F.sum("n").alias("segment_purchases"))
    )
    order = Window.partitionBy(segment).orderBy(F.col("segment_purchases").desc(), "article_id")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_n)


def segment_stats(ranked: DataFrame, segment: str = "age_group") -> DataFrame:
    return ranked.groupBy(segment).agg(
        F.sum("segment_purchases").alias("total_purchases"), F.count(F.lit(1)).alias("unique_articles")
    )


def segment_uniqueness(ranked: DataFrame, segment: str = "age_group") -> DataFrame:
    """Per segment: list length, and how much of it no other segment's list contains."""
    shared = F.count(F.lit(1)).over(Window.partitionBy("article_id"))
    unique = F.count(F.when(F.col("lists") == 1, 1))
    return (
        ranked.withColumn("lists", shared)
        .groupBy(segment)
        .agg(
            F.count(F.lit(1)).alias("num_articles"),
            unique.alias("unique_to_segment"),
            (100.0 * unique / F.count(F.lit(1))).alias("uniqueness_pct"),
        )
    )


def ranked_lists(ranked: DataFrame, key: str, rank: str = "rank") -> DataFrame:
    """Rows of (key, rank, article_id) as one short list per key, best first."""
    in_order = F.array_sort(F.collect_list(F.struct(rank, "article_id")))
    return ranked.groupBy(key).agg(F.transform(in_order, lambda s: s["article_id"]).alias("predicted_articles"))


def age_rules_predict(
    segments: DataFrame,
    ranked: DataFrame,
    segment: str = "age_group",
    keep_empty: bool = False,
    fallback: DataFrame | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Each customer gets the list of their segment.

    Customers of a segment without a list are dropped, or kept with ``[]`` (``keep_empty``), or get
    the one list of ``fallback`` (rows of article_id and rank).
    """
    per_segment = ranked_lists(ranked, segment)
    members = segments.select("customer_id", segment)
    out = lookup_join(members, per_segment, segment, "left", spread=["customer_id"], max_bytes=max_bytes)
    out = out.select("customer_id", segment, "predicted_articles")
    if fallback is not None:
        in_order = F.array_sort(F.collect_list(F.struct("rank", "article_id")))
        default = fallback.agg(F.transform(in_order, lambda s: s["article_id"]).alias("l")).scalar()
        return out.withColumn("predicted_articles", F.coalesce("predicted_articles", default))
    if keep_empty:
        empty = F.array().cast("array<long>")
        return out.withColumn("predicted_articles", F.coalesce("predicted_articles", empty))
    return out.filter(F.size("predicted_articles") > 0)


def next_pairs(transactions: DataFrame, limit: int = HOT_ROWS) -> DataFrame:
    """Each purchase with the customer's next one: (article_id, next_article).

    Purchases without a customer have no next one. A hot customer's history is cut into consecutive pieces. The last purchase of a piece is
    followed by the first of the next piece, taken from a table of one row per piece.
    """
    order, piece = ["t_dat", "transaction_id"], ["customer_id", "_day", "_slot"]
    slim = transactions.select("customer_id", "article_id", *order).filter(F.col("customer_id").isNotNull())
    cut, hot = with_pieces(slim, "customer_id", *order, limit)
    followed = cut.withColumn("next_article", F.lead("article_id").over(Window.partitionBy(*piece).orderBy(*order)))
    if hot is None:
        return followed.select("article_id", "next_article").filter("next_article is not null")
    heads = (
        cut.join(F.broadcast(hot), "customer_id", "left_semi")
        .groupBy(*piece)
        .agg(F.min_by("article_id", F.struct(*order)).alias("head"))
    )
    # One row per day or slot of a hot customer.
    after = Window.partitionBy("customer_id").orderBy("_day", "_slot")
    following = heads.withColumn("following", F.lead("head").over(after)).drop("head")
    # The window has already gathered the pieces, so only the small side is shuffled here.
    return (
        followed.join(following, piece, "left")
        .select("article_id", F.coalesce("next_article", "following").alias("next_article"))
        .filter("next_article is not null")
    )


def transitions(transactions: DataFrame, top_n: int = TOP_K, limit: int = HOT_ROWS) -> DataFrame:
    """The ``top_n`` articles most often bought right after each article."""
    counts = (
        next_pairs(transactions, limit)
        .groupBy("article_id", "next_article")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    order = Window.partitionBy("article_id").orderBy(F.col("times").desc(), "next_article")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_n)


def next_item_recommend(
    transactions: DataFrame, followers: DataFrame, max_bytes: int | None = None
) -> DataFrame:
    """For each customer, what usually follows their last purchase; ``[]`` if nothing ever did."""
    last = transactions.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.max_by("article_id", F.struct("t_dat", "transaction_id")).alias("article_id")
    )
    by_article = ranked_lists(
        followers.select(F.col("article_id").alias("last_article"), F.col("next_article").alias("article_id"), "rank"),
        "last_article",
    ).withColumnRenamed("last_article", "article_id")
    joined = lookup_join(
        last, by_article, "article_id", "left", spread=["customer_id"], max_bytes=max_bytes, hot_from=transactions
    )
    return joined.select(
        "customer_id",
        F.coalesce("predicted_articles", F.array().cast("array<long>")).alias("predicted_articles"),
    )


def popular_list(popularity: DataFrame, top_n: int = TOP_K) -> list[int]:
    """The one list of at most ``top_n`` articles that popularity has for everybody."""
    return [r["article_id"] for r in top_popular(popularity, top_n).select("article_id", "popularity_score").collect()]


def ensemble_blend(
    models: dict[str, DataFrame],
    weights: BlendWeights,
    top_k: int = TOP_K,
    for_all: dict[str, list[int]] | None = None,
) -> DataFrame:
    """Weighted reciprocal-rank blend for the customers that all models know.

    One equi-join per model on rows of one short list each; the blend itself stays inside the row. A
    model with one list for every customer is given by that list in ``for_all`` and needs no join.
    """
    joined, columns = None, []
    for name, weight in weights.as_pairs():
        if for_all and name in for_all:
            columns.append((F.array(*[F.lit(a) for a in for_all[name]]).cast("array<long>"), weight))
            continue
        side = models[name].select("customer_id", F.col("predicted_articles").alias(name))
        joined = side if joined is None else joined.join(side, "customer_id")
        columns.append((F.col(name), weight))
    if joined is None:
        raise ValueError("a blend needs at least one model that knows its customers")
    return joined.select("customer_id", lists.blend(columns, top_k).alias("predicted_articles"))
