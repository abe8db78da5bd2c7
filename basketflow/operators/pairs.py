"""Labelled (customer, article) pairs for the purchase classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.config import PairSampling
from basketflow.functions.encoding import FEATURES
from basketflow.functions.sampling import Hasher, fast_hash, keep_fraction
from basketflow.operators.ordering import with_row_index
from basketflow.operators.skew import lookup_join, small_enough
from basketflow.session import materialize

PAIR = ["customer_id", "article_id"]


def distinct_pairs(transactions: DataFrame) -> DataFrame:
    """Every bought pair once, as a positive."""
    return transactions.select(*PAIR).distinct().withColumn("label", F.lit(1))


def capped_sample(
    df: DataFrame, keys: list[str], max_rows: int | None, seed: int = 42, hasher: Hasher = fast_hash
) -> DataFrame:
    """All rows, or a Bernoulli sample of about ``max_rows`` if there are more.

    A row stays or goes by the hash of its keys, so the sample does not depend on partitioning.
    Without ``max_rows`` all rows stay: only what a model is fitted on may be sampled.
    """
    if max_rows is None:
        return df
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    share = F.least(F.lit(1.0), F.lit(float(max_rows)) / F.greatest(total, F.lit(1)))
    return df.filter(keep_fraction(share, *[F.col(k) for k in keys], seed=seed, hasher=hasher))


def fraction_sample(df: DataFrame, key: str, fraction: float, seed: int, hasher: Hasher = fast_hash) -> DataFrame:
    return df.filter(keep_fraction(fraction, F.col(key), seed=seed, hasher=hasher))


def _systematic(draws: DataFrame, start: Column, name: str) -> DataFrame:
    """Per row, ``wanted`` distinct numbers below ``free``, evenly spaced from ``start``."""
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.col("wanted") - 1))
    number = F.pmod(start + F.floor(F.col("step") * F.col("free") / F.col("wanted")), F.col("free"))
    return (
        draws.filter(F.col("wanted") > 0)
        .select("customer_id", "wanted", "free", step.alias("step"))
        .select("customer_id", number.alias(name))
    )


def _article_numbers(articles: DataFrame) -> DataFrame:
    """(article_id, at): articles numbered from 0 in id order, as a written table."""
    ids = articles.select("article_id").distinct()
    return materialize(with_row_index(ids, [F.col("article_id")], "at", start=0), "article-numbers")


def _at_numbers(drawn: DataFrame, index: DataFrame) -> DataFrame:
    """Articles of evenly spread numbers: no number is hot, so nothing is salted."""
    side = F.broadcast(index) if small_enough(index) else index
    return drawn.join(side, "at").select(*PAIR)


def candidate_pairs(
    customers: DataFrame, articles: DataFrame, per_customer: int, seed: int = 42, hasher: Hasher = fast_hash
) -> DataFrame:
    """Random pairs of customers and articles, ``per_customer`` distinct articles each.

    Articles get a dense number, each customer draws evenly spaced numbers from a hashed start. The
    output grows with the customers; the full product of both tables is never formed.
    """
    index = _article_numbers(articles)
    size = index.agg(F.count(F.lit(1)).alias("n")).scalar()
    asked = customers.select("customer_id", size.alias("free")).withColumn(
        "wanted", F.least(F.lit(per_customer).cast("long"), F.col("free"))
    )
    drawn = _systematic(asked, hasher(F.col("customer_id"), seed=seed), "at")
    return _at_numbers(drawn, index)


def unbought(pairs: DataFrame, positives: DataFrame) -> DataFrame:
    return pairs.join(positives.select(*PAIR), PAIR, "left_anti")


def negatives(
    sampled: DataFrame,
    bought: DataFrame,
    articles: DataFrame,
    ratio: float,
    seed: int = 42,
    hasher: Hasher = fast_hash,
) -> DataFrame:
    """``ratio`` unbought articles per sampled positive, exactly, as distinct pairs.

    Number the articles 0 … V-1. For a customer, an article's *gap* is the number of unbought
    articles before a bought one; the unbought article number ``j`` has ``j`` plus as many bought
    ones as have a gap up to ``j`` before it. So drawing distinct ``j`` below the number of unbought
    articles hits unbought articles only: no rejected draws, no retries, no product of both sides.
    A customer who bought nearly everything gets all that is left.

    Windows per customer hold each catalogue article at most once, whatever the purchase count.
    """
    index = _article_numbers(articles)
    size = index.agg(F.count(F.lit(1)).alias("n")).scalar()
    wanted = sampled.groupBy("customer_id").agg(F.round(F.count(F.lit(1)) * ratio).cast("long").alias("wanted"))
    of_interest = lookup_join(
        bought.select(*PAIR), wanted.select("customer_id"), "customer_id", "left_semi", spread=["article_id"]
    )
    numbered = lookup_join(of_interest, index, "article_id", spread=["customer_id"], hot_from=bought)
    ascending = Window.partitionBy("customer_id").orderBy("at")
    gaps = numbered.select(
        "customer_id", (F.col("at") - F.row_number().over(ascending) + 1).alias("j"), F.lit(0).alias("draw")
    )
    owned = numbered.groupBy("customer_id").agg(F.count(F.lit(1)).alias("owned"))
    asked = (
        wanted.join(owned, "customer_id", "left")
        .withColumn("free", size - F.coalesce("owned", F.lit(0).cast("long")))
        .withColumn("wanted", F.least("wanted", "free"))
    )
    draws = _systematic(asked, hasher(F.col("customer_id"), seed=seed), "j").withColumn("draw", F.lit(1))
    walk = (
        Window.partitionBy("customer_id").orderBy("j", "draw").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = (
        gaps.unionByName(draws)
        .withColumn("at", F.col("j") + F.sum(1 - F.col("draw")).over(walk))
        .filter(F.col("draw") == 1)
        .select("customer_id", "at")
    )
    return _at_numbers(placed, index)


def training_pairs(
    transactions: DataFrame,
    customer_codes: DataFrame,
    article_codes: DataFrame,
    sampling: PairSampling = PairSampling(),
    hasher: Hasher = fast_hash,
) -> DataFrame:
    """Positives (sampled), their negatives, and the encoded features of both sides."""
    bought = materialize(distinct_pairs(transactions), "bought-pairs")
    sampled = capped_sample(bought, PAIR, sampling.max_samples, sampling.seed, hasher)
    drawn = negatives(sampled, bought, article_codes, sampling.negative_ratio, sampling.seed, hasher)
    labelled = sampled.unionByName(materialize(drawn, "negatives").withColumn("label", F.lit(0)))
    with_customer = lookup_join(labelled, customer_codes, "customer_id", spread=["article_id"])
    return lookup_join(with_customer, article_codes, "article_id", spread=["customer_id"], hot_from=labelled)


def standardize(train: DataFrame, apply_to: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Zero mean and unit population deviation as measured on ``train``; constants only shift."""
    columns = columns or FEATURES
    moments = []
    for c in columns:
        moments += [F.avg(c).alias(f"mean_{c}"), F.stddev_pop(c).alias(f"std_{c}")]
    measured = train.agg(F.struct(*moments).alias("s")).scalar()

    def scaled(c: str) -> Column:
        deviation = F.col("_stats")[f"std_{c}"]
        return (F.col(c) - F.col("_stats")[f"mean_{c}"]) / F.when(deviation > 0, deviation).otherwise(1.0)

    return apply_to.withColumn("_stats", measured).withColumns({c: scaled(c) for c in columns}).drop("_stats")
