"""Ranking quality against the purchases of a truth window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.config import SECOND_K, TOP_K
from basketflow.functions.lists import precision_from_ranks


# Digits at which scores of models are compared.
SCORE_DIGITS = 9


def _models_of(predictions: DataFrame) -> list[str]:
    return [c for c in ("model_name", "model_version") if c in predictions.columns]


def hit_ranks(predictions: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """Per evaluated customer (and model): number of purchases and the ranks of the hits, ascending.

    Customers are those with both predictions and purchases. Hits are found by an equi-join on
    (customer, article), so a customer with very many purchases does not gather in one task.
    """
    by = [*_models_of(predictions), "customer_id"]
    totals = pairs.groupBy("customer_id").agg(F.sum("copies").alias("num_purchases"))
    evaluated = predictions.select(*by, F.slice("predicted_articles", 1, k).alias("top")).join(totals, "customer_id")
    ranked = evaluated.select(*by, F.posexplode(F.array_distinct("top")).alias("_", "article_id"), "top").select(
        *by, "article_id", F.array_position("top", F.col("article_id")).cast("int").alias("rank")
    )
    hits = ranked.join(pairs.select("customer_id", "article_id"), ["customer_id", "article_id"], "left_semi")
    per_customer = hits.groupBy(*by).agg(F.array_sort(F.collect_list("rank")).alias("ranks"))
    return evaluated.select(*by, "num_purchases").join(per_customer, by, "left").withColumn(
        "ranks", F.coalesce("ranks", F.array().cast("array<int>"))
    )


def average_precision_at_k(predictions: DataFrame, pairs: DataFrame, k: int = TOP_K) -> DataFrame:
    by = [*_models_of(predictions), "customer_id"]
    return hit_ranks(predictions, pairs, k).select(
        *by, "num_purchases", precision_from_ranks(F.col("ranks"), F.col("num_purchases"), k).alias("ap")
    )


def map_at_k(predictions: DataFrame, pairs: DataFrame, ks: tuple[int, ...] = (TOP_K, SECOND_K)) -> DataFrame:
    """Mean average precision at each cutoff, per model when predictions carry one; one pass for all."""
    ranks = hit_ranks(predictions, pairs, max(ks))

    def precision(k: int) -> Column:
        within = F.filter("ranks", lambda rank: rank <= k)
        return precision_from_ranks(within, F.col("num_purchases"), k)

    means = [F.avg(precision(k)).alias(f"map_at_{k}") for k in ks]
    return ranks.groupBy(*_models_of(predictions)).agg(*means, F.count(F.lit(1)).alias("num_evaluated"))


def eval_report(predictions: DataFrame, pairs: DataFrame, k: int = TOP_K) -> DataFrame:
    """Per model: MAP at ``k`` and 5, catalogue coverage, number of prediction rows.

    Coverage divides the distinct recommended articles by the distinct bought ones, so it may pass 1.
    """
    by = _models_of(predictions)
    ks = (k, SECOND_K) if k > SECOND_K else (k,)
    scores = map_at_k(predictions, pairs, ks)
    sizes = predictions.groupBy(*by).agg(F.count(F.lit(1)).alias("num_customers"))
    recommended = (
        predictions.select(*by, F.explode("predicted_articles").alias("article_id"))
        .groupBy(*by)
        .agg(F.count_distinct("article_id").alias("recommended"))
    )
    bought = pairs.agg(F.count_distinct("article_id").alias("n")).scalar()
    coverage = F.when(F.col("bought") > 0, F.coalesce("recommended", F.lit(0)) / F.col("bought")).otherwise(0.0)
    maps = [f"map_at_{x}" for x in ks]
    parts = sizes.unionByName(scores.drop("num_evaluated"), True).unionByName(recommended, True)
    # Each part has at most one row per model; gathering them needs no join, also without a model column.
    merged = parts.groupBy(*by).agg(*[F.max(c).alias(c) for c in ("num_customers", "recommended", *maps)])
    return merged.withColumn("bought", bought).select(*by, *maps, coverage.alias("catalog_coverage"), "num_customers")


def model_comparison(predictions: DataFrame, pairs: DataFrame, ensemble: str, k: int = TOP_K) -> DataFrame:
    """Models by MAP, the best flagged, and what the ensemble gains over the best base model.

    Scores are rounded before they are ranked, so the order of a floating sum flags no model; the
    gain is taken from the scores themselves.
    """
    scores = map_at_k(predictions, pairs, (k,)).select("model_name", F.col(f"map_at_{k}").alias("map"))
    best_base = F.max(F.when(F.col("model_name") != ensemble, F.col("map")))
    # Windows without a partition: one row per model, a handful in all.
    everything = Window.partitionBy()
    place = Window.orderBy(F.round("map", SCORE_DIGITS).desc())
    base = best_base.over(everything)
    gain = F.when((F.col("model_name") == ensemble) & (F.col("base") > 0), 100.0 * (F.col("map") - F.col("base")) / F.col("base"))
    return (
        scores.withColumns({"place": F.rank().over(place), "base": base})
        .withColumns({"is_best": F.col("place") == 1, "gain_pct": gain})
        .drop("base")
    )
