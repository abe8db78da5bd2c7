"""Evaluating model versions before one is deployed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.config import TOP_K, Cutoffs
from basketflow.operators.evaluate import eval_report
from basketflow.operators.labels import truth_pairs
from basketflow.plans.scoring import Model, predictions_union
from basketflow.session import materialize


def deployment_evaluation(
    model: Model,
    transactions: DataFrame,
    customer_features: DataFrame,
    cutoffs: Cutoffs,
    dataset: str = "val",
    k: int = TOP_K,
) -> DataFrame:
    """Report of one model, as of several in ``evaluate_versions``."""
    return evaluate_versions([model], transactions, customer_features, cutoffs, dataset, k)


def evaluate_versions(
    models: list[Model],
    transactions: DataFrame,
    customer_features: DataFrame,
    cutoffs: Cutoffs,
    dataset: str = "val",
    k: int = TOP_K,
) -> DataFrame:
    """Report of the models on the customers of the val or test truth window, one row each.

    Truth customers without features keep null features. Article ids are compared as longs on both
    sides, whatever a model returns. All models see the same written truth.
    """
    bought = truth_pairs(transactions, *cutoffs.truth_window(dataset))
    pairs = materialize(bought.withColumn("article_id", F.col("article_id").cast("long")), "truth")
    buyers = pairs.select("customer_id").distinct()

    def lists(model: Model) -> DataFrame:
        known = buyers.join(customer_features.select(*model.columns), "customer_id", "left")
        return model.predict(known).select(
            "customer_id",
            F.col("predicted_articles").cast("array<long>").alias("predicted_articles"),
            F.lit(model.name).alias("model_name"),
            F.lit(str(model.version)).alias("model_version"),
        )

    written = materialize(predictions_union([lists(m) for m in models]), "candidate-predictions")
    return eval_report(written, pairs, k).withColumn("dataset", F.lit(dataset))
