"""The training job: fit, apply, evaluate, compare and write all models of one reference date."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketflow.config import TOP_K, BlendWeights, Cutoffs
from basketflow.operators.evaluate import eval_report, model_comparison
from basketflow.plans import models
from basketflow.session import scratch_scope
from basketflow.sources.files import write_table


def train_models(
    transactions: DataFrame,
    segments: DataFrame,
    truth: DataFrame,
    cutoffs: Cutoffs,
    out: str,
    weights: BlendWeights = BlendWeights(),
    k: int = TOP_K,
) -> dict[str, DataFrame]:
    """Model tables, predictions, report and comparison under ``out``.

    Models see purchases up to the training cutoff only; ``truth`` are the pairs to predict.
    """
    with scratch_scope(transactions.sparkSession, "training"):
        fitted = models.fit(transactions, segments, cutoffs.train, top_k=k)
        tables = {f"model_{name}": write_table(df, f"{out}/model_{name}") for name, df in fitted.items()}
        lists = models.predict_with_ensemble(fitted, segments, transactions, cutoffs.train, weights)
        tables["predictions"] = write_table(lists, f"{out}/predictions")
        tables["report"] = write_table(eval_report(tables["predictions"], truth, k), f"{out}/report")
        compared = model_comparison(tables["predictions"], truth, "ensemble", k)
        tables["comparison"] = write_table(compared, f"{out}/comparison")
    return tables
