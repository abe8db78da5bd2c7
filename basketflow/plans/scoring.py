"""Scoring all customers with every champion model."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.session import materialize, scratch_scope
from basketflow.sources.files import write_table
from basketflow.sources.serving import ServingStore

_STATUS = (
    "model_name string, model_version string, model_alias string, status string, reason string, num_predictions long"
)


@dataclass(frozen=True)
class Model:
    """A registered model version: from customers with ``columns`` to (customer_id, predicted_articles)."""

    name: str
    version: str
    alias: str | None
    predict: Callable[[DataFrame], DataFrame]
    columns: tuple[str, ...] = ("customer_id",)


def champion(models: list[Model], name: str, alias: str = "Champion") -> Model | None:
    """The version of ``name`` that carries the alias, in any case of letters."""
    for m in models:
        if m.name == name and m.alias is not None and m.alias.lower() == alias.lower():
            return m
    return None


def predictions_union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def predictions_by_model(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy("model_name", "model_version")
        .agg(F.count(F.lit(1)).alias("num_predictions"))
        .orderBy("model_name", "model_version")
    )


def batch_scoring(
    customers: DataFrame, models: list[Model], batch_id: str, timestamp: str, alias: str = "Champion"
) -> tuple[DataFrame, DataFrame]:
    """Predictions of all champions in one table, and one status row per model.

    Each model gets the customer columns it declares. Its predictions are written to the shared
    folder, so a model that fails is reported and does not take the others with it. Raises if no
    model succeeds.
    """
    done, status = [], []
    for name in dict.fromkeys(m.name for m in models):
        model = champion(models, name, alias)
        if model is None:
            status.append((name, None, None, "SKIPPED", f"no version is marked {alias}", 0))
            continue
        try:
            scored = (
                model.predict(customers.select(*model.columns))
                .select("customer_id", F.col("predicted_articles").cast("array<long>").alias("predicted_articles"))
                .withColumns(
                    {
                        "model_name": F.lit(model.name),
                        "model_version": F.lit(str(model.version)),
                        "model_alias": F.lit(alias),
                        "prediction_timestamp": F.lit(timestamp).cast("timestamp"),
                        "batch_id": F.lit(batch_id),
                    }
                )
            )
            written = materialize(scored, f"scored-{name}")
            done.append(written)
            status.append((name, model.version, alias, "SUCCESS", "scored", written.count()))
        except Exception as error:  # noqa: BLE001 - the status row carries the reason
            status.append((name, model.version, alias, "FAILED", str(error).splitlines()[0], 0))
    if not done:
        raise RuntimeError(f"no model was scored; is any version marked {alias}?")
    return predictions_union(done), customers.sparkSession.createDataFrame(status, _STATUS)


PREDICTION_KEY = ["customer_id", "model_name"]


def scoring_job(
    customers: DataFrame,
    models: list[Model],
    batch_id: str,
    timestamp: str,
    out: str,
    store: ServingStore,
    target: str,
    alias: str = "Champion",
) -> tuple[DataFrame, DataFrame]:
    """Score with all champions, write one table, serve it by customer and model; table and status.

    What the models write on the way is deleted at the end; the served snapshot is checked for its
    key before it replaces the last one.
    """
    with scratch_scope(customers.sparkSession, "scoring"):
        predictions, status = batch_scoring(customers, models, batch_id, timestamp, alias)
        written = write_table(predictions, f"{out}/predictions")
        status = write_table(status, f"{out}/status")
    store.publish(written, target, PREDICTION_KEY, skip_if_exists=False)
    return written, status
