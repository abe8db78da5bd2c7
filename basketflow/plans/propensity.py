"""Purchase propensity: a binary classifier on the encoded pairs."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.functions.encoding import FEATURES
from basketflow.operators.pairs import standardize
from basketflow.session import materialize

# Layer widths of the network, inputs to classes.
LAYERS = [8, 256, 128, 64, 2]


def logistic(regularization: float, max_iter: int = 50) -> LogisticRegression:
    return LogisticRegression(maxIter=max_iter, regParam=regularization)


def network(max_iter: int, seed: int = 42) -> MultilayerPerceptronClassifier:
    """The layered network; fits with several ``max_iter`` stand for early stopping."""
    return MultilayerPerceptronClassifier(layers=LAYERS, maxIter=max_iter, seed=seed)


REGULARIZATION = {f"logistic {r}": r for r in (0.0, 0.01, 0.1)}


def default_candidates() -> dict[str, Estimator]:
    return {name: logistic(r) for name, r in REGULARIZATION.items()}


def score(model, pairs: DataFrame) -> DataFrame:
    """Pairs with ``probability`` of a purchase and the predicted ``label``."""
    out = model.transform(pairs)
    return out.withColumn("p", vector_to_array("probability").getItem(1)).drop(
        "features", "rawPrediction", "probability"
    )


def quality(scored: DataFrame) -> DataFrame:
    """Accuracy, log loss and number of pairs."""
    p = F.least(F.greatest(F.col("p"), F.lit(1e-15)), F.lit(1 - 1e-15))
    loss = -F.when(F.col("label") == 1, F.log(p)).otherwise(F.log(1 - p))
    return scored.agg(
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
        F.avg(loss).alias("log_loss"),
        F.count(F.lit(1)).alias("num_pairs"),
    )


def fixed_score(pairs: DataFrame, coefficients: dict[str, float], intercept: float = 0.0) -> DataFrame:
    """Standardised pairs with ``p`` and ``prediction`` of given coefficients: scoring without fitting."""
    z = F.lit(float(intercept))
    for name, value in coefficients.items():
        z = z + F.col(name) * F.lit(float(value))
    out = pairs.withColumn("p", 1.0 / (1.0 + F.exp(-z)))
    return out.withColumn("prediction", (F.col("p") > 0.5).cast("double"))


def train_propensity(
    train: DataFrame, val: DataFrame, candidates: dict[str, Estimator] | None = None
) -> tuple[Model, DataFrame]:
    """Fit every candidate on the standardised training pairs; return the best by log loss, and all scores.

    Gradients are summed on the executors, so only coefficients reach the driver.
    """
    fixed = materialize(train, "propensity-train")
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    columns = [*FEATURES, "label"]
    fit_on = materialize(standardize(fixed, fixed).select(*columns), "propensity-fit")
    check_on = materialize(standardize(fixed, val).select(*columns), "propensity-val")
    fitted, scores = {}, []
    for name, estimator in (candidates or default_candidates()).items():
        fitted[name] = estimator.fit(assemble.transform(fit_on).select("features", "label"))
        row = quality(score(fitted[name], assemble.transform(check_on))).first()
        scores.append((name, row["accuracy"], row["log_loss"], row["num_pairs"]))
    best = min(scores, key=lambda s: s[2])[0]
    report = train.sparkSession.createDataFrame(
        [(*s, s[0] == best) for s in scores],
        "candidate string, accuracy double, log_loss double, num_pairs long, is_best boolean",
    )
    return fitted[best], report
