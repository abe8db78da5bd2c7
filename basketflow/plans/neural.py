"""A layered network for purchase propensity, fitted epoch by epoch, the best epoch kept.

The network adds its layers to a linear part that starts from the logistic regression, so the first
row of the curve is the logistic model and training goes on from there. Each step sums the gradient
over the rows of one batch: tasks sum over their rows, a few tasks sum those sums, and only these
reach the driver, which takes the step. An epoch ends with the loss on all validation pairs; the
weights of the least loss are what is returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.functions.encoding import FEATURES
from basketflow.operators.pairs import standardize
from basketflow.plans.propensity import logistic, quality
from basketflow.session import materialize

# Hidden layers, and how long and fast the network is fitted.
HIDDEN = (256, 128, 64)
EPOCHS = 10
BATCHES = 4
RATE = 0.001
# Tasks that add up the sums of all others.
_ADDERS = 8
_SUMS = "part int, rows long, loss double, sums binary"


@dataclass(frozen=True)
class Layers:
    """Weights: the linear part, and per layer a matrix and its offsets; the last layer has one output."""

    linear: np.ndarray
    matrices: list[np.ndarray]
    offsets: list[np.ndarray]

    def flat(self) -> np.ndarray:
        return np.concatenate([self.linear, *(m.ravel() for m in self.matrices), *self.offsets])

    def like(self, flat: np.ndarray) -> Layers:
        """Weights of the same shape from one vector."""
        parts, at = [], 0
        for shape in [self.linear.shape, *(m.shape for m in self.matrices), *(b.shape for b in self.offsets)]:
            size = math.prod(shape)
            parts.append(flat[at : at + size].reshape(shape))
            at += size
        n = len(self.matrices)
        return Layers(parts[0], parts[1 : n + 1], parts[n + 1 :])

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The logits of the rows of ``x``, and what every layer has put out."""
        outputs = [x]
        for matrix, offset in zip(self.matrices[:-1], self.offsets[:-1]):
            outputs.append(np.maximum(outputs[-1] @ matrix + offset, 0.0))
        return (outputs[-1] @ self.matrices[-1] + self.offsets[-1])[:, 0] + x @ self.linear, outputs

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        """Summed log loss and its summed gradient over the rows."""
        logits, outputs = self.forward(x)
        loss = float(np.sum(np.logaddexp(0.0, logits) - y * logits))
        back = (1.0 / (1.0 + np.exp(-logits)) - y)[:, None]
        linear, matrices, offsets = x.T @ back[:, 0], [], []
        for layer in range(len(self.matrices) - 1, -1, -1):
            matrices.insert(0, outputs[layer].T @ back)
            offsets.insert(0, back.sum(axis=0))
            if layer:
                back = (back @ self.matrices[layer].T) * (outputs[layer] > 0)
        return loss, Layers(linear, matrices, offsets).flat()


def start(linear: np.ndarray, intercept: float, hidden: tuple[int, ...], seed: int = 42) -> Layers:
    """Random layers whose last one is zero: the network begins as its linear part."""
    rng = np.random.default_rng(seed)
    widths = [len(linear), *hidden, 1]
    matrices = [rng.normal(0, math.sqrt(2 / a), (a, b)) for a, b in zip(widths, widths[1:])]
    matrices[-1][:] = 0.0
    offsets = [np.zeros(b) for b in widths[1:]]
    offsets[-1][0] = intercept
    return Layers(np.array(linear, float), matrices, offsets)


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in FEATURES]).astype(float)
    return x, batch.column("label").to_numpy(zero_copy_only=False).astype(float)


def _record(rows: int, loss: float, sums: np.ndarray, part: int) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.float64(), pa.binary()]
    values = [[part], [rows], [loss], [sums.tobytes()]]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], ["part", "rows", "loss", "sums"])


def summed(pairs: DataFrame, layers: Layers, gradient: bool = True) -> tuple[int, float, np.ndarray]:
    """Rows, log loss and gradient summed over ``pairs`` (FEATURES and label), in tasks."""
    shared = pairs.sparkSession.sparkContext.broadcast((layers, gradient))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, whole = shared.value
        rows, loss, sums, first = 0, 0.0, np.zeros(len(weights.flat()) if whole else 0), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _rows(batch)
            if whole:
                more, step = weights.gradient(x, y)
                sums += step
            else:
                logits, _ = weights.forward(x)
                more = float(np.sum(np.logaddexp(0.0, logits) - y * logits))
            rows, loss, first = rows + len(y), loss + more, first or int(abs(x[0]).sum() * 1e6)
        yield _record(rows, loss, sums, first % _ADDERS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, loss, sums = 0, 0.0, None
        for batch in batches:
            for _, n, part, body in zip(*[c.to_pylist() for c in batch.columns]):
                step = np.frombuffer(body)
                rows, loss, sums = rows + n, loss + part, step.copy() if sums is None else sums + step
        if sums is not None:
            yield _record(rows, loss, sums, 0)

    parts = pairs.select(*FEATURES, "label").mapInArrow(partial, _SUMS)
    found = parts.repartition(_ADDERS, "part").mapInArrow(add, _SUMS).collect()
    shared.destroy()
    total = sum((np.frombuffer(r["sums"]) for r in found), np.zeros(1 if not gradient else len(layers.flat()))[: 0 if not gradient else None])
    return sum(r["rows"] for r in found), sum(r["loss"] for r in found), total


@dataclass
class _Adam:
    """Steps from summed gradients with running means of them and of their squares."""

    rate: float
    steps: int = 0
    mean: np.ndarray | None = field(default=None)
    square: np.ndarray | None = field(default=None)

    def step(self, flat: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        if self.mean is None:
            self.mean, self.square = np.zeros_like(flat), np.zeros_like(flat)
        self.steps += 1
        self.mean = 0.9 * self.mean + 0.1 * gradient
        self.square = 0.999 * self.square + 0.001 * gradient**2
        mean, square = self.mean / (1 - 0.9**self.steps), self.square / (1 - 0.999**self.steps)
        return flat - self.rate * mean / (np.sqrt(square) + 1e-8)


def train_network(
    train: DataFrame,
    val: DataFrame,
    hidden: tuple[int, ...] = HIDDEN,
    epochs: int = EPOCHS,
    batches: int = BATCHES,
    rate: float = RATE,
    seed: int = 42,
    regularization: float = 0.01,
) -> tuple[Layers, DataFrame]:
    """The network of the best epoch, and the curve (epoch, train_loss, val_loss, num_pairs, is_best).

    ``train`` and ``val`` are coded pairs; both are scaled by the moments of ``train``. Epoch 0 is the
    logistic regression. A pair's batch is a hash of its customer and article, so the same on every
    run; every batch is used once an epoch.
    """
    fixed = materialize(train, "network-pairs")
    number = F.pmod(F.xxhash64("customer_id", "article_id"), F.lit(batches)).cast("int")
    scaled = standardize(fixed, fixed).select(number.alias("batch"), *FEATURES, "label")
    fit_on = materialize(scaled.repartition("batch", *FEATURES), "network-fit")
    check_on = materialize(standardize(fixed, val).select(*FEATURES, "label"), "network-val")
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    linear = logistic(regularization).fit(assemble.transform(fit_on).select("features", "label"))
    layers = start(linear.coefficients.toArray(), linear.intercept, hidden, seed)
    checked, loss, _ = summed(check_on, layers, gradient=False)
    fitted_rows, first, _ = summed(fit_on, layers, gradient=False)
    curve = [(0, first / max(fitted_rows, 1), loss / max(checked, 1))]
    best, kept, adam = curve[0][2], layers, _Adam(rate)
    for epoch in range(1, epochs + 1):
        seen, total = 0, 0.0
        for b in range(batches):
            rows, part, gradient = summed(fit_on.filter(F.col("batch") == b), layers)
            if rows:
                layers = layers.like(adam.step(layers.flat(), gradient / rows))
                seen, total = seen + rows, total + part
        checked, loss, _ = summed(check_on, layers, gradient=False)
        curve.append((epoch, total / max(seen, 1), loss / max(checked, 1)))
        if curve[-1][2] < best:
            best, kept = curve[-1][2], layers
    report = train.sparkSession.createDataFrame(
        [(e, t, v, checked, v == best and e == next(c[0] for c in curve if c[2] == best)) for e, t, v in curve],
        "epoch int, train_loss double, val_loss double, num_pairs long, is_best boolean",
    )
    return kept, report


def score(pairs: DataFrame, layers: Layers) -> DataFrame:
    """Scaled pairs with ``p`` and ``prediction`` of the network, batch by batch in tasks."""
    shared = pairs.sparkSession.sparkContext.broadcast(layers)
    schema = pairs.withColumns({"p": F.lit(0.0), "prediction": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in FEATURES]).astype(float)
            p = 1.0 / (1.0 + np.exp(-shared.value.forward(x)[0]))
            made = [*batch.columns, pa.array(p), pa.array((p > 0.5).astype(float))]
            yield pa.RecordBatch.from_arrays(made, schema.names)

    return pairs.mapInArrow(run, schema)


def forward_column(layers: Layers) -> Column:
    """The probability as one column expression, for small networks: no Python in the plan."""
    def weighted(values: list[Column], weights: np.ndarray, offset: float) -> Column:
        total = F.lit(float(offset))
        for value, weight in zip(values, weights.tolist(), strict=True):
            total = total + value * F.lit(float(weight))
        return total

    outputs = [F.col(c) for c in FEATURES]
    linear = weighted(outputs, layers.linear, 0.0)
    for matrix, offset in zip(layers.matrices[:-1], layers.offsets[:-1]):
        outputs = [
            F.greatest(weighted(outputs, matrix[:, j], offset[j]), F.lit(0.0)) for j in range(matrix.shape[1])
        ]
    logit = weighted(outputs, layers.matrices[-1][:, 0], layers.offsets[-1][0]) + linear
    return 1.0 / (1.0 + F.exp(-logit))


def forward_quality(pairs: DataFrame, layers: Layers) -> DataFrame:
    """Accuracy, log loss and number of scaled pairs under given weights."""
    out = pairs.withColumn("p", forward_column(layers))
    return quality(out.withColumn("prediction", (F.col("p") > 0.5).cast("double")))
