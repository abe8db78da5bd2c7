"""Quality scores: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Words are runs of letters and digits, and runs of signs; a word like the one before it counts as the
mark "again". Single words and pairs of neighbours are hashed into a fixed number of features, and a
text is the vector of their shares. A score is the sparse dot product with the learned weights,
through the logistic function. Training visits a bounded sample of labelled texts one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.common import annotate, heavy_hash, held_out, table
from basketflow.session import materialize

FEATURE_BITS = 18
# Bounds of the training sample: expected rows, by a hash of the id, and expected features of all
# their texts together. The sample is what one task holds and visits again and again.
TRAIN_ROWS = 8000
TRAIN_FEATURES = 8_000_000
PASSES = 4
THRESHOLD = 0.3
# Shares are small numbers; this brings a common feature near 1.
SCALE = 64.0

_KIND = np.array(
    [1 if chr(b).isalnum() or b >= 0x80 else 2 if 0x20 < b < 0x7F else 0 for b in range(256)], np.uint8
)
_BASE, _PAIR = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_AGAIN = np.uint64(0x5851F42D4C957F2D)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def features(texts: list[bytes], bits: int = FEATURE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words and pairs, text by text, and where each text's begin and end."""
    data = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    kind = _KIND[data]
    change = np.flatnonzero(np.append(True, kind[1:] != kind[:-1])) if len(kind) else np.zeros(0, np.int64)
    start = change[kind[change] > 0]
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    length = np.append(change, len(kind))[np.searchsorted(change, start, "right")] - start
    inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    power = np.cumprod(np.full(int(length.max()), _BASE))
    letters = data[np.repeat(start, length) + inside].astype(np.uint64) + np.uint64(1)
    word = _mixed(np.add.reduceat(letters * power[inside], np.cumsum(length) - length))
    doc = np.searchsorted(ends, start, "right")
    inner = np.append(False, doc[1:] == doc[:-1])
    again = inner & np.append(False, word[1:] == word[:-1])
    word = np.where(again, _AGAIN, word)
    pair = _mixed(np.append(np.uint64(0), word[:-1]) * _PAIR + word)
    both = np.stack([word, pair], axis=1).reshape(-1)
    use = np.stack([np.ones(len(word), bool), inner], axis=1).reshape(-1)
    count = np.bincount(doc, weights=1 + inner, minlength=len(texts)).astype(np.int64)
    return (both[use] >> np.uint64(64 - bits)).astype(np.int64), np.concatenate([[0], np.cumsum(count)])


def scores(texts: list[bytes], weights: np.ndarray, bias: float) -> np.ndarray:
    """The logistic of bias plus dot product, for each text; a text without words gets the bias."""
    index, bounds = features(texts, int(np.log2(len(weights))))
    total = np.zeros(len(texts))
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        total[full] = np.add.reduceat(weights[index], bounds[full]) * SCALE / np.diff(bounds)[full]
    return 1.0 / (1.0 + np.exp(-np.clip(total + bias, -500, 500)))


class Leader:
    """Follow the regularised leader: per weight the sum of gradients and of their squares."""

    def __init__(self, bits: int = FEATURE_BITS, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        # The last place is the bias.
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weight(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / step)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weight(at)
        gradient = (1.0 / (1.0 + np.exp(-np.clip(w @ value, -500, 500))) - label) * value
        n = self.n[at]
        self.z[at] += gradient - (np.sqrt(n + gradient**2) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + gradient**2


def fit(examples: list[tuple[np.ndarray, np.ndarray, int]], bits: int = FEATURE_BITS, passes: int = PASSES) -> tuple[np.ndarray, float]:
    """Weights and bias from examples (feature numbers, values, label) in the given order."""
    leader = Leader(bits)
    for _ in range(passes):
        for at, value, label in examples:
            leader.learn(at, value, label)
    weights = leader.weight(np.arange(len(leader.z)))
    return weights[:-1], float(weights[-1])


def example(text: bytes, bits: int = FEATURE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """A text's features once each with their scaled shares, and the bias."""
    index, _ = features([text], bits)
    at, count = np.unique(index, return_counts=True)
    return np.append(at, 1 << bits), np.append(count * (SCALE / max(1, len(index))), 1.0)


def _examples(texts: list[bytes], bits: int) -> list[list]:
    made = [example(t, bits) for t in texts]
    return [[a.astype(np.int32) for a, _ in made], [v.astype(np.float32) for _, v in made]]


def _fit_task(batches, bits: int, passes: int):
    """Learns from all rows of the task, in order; gives the weights that are not 0, the bias last."""
    examples = []
    for batch in batches:
        columns = (batch.column(c) for c in ("at", "value", "label"))
        for at, value, label in zip(*columns, strict=True):
            examples.append((at.values.to_numpy(), value.values.to_numpy().astype(np.float64), label.as_py()))
    if examples:
        weights, bias = fit(examples, bits, passes)
        index = np.append(np.flatnonzero(weights), len(weights))
        yield pa.RecordBatch.from_arrays([pa.array(index), pa.array(np.append(weights[index[:-1]], bias))], ["at", "weight"])


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    doc_id: str = "doc_id",
    text: str = "text",
    bits: int = FEATURE_BITS,
    rows: int = TRAIN_ROWS,
    most: int = TRAIN_FEATURES,
) -> tuple[np.ndarray, float]:
    """Weights and bias learned from a hash sample of the rows of ``labels`` that are 0 or 1.

    About ``rows`` labels are drawn and joined to their texts, whole; if these have more than ``most``
    features in all, the sample is thinned until about so many are left. Without any label all
    weights are 0. Labels without a document, and missing labels, teach nothing.
    """
    known = labels.filter(F.col(label).isin(0, 1)).select(
        F.col(doc_id).alias("of"), F.col(label).cast("int").alias("label"), heavy_hash(F.col(doc_id).cast("string")).alias("mark")
    )
    span = float(1 << 62)
    share = min(1.0, rows / max(1, known.count()))
    # Bounded by ``rows``: some 30 bytes each.
    drawn = F.broadcast(known.filter(F.col("mark") < share * span))
    texts = docs.select(F.col(doc_id).alias("own"), F.col(text).alias("body")).join(drawn, F.col("own") == F.col("of"))
    vectors = annotate(
        texts.select("mark", "label", "body"), "body", "at array<int>, value array<float>",
        lambda: lambda t: _examples(t, bits), ["mark", "label"],
    ).select("doc.mark", "doc.label", "at", "value")
    vectors = materialize(vectors, "examples")
    total = vectors.agg(F.sum(F.size("at"))).first()[0] or 0
    fewer = vectors.filter(F.col("mark") < share * span * min(1.0, most / max(1, total)))
    ordered = fewer.repartition(1).sortWithinPartitions("mark", "label")
    learned = ordered.mapInArrow(lambda b: _fit_task(b, bits, PASSES), "at long, weight double").collect()
    weights = np.zeros((1 << bits) + 1)
    for r in learned:
        weights[r["at"]] = r["weight"]
    return weights[:-1], float(weights[-1])


def score(
    docs: DataFrame, weights: np.ndarray, bias: float, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``doc`` (the columns of a row, or those in ``keep``) and ``score``, from 0 to 1, of each whole text.

    A text without words (missing, empty, white space) scores as the bias alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast((weights, bias))
    return annotate(docs, text, "score double", lambda: lambda texts: [pa.array(scores(texts, *shared.value))], keep)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out("doc_id"))
    found = score(docs, *train(docs, labels, "quality"), keep=["doc_id"])
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return found.select("doc.doc_id", held_out("doc.doc_id").alias("held_out"), "score", predicted.alias("predicted"))
