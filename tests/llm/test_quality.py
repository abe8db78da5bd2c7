import numpy as np
import pytest
from pyspark.sql import functions as F

from basketflow.llm import quality as Q
from basketflow.llm.common import held_out
from tests.conftest import SMALL


def test_features_do_not_depend_on_the_other_texts():
    texts = [b"", b"one two two, two!!", b"   ", "été ça".encode(), b"x" * 70_000, b"a\0b"]
    index, bounds = Q.features(texts)
    for i, text in enumerate(texts):
        assert (index[bounds[i] : bounds[i + 1]] == Q.features([text])[0]).all()
    assert np.diff(bounds).tolist() == [0, 11, 0, 3, 1, 3]


def test_dot_product_equals_the_sum_over_features():
    weights = np.random.default_rng(1).standard_normal(1 << 18)
    texts = [b"some words and some more", b"", b"!"]
    for text, score in zip(texts, Q.scores(texts, weights, 0.3), strict=True):
        at, value = Q.example(text)
        assert score == pytest.approx(1 / (1 + np.exp(-(np.append(weights, 0.3)[at] @ value))))


def test_leader_follows_the_closed_form():
    leader = Q.Leader(2, alpha=0.5, beta=1.0, l1=0.1, l2=0.2)
    z, n = np.zeros(5), np.zeros(5)
    rng = np.random.default_rng(2)
    for _ in range(50):
        at, value, label = np.array([0, 2, 4]), rng.random(3), int(rng.random() < 0.7)
        w = np.where(np.abs(z) <= 0.1, 0, -(z - np.sign(z) * 0.1) / ((1 + np.sqrt(n)) / 0.5 + 0.2))
        g = (1 / (1 + np.exp(-(w[at] @ value))) - label) * value
        z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / 0.5 * w[at]
        n[at] += g * g
        leader.learn(at, value, label)
    assert np.allclose(leader.z, z) and np.allclose(leader.n, n)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = Q.op3_quality(spark, folder).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 50
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.93


def test_edge_rows(spark, edge, no_docs):
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (7, None), (77, 1), (None, 1), (8, 5)], "doc_id long, quality int")
    weights, bias = Q.train(edge, labels, "quality")
    rows = Q.score(edge, weights, bias).collect()
    assert len(rows) == edge.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not (r["doc"]["text"] or "").strip()}) == 1
    assert Q.score(no_docs, weights, bias).count() == 0
    nothing, zero = Q.train(edge, labels.limit(0), "quality")
    assert not nothing.any() and zero == 0


def test_the_sample_is_thinned_to_its_bound(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").filter(~held_out("doc_id"))
    full, _ = Q.train(docs, labels, "quality")
    thin, _ = Q.train(docs, labels, "quality", most=2000)
    assert 0 < np.count_nonzero(thin) < np.count_nonzero(full)


def test_same_scores_on_every_layout(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    a = Q.train(docs, labels, "quality")
    b = Q.train(docs.repartition(7), labels.orderBy(F.desc("doc_id")), "quality")
    assert (a[0] == b[0]).all() and a[1] == b[1]
