"""The model table and its gate, contexts against counting by hand, the network against its gradient."""

import threading
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketflow.functions import encoding
from basketflow.functions.encoding import FEATURES
from basketflow.operators import contexts, evaluate, labels, pairs, recommend
from basketflow.plans import deployment, evaluation, neural, propensity, scoring
from basketflow.plans.model_registry import AliasMoved, ModelRegistry
from basketflow.registry.common import E_CUTS
from basketflow.session import materialize, scratch_path


@pytest.fixture
def registry(spark):
    return ModelRegistry(spark, scratch_path(spark, "models"))


def ranked(spark, articles):
    """Articles, the most popular first."""
    return spark.createDataFrame([(a, -float(r)) for r, a in enumerate(articles)], "article_id long, popularity_score double")


def test_versions_are_numbered_and_listed(spark, registry):
    assert registry.table().collect() == [] and registry.current("m", "Champion") is None
    one, two = (registry.register("m", "popularity", {"ranked": ranked(spark, [3, 1])}, metrics={"map": s}) for s in (0.1, 0.2))
    registry.register("other", "not known", {})
    assert (one, two) == (1, 2)
    registry.set_alias("m", "Champion", 1, None)
    registry.set_alias("m", "CHAMPION", 2, 1)
    registry.set_alias("m", "old", 1, None)
    rows = {(r.model_name, r.version): r for r in registry.table().collect()}
    assert set(rows) == {("m", 1), ("m", 2), ("other", 1)}
    assert rows["m", 2].aliases == ["CHAMPION"] and rows["m", 1].aliases == ["old"] and rows["other", 1].aliases == []
    assert rows["m", 2].metrics == {"map": 0.2} and rows["m", 1].registered_at < rows["m", 2].registered_at
    assert [r.version for r in registry.moves().filter("lower(alias) = 'champion'").orderBy("number").collect()] == [1, 2]
    with pytest.raises(LookupError):
        registry.set_alias("m", "Champion", 3, 2)
    with pytest.raises(ValueError):
        registry.register("../m", "popularity", {})


def test_a_race_for_an_alias_has_one_winner(spark, registry):
    for _ in range(3):
        registry.register("m", "popularity", {})
    registry.set_alias("m", "Champion", 1, None)
    for _ in range(4):
        before, outcome, gate = registry.current("m", "Champion"), [], threading.Barrier(3)

        def move(version, seen, outcome=outcome, gate=gate):
            gate.wait()
            try:
                registry.set_alias("m", "Champion", version, seen)
                outcome.append(version)
            except AliasMoved:
                outcome.append(None)

        writers = [threading.Thread(target=move, args=(v, before)) for v in (1, 2, 3)]
        for w in writers:
            w.start()
        for w in writers:
            w.join()
        won = [v for v in outcome if v is not None]
        assert len(won) == 1 and registry.current("m", "Champion") == won[0]
    with pytest.raises(AliasMoved):
        registry.set_alias("m", "Champion", 1, 99)
    assert registry.moves().count() == 5


def test_a_race_for_a_number_gives_two_versions(spark, registry):
    found, gate = [], threading.Barrier(4)

    def add():
        gate.wait()
        found.append(registry.register("m", "popularity", {}))

    writers = [threading.Thread(target=add) for _ in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert sorted(found) == [1, 2, 3, 4] and registry.versions().count() == 4


def test_scoring_takes_champions_from_the_table(spark, registry):
    registry.register("m", "popularity", {"ranked": ranked(spark, [9])})
    registry.register("m", "popularity", {"ranked": ranked(spark, [3, 1, 2])}, params={"top_k": "2"})
    registry.register("odd", "not known", {})
    registry.register("idle", "popularity", {"ranked": ranked(spark, [1])})
    registry.set_alias("m", "champion", 2, None)
    registry.set_alias("odd", "Champion", 1, None)
    registry.set_alias("idle", "Challenger", 1, None)
    customers = spark.createDataFrame([("a",), ("b",)], "customer_id string")
    predictions, status = scoring.batch_scoring(customers, registry.models(), "b", "2024-01-01 00:00:00")
    assert {(r.customer_id, r.model_version, tuple(r.predicted_articles)) for r in predictions.collect()} == {
        ("a", "2", (3, 1)), ("b", "2", (3, 1)),
    }
    assert {(r.model_name, r.status) for r in status.collect()} == {("m", "SUCCESS"), ("odd", "FAILED"), ("idle", "SKIPPED")}


def test_the_gate_lets_only_better_versions_pass(spark, registry, x, monkeypatch):
    bought = labels.truth_pairs(x.e, *E_CUTS.truth_window("val"))
    often = [r.article_id for r in bought.groupBy("article_id").agg(F.sum("copies").alias("n")).orderBy(F.desc("n"), "article_id").limit(12).collect()]
    registry.register("m", "popularity", {"ranked": ranked(spark, [-1, -2])})
    registry.register("m", "popularity", {"ranked": ranked(spark, often)})
    registry.register("m", "popularity", {"ranked": ranked(spark, often)})

    def gate(version, **options):
        return deployment.deploy(registry, "m", version, {}, x.e, x.segments, E_CUTS, **options)

    first, better, equal = gate(1), gate(2), gate(3)
    assert first.moved and first.champion is None and first.candidate_score == 0
    assert better.moved and better.champion == 1 and better.candidate_score > 0
    assert not equal.passed and equal.champion_score == equal.candidate_score and registry.current("m", "Champion") == 2
    assert not gate(2, min_gain=1.0, alias="Other").champion and registry.current("m", "other") == 2
    nobody = deployment.deploy(registry, "m", 3, {}, x.e.limit(0), x.segments, E_CUTS)
    assert not nobody.passed and nobody.reason == "nobody to evaluate it on"
    registry.set_alias("m", "Champion", 1, 2)
    evaluated = evaluation.evaluate_versions

    def meanwhile(*args, **options):
        registry.set_alias("m", "Champion", 3, 1)
        return evaluated(*args, **options)

    monkeypatch.setattr(deployment, "evaluate_versions", meanwhile)
    late = gate(2)
    assert late.passed and not late.moved and registry.current("m", "Champion") == 3


def count_contexts(histories, order, top_n):
    counts = defaultdict(Counter)
    for items in histories:
        for i, follower in enumerate(items):
            for n in range(min(i, order) + 1):
                if n and 0 in items[i - n : i]:
                    break
                if follower:
                    counts[tuple(items[i - n : i])][follower] += 1
    return {c: (sum(f.values()), len(f), sorted(f.items(), key=lambda p: (-p[1], p[0]))[:top_n]) for c, f in counts.items()}


def best_followers(model, items, order, k):
    scores, share = defaultdict(float), 1.0
    for n in range(min(len(items), order), -1, -1):
        ending = tuple(items[len(items) - n :])
        if ending in model and 0 not in ending:
            times, kinds, followers = model[ending]
            for follower, c in followers:
                scores[follower] += share * c / (times + kinds)
            share *= kinds / (times + kinds)
    return sorted(scores, key=lambda a: (-round(scores[a], 12), a))[:k]


@pytest.mark.parametrize("order", [1, 3, 10])
def test_contexts_equal_counting_by_hand(spark, order):
    rng = np.random.default_rng(order)
    data = []
    for c in range(200):
        items = rng.integers(1, 8, rng.integers(0, 11)).tolist()
        if items and c % 7 == 0:
            items[len(items) // 2] = 0
        data.append((f"c{c}", [0] * (11 - len(items)) + items))
    encoded = spark.createDataFrame(data, "customer_id string, encoded array<long>").repartition(3)
    fitted = materialize(contexts.fit_contexts(encoded, order, 3), "fitted")
    model = count_contexts([items for _, items in data], order, 3)
    assert fitted.count() == len(model)
    found = {r.customer_id: r.follower_numbers for r in contexts.predict_contexts(encoded, fitted, order, 5).collect()}
    assert found == {c: best_followers(model, items, order, 5) for c, items in data}
    open_join = contexts.predict_contexts(encoded, fitted, order, 5, max_bytes=0).collect()
    assert {r.customer_id: r.follower_numbers for r in open_join} == found


def test_contexts_beat_the_last_purchase_alone(x):
    truth = materialize(labels.truth_pairs(x.e, *E_CUTS.truth_window("val")), "truth")
    longer = contexts.sequence_recommend(x.e_train, contexts.fit(x.e_train))
    first = recommend.next_item_recommend(x.e_train, recommend.transitions(x.e_train))
    scores = [evaluate.map_at_k(p, truth).first()["map_at_12"] for p in (longer, first)]
    assert scores[0] > scores[1]


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(1)
    layers = neural.start(rng.normal(size=8), 0.3, (5, 4))
    layers = layers.like(layers.flat() + rng.normal(0, 0.1, len(layers.flat())))
    rows, y = rng.normal(size=(40, 8)), rng.integers(0, 2, 40).astype(float)
    _, slope = layers.gradient(rows, y)
    for at in range(0, len(slope), 7):
        step = np.zeros(len(slope))
        step[at] = 1e-6
        up, down = (layers.like(layers.flat() + s).gradient(rows, y)[0] for s in (step, -step))
        assert abs((up - down) / 2e-6 - slope[at]) < 1e-4


@pytest.fixture(scope="module")
def coded(x):
    codes = encoding.encode_customers(x.customers), encoding.encode_articles(x.articles)
    val = labels.temporal_split(x.e, E_CUTS)["val"]
    return [materialize(pairs.training_pairs(t, *codes), "coded") for t in (x.e_train, val)]


def test_the_kept_epoch_is_the_least_of_the_curve(coded):
    train, val = coded
    layers, report = neural.train_network(train, val, hidden=(16, 8), epochs=4, batches=2, rate=0.01)
    curve = report.orderBy("epoch").collect()
    assert [r.epoch for r in curve] == [0, 1, 2, 3, 4] and {r.num_pairs for r in curve} == {val.count()}
    best = min(curve, key=lambda r: r.val_loss)
    assert [r.epoch for r in curve if r.is_best] == [best.epoch]
    assert curve[1].train_loss != curve[2].train_loss and curve[-1].train_loss < curve[0].train_loss
    scaled = pairs.standardize(train, val)
    scored = neural.score(scaled, layers)
    assert abs(propensity.quality(scored).first()["log_loss"] - best.val_loss) < 1e-9
    assert abs(neural.forward_quality(scaled, layers).first()["log_loss"] - best.val_loss) < 1e-9
    model, logistic = propensity.train_propensity(train, val, {"logistic": propensity.logistic(0.01)})
    assert best.val_loss <= logistic.first()["log_loss"] + 1e-9


def test_sums_do_not_depend_on_the_partitions(coded):
    scaled = materialize(pairs.standardize(coded[0], coded[0]).select(*FEATURES, "label"), "scaled")
    layers = neural.start(np.linspace(-1, 1, 8), 0.1, (6, 3))
    sums = [neural.summed(scaled.repartition(n), layers) for n in (1, 13)]
    assert sums[0][0] == sums[1][0] and abs(sums[0][1] - sums[1][1]) < 1e-6
    assert np.allclose(sums[0][2], sums[1][2])
    assert neural.summed(scaled.limit(0), layers)[0] == 0
