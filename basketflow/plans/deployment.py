"""Deploying a candidate version: evaluate it beside the champion, and move the alias if it is better."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from basketflow.config import TOP_K, Cutoffs
from basketflow.plans.evaluation import evaluate_versions
from basketflow.plans.model_registry import AliasMoved, ModelRegistry, Tables

CHAMPION = "Champion"
# Digits at which scores of versions are compared.
SCORE_DIGITS = 9


@dataclass(frozen=True)
class Decision:
    """What the gate found and did."""

    model_name: str
    candidate: int
    champion: int | None
    candidate_score: float | None
    champion_score: float | None
    passed: bool
    moved: bool
    reason: str


def deploy(
    registry: ModelRegistry,
    name: str,
    candidate: int,
    sources: Tables,
    transactions: DataFrame,
    customer_features: DataFrame,
    cutoffs: Cutoffs,
    dataset: str = "val",
    alias: str = CHAMPION,
    min_gain: float = 0.0,
    k: int = TOP_K,
) -> Decision:
    """Compare a candidate with the version that carries the alias, and move the alias if it gains enough.

    Both are scored on the customers of the same truth window. A candidate passes if its MAP exceeds
    the champion's by more than ``min_gain``, or if there is no champion and it was evaluated on
    anybody. The move names the champion it was compared with: if another deployment has moved the
    alias meanwhile, this one changes nothing and says so.
    """
    champion = registry.current(name, alias)

    versions = [registry.model(name, v, sources) for v in {candidate, champion} - {None}]
    report = evaluate_versions(versions, transactions, customer_features, cutoffs, dataset, k)
    scores = {int(r[0]): r[1] for r in report.select("model_version", f"map_at_{k}").collect()}
    ours, theirs = (None if scores.get(v) is None else round(scores[v], SCORE_DIGITS) for v in (candidate, champion))
    if ours is None:
        return Decision(name, candidate, champion, ours, theirs, False, False, "nobody to evaluate it on")
    if theirs is not None and not ours > theirs + min_gain:
        return Decision(name, candidate, champion, ours, theirs, False, False, "not better than the champion")
    reason = "first version" if champion is None else f"gains over version {champion}"
    try:
        registry.set_alias(name, alias, candidate, champion, reason)
    except AliasMoved:
        return Decision(name, candidate, champion, ours, theirs, True, False, "the alias was moved meanwhile")
    return Decision(name, candidate, champion, ours, theirs, True, True, reason)
