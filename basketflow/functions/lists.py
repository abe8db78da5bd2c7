"""Ranked-list arithmetic on array columns, inside the row: no shuffle, no Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _first_k(ids: Column, k: int) -> Column:
    return F.slice(F.coalesce(ids, F.array()), 1, k)


def average_precision(actual: Column, predicted: Column, k: int) -> Column:
    """Average precision at ``k``; repeated predictions count once, repeated purchases in the divisor."""
    top = _first_k(predicted, k)
    hit_ranks = F.filter(
        F.transform(
            top,
            lambda p, i: F.when(F.array_contains(actual, p) & (F.array_position(top, p) == i + 1), i + 1),
        ),
        lambda rank: rank.isNotNull(),
    )
    return precision_from_ranks(hit_ranks, F.size(actual), k)


def precision_from_ranks(hit_ranks: Column, num_actual: Column, k: int) -> Column:
    """Average precision from the ascending 1-based ranks of the hits."""
    parts = F.transform(hit_ranks, lambda rank, i: (i + 1) / rank.cast("double"))
    total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(num_actual > 0, total / F.least(num_actual, F.lit(k))).otherwise(F.lit(0.0))


def blend(lists: list[tuple[Column, float]], k: int) -> Column:
    """Weighted reciprocal-rank fusion of ranked lists.

    Each list gives ``weight / rank`` to its first ``k`` ids, repeats add up. Equal scores keep the
    order in which the ids first appear, list after list.
    """

    def votes_of(ids: Column, weight: float) -> Column:
        def vote(article: Column, position: Column) -> Column:
            share = F.lit(weight) * (F.lit(1.0) / (position + 1))
            return F.struct(article.alias("id"), share.alias("vote"))

        return F.transform(_first_k(ids, k), vote)

    votes = F.flatten(F.array(*[votes_of(ids, weight) for ids, weight in lists]))
    ids = F.array_distinct(F.transform(votes, lambda v: v["id"]))
    scored = F.transform(
        ids,
        lambda a, i: F.struct(
            (
                -F.round(
                    F.aggregate(
                        F.filter(votes, lambda v: v["id"] == a),
                        F.lit(0.0),
                        lambda acc, v: acc + v["vote"],
                    ),
                    12,
                )
            ).alias("order"),
            i.alias("seen"),
            a.alias("id"),
        ),
    )
    return F.transform(F.slice(F.array_sort(scored), 1, k), lambda s: s["id"])


def pad_left(ids: Column, length: int, padding: int = 0) -> Column:
    """Last ``length`` ids, filled up with ``padding`` on the left."""
    kept = F.when(F.size(ids) > length, F.slice(ids, -length, length)).otherwise(ids)
    return F.concat(F.array_repeat(F.lit(padding).cast("long"), F.greatest(F.lit(length) - F.size(ids), F.lit(0))), kept)
