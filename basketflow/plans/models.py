"""Fitting the recommenders on training purchases and applying them to customers.

A fitted model is a small written table, read by every later step: popularity (one short list), age
rules (one short list per age group), next item (one short list per article).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.config import DECAY, RECENT_DAYS, TOP_K, BlendWeights
from basketflow.functions.dates import PURCHASE_DAY
from basketflow.operators import recommend
from basketflow.operators.filters import between_dates
from basketflow.session import materialize


def fit(
    transactions: DataFrame,
    segments: DataFrame,
    reference: dt.date | str,
    n_days: int = RECENT_DAYS,
    alpha: float = DECAY,
    top_k: int = TOP_K,
) -> dict[str, DataFrame]:
    """Model tables from the purchases up to the reference date; later ones are not looked at."""
    known = between_dates(transactions, PURCHASE_DAY, end=reference)
    popularity = recommend.decayed_popularity(known, reference, n_days, alpha)
    return {
        "popularity": materialize(recommend.top_popular(popularity, top_k), "popularity-model"),
        "age_rules": materialize(
            recommend.segment_top_n(known, segments, reference, n_days, top_k), "age-rules-model"
        ),
        "next_item": materialize(recommend.transitions(known, top_k), "next-item-model"),
    }


def predict(
    fitted: dict[str, DataFrame],
    segments: DataFrame,
    transactions: DataFrame,
    reference: dt.date | str,
    top_k: int = TOP_K,
) -> dict[str, DataFrame]:
    """Lists of every base model: for all customers, those with a known age, those with purchases.

    A customer's last purchase is that up to the reference date, as in ``fit``.
    """
    known = between_dates(transactions, PURCHASE_DAY, end=reference)
    return {
        "popularity": recommend.popularity_predict(segments, fitted["popularity"], top_k),
        "age_rules": recommend.age_rules_predict(segments, fitted["age_rules"]),
        "next_item": recommend.next_item_recommend(known, fitted["next_item"]),
    }


def predict_with_ensemble(
    fitted: dict[str, DataFrame],
    segments: DataFrame,
    transactions: DataFrame,
    reference: dt.date | str,
    weights: BlendWeights = BlendWeights(),
) -> DataFrame:
    """Lists of the base models and their blend in one written table with model_name."""
    lists = predict(fitted, segments, transactions, reference)
    # All customers of the segments have the popular list: it needs no join.
    popular = recommend.popular_list(fitted["popularity"])
    lists["ensemble"] = recommend.ensemble_blend(lists, weights, for_all={"popularity": popular})
    out = None
    for name, df in lists.items():
        named = df.select("customer_id", "predicted_articles", F.lit(name).alias("model_name"))
        out = named if out is None else out.unionByName(named)
    return materialize(out, "predictions")
