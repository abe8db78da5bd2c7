"""The recommenders fitted on the purchase events, for the queries that need their lists."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketflow.config import BlendWeights
from basketflow.operators import recommend
from basketflow.plans import models
from basketflow.registry.common import E_CUTS, Inputs

WEIGHTS = BlendWeights()


def popularity(x: Inputs) -> DataFrame:
    return recommend.decayed_popularity(x.e_train, E_CUTS.train)


def segment_lists(x: Inputs) -> DataFrame:
    return recommend.segment_top_n(x.e_train, x.segments, E_CUTS.train)


def fitted(x: Inputs) -> dict[str, DataFrame]:
    return models.fit(x.e, x.segments, E_CUTS.train)


def predictions_of(x: Inputs, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return models.predict(tables, x.segments, x.e, E_CUTS.train)


def base_predictions(x: Inputs) -> dict[str, DataFrame]:
    return predictions_of(x, fitted(x))


def all_predictions(x: Inputs) -> DataFrame:
    return models.predict_with_ensemble(fitted(x), x.segments, x.e, E_CUTS.train, WEIGHTS)
