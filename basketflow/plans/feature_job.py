"""The feature job: customer and article features of one reference date as keyed tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from basketflow.functions.dates import PURCHASE_DAY
from basketflow.operators import features
from basketflow.operators.filters import between_dates
from basketflow.session import materialize, scratch_scope
from basketflow.sources.keyed import write_feature_table


def build_features(tables: dict[str, DataFrame], reference: dt.date | str, out: str) -> dict[str, DataFrame]:
    """Write both feature tables from the purchases up to the reference date.

    Purchases are shuffled once, to (customer, article) pairs; both tables start from those.
    """
    known = between_dates(tables["transactions"], PURCHASE_DAY, end=reference)
    with scratch_scope(known.sparkSession, "features"):
        pairs = materialize(features.pair_windows(known, reference), "pair-windows")
        customers = features.customer_feature_set(pairs, tables["customers"], reference, paired=True)
        articles = features.article_feature_set(pairs, tables["articles"], reference, paired=True)
        return {
            "customer_features": write_feature_table(customers, f"{out}/customer_features", ["customer_id"]),
            "article_features": write_feature_table(articles, f"{out}/article_features", ["article_id"]),
        }
