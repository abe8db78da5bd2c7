"""The splits job: training, validation and test purchases and both truth tables, written."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketflow.config import Cutoffs
from basketflow.operators.labels import temporal_split, truth_pairs
from basketflow.sources.files import read_by_month, write_by_month, write_table


def build_splits(transactions: DataFrame, cutoffs: Cutoffs, out: str) -> dict[str, DataFrame]:
    """Splits by month like the purchases themselves (which must have ``year_month``), truth as pairs.

    The truth tables hold (customer_id, article_id, copies): one row per pair however often bought.
    """
    spark = transactions.sparkSession
    tables = {}
    for name, rows in temporal_split(transactions, cutoffs).items():
        write_by_month(rows, f"{out}/{name}")
        tables[name] = read_by_month(spark, f"{out}/{name}")
    for name in ("val", "test"):
        pairs = truth_pairs(transactions, *cutoffs.truth_window(name))
        tables[f"{name}_truth"] = write_table(pairs, f"{out}/{name}_truth")
    return tables
