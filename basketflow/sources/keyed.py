"""Keyed tables: key checks, feature tables, key lookups."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.operators.skew import lookup_join
from basketflow.session import delete_folder, replace_folder, scratch_dir
from basketflow.sources.files import read_table, write_version


class KeyViolation(ValueError):
    """A key column is null or a key repeats."""


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are null in part or occur more than once, with their number of rows."""
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_rows")).filter((F.col("num_rows") > 1) | has_null)


def check_key(df: DataFrame, keys: list[str]) -> None:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise KeyViolation(f"no such key column: {missing}")
    bad = key_violations(df, keys).head(1)
    if bad:
        raise KeyViolation(f"not a key {keys}: {bad[0].asDict()}")


def write_feature_table(df: DataFrame, name: str, keys: list[str], path: str | None = None) -> DataFrame:
    """Create or replace a feature table whose key is checked before any reader sees it.

    The rows are written once, sorted by key, beside the table; only if they have the key they take its place. After
    a ``KeyViolation`` the old table is as it was.
    """
    spark, df = df.sparkSession, sorted_by_key(df, keys)
    if "/" not in name:
        return write_version(df, name, path or f"{scratch_dir(spark)}/tables/{name}", lambda rows: check_key(rows, keys))
    staged = f"{name.rstrip('/')}.staged-{uuid.uuid4().hex}"
    try:
        df.write.parquet(staged)
        check_key(spark.read.parquet(staged), keys)
        replace_folder(spark, staged, name.rstrip("/"))
    finally:
        delete_folder(spark, staged)
    spark.catalog.refreshByPath(name)
    return read_table(spark, name)


# Keys that are handed to the scan of a feature table; the rows of more keys are found by a join alone.
KEYS_IN_SCAN = 1_000


def sorted_by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in ranges of the key, sorted inside: file statistics then leave out most of a table for few keys."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def _few_keys(features: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    """The feature rows that have some of few keys, selected inside the scan; all rows if the keys are many."""
    few = keys_df.select(*keys).distinct().limit(KEYS_IN_SCAN + 1).collect()
    if len(few) > KEYS_IN_SCAN:
        return features
    for k in keys:
        features = features.filter(F.col(k).isin([r[k] for r in few if r[k] is not None]))
    return features


def lookup_features(keys_df: DataFrame, features: DataFrame, keys: list[str], max_bytes: int | None = None) -> DataFrame:
    """Feature columns for the given keys; keys without features keep nulls.

    Few keys are handed to the scan of the feature table, so that no more of it is read and moved than
    holds them: most is left out of tables that ``write_feature_table`` wrote. Keys may repeat without
    limit: hot ones are dealt out, also those of several columns. A key that is missing in part finds
    nothing.
    """
    found = _few_keys(features, keys_df, keys)
    if len(keys) == 1:
        return lookup_join(keys_df, found, keys[0], "left", max_bytes=max_bytes)
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    key = F.when(whole, F.struct(*keys)).alias("_key")
    rows = keys_df.select("*", key)
    side = found.select(key, *[c for c in found.columns if c not in keys])
    joined = lookup_join(rows, side, "_key", "left", spread=[c for c in keys_df.columns if c not in keys] or keys, max_bytes=max_bytes)
    return joined.drop("_key").select(*keys, *[c for c in joined.columns if c not in [*keys, "_key"]])
