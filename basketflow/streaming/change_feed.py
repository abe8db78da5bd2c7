"""Row changes between two snapshots of a keyed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def change_feed(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """insert, update and delete rows that turn ``before`` into ``after``.

    An update carries the new values, a delete the old ones. Values are compared null-safe, column
    by column, so a change is never missed by a hash collision.
    """
    values = [c for c in after.columns if c not in keys]
    old = before.select(*keys, F.struct(*values).alias("old"))
    new = after.select(*keys, F.struct(*values).alias("new"))
    kind = (
        F.when(F.col("old").isNull(), "insert")
        .when(F.col("new").isNull(), "delete")
        .when(~F.col("old").eqNullSafe(F.col("new")), "update")
    )
    changed = old.join(new, keys, "full").withColumn("change", kind).filter("change is not null")
    return changed.select(*keys, "change", F.coalesce("new", "old").alias("row")).select(*keys, "change", "row.*")


def apply_changes(before: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The later snapshot from the earlier one and its change rows."""
    kept = before.join(changes.select(*keys), keys, "left_anti")
    return kept.unionByName(changes.filter("change <> 'delete'").drop("change"))


def as_log(changes: DataFrame, version: Column, name: str = "version") -> DataFrame:
    """Change rows as a batch of a log: every row carries the version of the later snapshot."""
    return changes.withColumn(name, version)
