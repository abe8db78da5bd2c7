"""Incremental refresh of a keyed serving table from a growing folder of files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from basketflow.session import delete_folder, list_folder, replace_folder
from basketflow.sources.serving import ServingStore

BATCH, SNAPSHOT = "refresh", "snapshot"
# The column of a log that names the kind of change, and the kind that removes a key.
CHANGE, DELETED = "change", "delete"
# Batches that may wait to be merged; reads cost the snapshot and at most so many batches.
COMPACT_EVERY = 8


def latest_per_key(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The row with the highest version per key, combined before the shuffle; no sort, no window.

    Rows of equal version are told apart by a hash of their values, so the choice is the same on
    every run.
    """
    values = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*values), F.struct(*version, F.xxhash64(*values))).alias("row")
    return df.groupBy(*keys).agg(newest).select(*keys, "row.*")


def merge_log(log: DataFrame, keys: list[str], version: list[str], change: str = CHANGE) -> DataFrame:
    """The state after a log of insert, update and delete rows: the latest row per key, unless it is a delete.

    Works on any part of a log put together with the state before it, in any order of rows.
    """
    return latest_per_key(log, keys, version).filter(F.col(change) != DELETED).drop(change)


def start_refresh(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    keys: list[str],
    version: list[str],
    policy: str = "TRIGGERED",
    interval: str = "15 seconds",
    files_per_batch: int | None = None,
    compact_every: int = COMPACT_EVERY,
    change: str | None = None,
    keep_deletes: bool = False,
) -> StreamingQuery:
    """Feed new files of ``source`` into ``target``; TRIGGERED stops when it has caught up.

    With ``change`` the files are a log: that column says insert, update or delete. A delete is kept as
    a tombstone until the batch it came in is merged into the snapshot, or, with ``keep_deletes``, for
    good: a source whose rows may come after later ones of their key needs that, as an old row behind a
    forgotten delete would be taken for a new one.

    Each micro-batch reduces its rows to the latest per key and replaces the folder of its own batch
    number, so a batch that is replayed after a failure does not count twice. Every
    ``compact_every`` batches are merged into the snapshot, one row per key.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        done, waiting = _parts(spark, target)
        if number <= done:
            return
        latest_per_key(batch, keys, version).write.mode("overwrite").parquet(_folder(target, BATCH, number))
        if len({*waiting, number}) >= compact_every:
            compact(spark, target, schema, keys, version, change, keep_deletes)

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if policy.upper() == "CONTINUOUS":
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def _folder(target: str, kind: str, number: int) -> str:
    return f"{target}/{kind}-{number:012d}"


def _parts(spark: SparkSession, target: str) -> tuple[int, list[int]]:
    """The last batch inside the snapshot (-1 without one), and the batches after it."""
    found = [re.fullmatch(rf"({BATCH}|{SNAPSHOT})-(\d+)", name) for name in list_folder(spark, target)]
    numbers = {kind: [int(m[2]) for m in found if m and m[1] == kind] for kind in (BATCH, SNAPSHOT)}
    done = max(numbers[SNAPSHOT], default=-1)
    return done, sorted(n for n in numbers[BATCH] if n > done)


def refreshed(
    spark: SparkSession,
    target: str,
    schema: T.StructType,
    keys: list[str],
    version: list[str],
    change: str | None = None,
) -> DataFrame:
    """Current state of a refreshed table, one row per key: the snapshot and the batches after it.

    A log's state is without its deleted keys and the column ``change``.
    """
    rows = _latest(spark, target, schema, keys, version)
    return rows.filter(F.col(change) != DELETED).drop(change) if change else rows


def _latest(spark: SparkSession, target: str, schema: T.StructType, keys: list[str], version: list[str]) -> DataFrame:
    done, waiting = _parts(spark, target)
    folders = [_folder(target, BATCH, n) for n in waiting]
    if done >= 0:
        if not folders:
            return spark.read.schema(schema).parquet(_folder(target, SNAPSHOT, done))
        folders.append(_folder(target, SNAPSHOT, done))
    if not folders:
        return spark.createDataFrame([], schema)
    return latest_per_key(spark.read.schema(schema).parquet(*folders), keys, version).select(*schema.fieldNames())


def compact(
    spark: SparkSession,
    target: str,
    schema: T.StructType,
    keys: list[str],
    version: list[str],
    change: str | None = None,
    keep_deletes: bool = False,
) -> bool:
    """Merge the waiting batches into the snapshot; whether there were any. Tombstones go, unless kept.

    The new snapshot appears whole, by a rename, under the number of its last batch. Only then the
    batches and the snapshot before the last are deleted; readers of the last one can finish.
    """
    done, waiting = _parts(spark, target)
    if not waiting:
        return False
    staged = f"{target}/staged-{waiting[-1]:012d}"
    rows = _latest(spark, target, schema, keys, version)
    if change and not keep_deletes:
        rows = rows.filter(F.col(change) != DELETED)
    rows.write.mode("overwrite").parquet(staged)
    replace_folder(spark, staged, _folder(target, SNAPSHOT, waiting[-1]))
    for name in list_folder(spark, target):
        m = re.fullmatch(rf"({BATCH}|{SNAPSHOT})-(\d+)", name)
        if m and (int(m[2]) <= waiting[-1] if m[1] == BATCH else int(m[2]) < done):
            delete_folder(spark, f"{target}/{name}")
    return True


def refresh_serving(
    store: ServingStore,
    name: str,
    target: str,
    schema: T.StructType,
    keys: list[str],
    version: list[str],
    policy: str = "TRIGGERED",
    change: str | None = None,
    keep_deletes: bool = False,
) -> str:
    """Serve the current state of a refreshed table under ``name``, with its key checked."""
    compact(store.spark, target, schema, keys, version, change, keep_deletes)
    state = refreshed(store.spark, target, schema, keys, version, change)
    return store.publish(state, name, keys, skip_if_exists=False, policy=policy)
