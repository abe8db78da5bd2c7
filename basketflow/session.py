"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN_SCRATCH: dict[str, str] = {}
_SCOPES: list[str] = []


def build_session(app: str, master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # One JVM holds driver and executors; a cluster's launcher sets its own memory.
            builder = builder.config("spark.driver.memory", "12g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for cut lineage and written snapshots.

    The cluster names it in ``spark.checkpoint.dir``. A local session without that setting gets a
    temporary folder; a cluster without it is an error, because a machine-local folder is lost
    with its machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _OWN_SCRATCH.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="basketflow-"))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else writes to, inside the innermost open scope."""
    top = _SCOPES[-1] if _SCOPES else f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}"
    return f"{top}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession, label: str = "scope") -> Iterator[str]:
    """A folder for the scratch tables written inside the block, deleted with them at its end.

    Frames built inside must be written elsewhere, or be done with, before it closes.
    """
    path = scratch_path(spark, label)
    _SCOPES.append(path)
    try:
        yield path
    finally:
        _SCOPES.remove(path)
        delete_folder(spark, path)


def _files(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def delete_folder(spark: SparkSession, path: str) -> None:
    store, place = _files(spark, path)
    store.delete(place, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder, none if it is not there."""
    store, place = _files(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(place)) if store.exists(place) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    store, place = _files(spark, path)
    out = store.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def file_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    store, place = _files(spark, path)
    stream = store.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename_folder(spark: SparkSession, path: str, target: str) -> bool:
    """Rename a folder; where one is already, it stays, and the outcome depends on the store."""
    store, place = _files(spark, path)
    _, new = _files(spark, target)
    store.mkdirs(new.getParent())
    return store.rename(place, new)


def replace_folder(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished folder in another's place: two renames, and the old one is deleted last.

    Between the renames there is no folder of that name for a moment: readers that may come then
    should read a catalog table, which is pointed at its new folder. On an object store a rename
    copies the files.
    """
    store, new = _files(spark, staged)
    _, place = _files(spark, target)
    _, old = _files(spark, f"{target}.old-{uuid.uuid4().hex}")
    had = store.exists(place)
    if had and not store.rename(place, old):
        raise OSError(f"could not move {target} aside")
    if not store.rename(new, place):
        if had:
            store.rename(old, place)
        raise OSError(f"could not put {staged} in place of {target}")
    if had:
        store.delete(old, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so that lost executors cost a re-read and not a recompute, and fixes values
    that depend on the physical layout (sort positions). Parquet rather than ``checkpoint()`` so
    that later steps still prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
