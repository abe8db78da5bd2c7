"""Helpers shared by the operators on texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from basketflow.session import materialize

# Texts that a task works on at a time; one longer text is worked on alone.
SHARD_BYTES = 2 << 20

# Texts sent to Python at a time: several copies of a batch exist on either side, for every core. Left
# alone where the session sets its own.
BATCH_BYTES = 8 << 20
_BATCH_BYTES, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", f"{64 << 20}b"

# Takes the texts of a shard as UTF-8, gives the values of each result field.
Handler = Callable[[list[bytes]], list[list]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import this package too, wherever the driver was started.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    if spark.conf.get(_BATCH_BYTES, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_BYTES, f"{BATCH_BYTES}b")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct: nothing an operator adds can clash with a name inside."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def utf8(column: str) -> Column:
    """A text as bytes, a missing one as no bytes."""
    return F.coalesce(F.col(f"`{column}`").cast("string").cast("binary"), F.lit(b""))


def shards(column: pa.Array, limit: int = SHARD_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes, or of one row."""
    sizes = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(sizes, sizes[start] + limit, "right")) - 1)
        yield start, stop
        start = stop


def annotate(
    rows: DataFrame, text: str, fields: str, make: Callable[[], Handler], keep: list[str] | None = None
) -> DataFrame:
    """Add ``fields`` to ``rows``, computed from whole texts by Arrow batches, without a shuffle.

    The result has a struct column ``doc`` with the columns in ``keep`` (by default all), followed by
    the fields. ``make`` runs once in each task and returns the handler of its shards. A missing text
    counts as empty. Each text is sent once, and sent back only if it is kept.
    """
    keep = rows.columns if keep is None else keep
    used = [c for c in rows.columns if c in keep or c == text]
    doc = F.struct(*[F.col(f"`{c}`") for c in used])
    sent = rows.select(doc.alias("doc"))
    kept = T.StructType([f for f in sent.schema["doc"].dataType.fields if f.name in keep])
    added = T.StructType.fromDDL(fields)
    schema = T.StructType([T.StructField("doc", kept, False), *added.fields])
    types = [f.type for f in to_arrow_schema(added)]
    at, others = used.index(text), [i for i, c in enumerate(used) if c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle = make()
        for batch in batches:
            docs = batch.column("doc")
            bodies = docs.field(at).cast(pa.binary())
            if len(others) < len(used):
                docs = pa.StructArray.from_arrays([docs.field(i) for i in others], names=[used[i] for i in others])
            for start, stop in shards(bodies):
                values = handle([t or b"" for t in bodies.slice(start, stop - start).to_pylist()])
                arrays = [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(values, types, strict=True)]
                yield pa.RecordBatch.from_arrays([docs.slice(start, stop - start), *arrays], schema.names)

    return sent.mapInArrow(run, schema)


def heavy_hash(*columns: Column | str) -> Column:
    """A non-negative 62-bit hash of a row's values, the same on every run."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 2)


def held_out(doc_id: str, folds: int = 5) -> Column:
    """Whether a row is kept out of training: CRC-32 of its id as text, in the fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of the links (a, b): one row (node, root) for each linked node.

    Every round lets each node join the neighbour, or itself, that has the least random rank, and
    contracts the links accordingly; about half of the nodes go away each time. Ranks are hashes of
    node and round, so that chains shrink as fast as stars. A node of any degree costs one partial
    minimum, and rounds are written tables: no driver, task or list ever holds a component.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    links = materialize(edges.filter("a != b").select(low, high).distinct(), f"{label}-links")
    moves: list[DataFrame] = []
    while not links.isEmpty():
        rank = F.struct(F.xxhash64(F.lit(len(moves)), "to").alias("rank"), F.col("to"))
        ends = links.select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.col(x).alias("node"), F.col(y).alias("to"))
                        for x, y in (("a", "a"), ("a", "b"), ("b", "a"), ("b", "b"))
                    ]
                )
            ).alias("e")
        ).select("e.*")
        move = materialize(ends.groupBy("node").agg(F.min(rank).alias("m")).select("node", "m.to"), f"{label}-moves")
        moves.append(move)
        for end in ("a", "b"):
            links = links.join(move.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("to", end)
        links = materialize(links.filter("a != b").select(low, high).distinct(), f"{label}-links")
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    last = moves[-1].withColumnRenamed("to", "root")
    for move in reversed(moves[:-1]):
        onward = last.withColumnRenamed("node", "to")
        last = move.join(onward, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    return materialize(last, f"{label}-roots")
