"""Near duplicates among embeddings by p-stable hashing, with exact cosines for all that meet.

A normalised vector is projected on random directions; each projection, shifted and divided by a
width, is rounded down, and several of them together name a bucket. Vectors at a small Euclidean
distance mostly fall into the same bucket in at least one of several tables. A pair is counted in the
first table in which it meets, so no list of pairs is ever written: tasks give counts per vector and
a spanning forest of the links they found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.common import components, table
from basketflow.session import materialize

COSINE = 0.98
WIDTH = 2.0
# What the tables are made for: links that are found, and vectors of its label that one of a cosine of
# ``BACKGROUND`` to it meets by chance; the fewest projections and tables.
RECALL = 0.997
BACKGROUND = 0.5
MET_BY_CHANCE = 400
PROJECTIONS = 16
TABLES = 20
SEED = 20
# Vectors of a bucket that a task compares with as many others; larger buckets are dealt out.
CHUNK = 1024


def usable(vector: str) -> Column:
    """Whether a vector has a direction: some component is not 0, all are finite and present."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


@dataclass(frozen=True)
class Scheme:
    """So many tables, a bucket of which is named by so many projections."""

    tables: int = TABLES
    projections: int = PROJECTIONS


def same_cell(cosine: float, width: float = WIDTH) -> float:
    """The chance of two normalised vectors to have one rounded projection in common."""
    ratio = width / math.sqrt(max(2 - 2 * cosine, 1e-12))
    tail = math.erfc(ratio / math.sqrt(2))
    return 1 - tail - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))


def scheme(rows: int, cosine: float = COSINE, recall: float = RECALL) -> Scheme:
    """The fewest projections, and the tables that they need for ``recall`` at ``cosine``, with which
    ``rows`` vectors of one label and of cosine ``BACKGROUND`` to each other don't crowd the buckets.

    More rows need longer names, and these more tables to meet in: tables grow with a small power of
    the rows, and a vector's comparisons do not grow.
    """
    near, far = same_cell(cosine), same_cell(BACKGROUND)
    projections = PROJECTIONS
    while True:
        tables = max(TABLES, math.ceil(math.log(1 - recall) / math.log1p(-(near**projections))))
        if rows * far**projections * tables <= MET_BY_CHANCE:
            return Scheme(tables, projections)
        projections += 1


@cache
def _directions(size: int, plan: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """Directions for vectors of up to ``size`` components; shorter vectors use the first rows."""
    number = plan.tables * plan.projections
    shift = np.random.default_rng(SEED + 1).uniform(0, WIDTH, number)
    return np.random.default_rng(SEED).standard_normal((size, number)), shift


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Normalised vectors as rows, filled with zeros to the longest, and their lengths."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=1))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True)), sizes


def bucket_names(vectors: np.ndarray, sizes: np.ndarray, labels: np.ndarray, plan: Scheme = Scheme()) -> np.ndarray:
    """One number per vector and table: a hash of label, length and rounded projections."""
    along, shift = _directions(vectors.shape[1], plan)
    cells = np.floor((vectors @ along + shift) / WIDTH).astype(np.int64).view(np.uint64)
    cells = cells.reshape(len(vectors), plan.tables, plan.projections)
    name = np.broadcast_to(np.arange(1, plan.tables + 1, dtype=np.uint64), cells.shape[:2]).copy()
    for part in (labels.astype(np.int64).view(np.uint64), sizes.view(np.uint64)):
        name = _mixed(name ^ part[:, None])
    for i in range(plan.projections):
        name = _mixed(name ^ cells[:, :, i])
    return name.view(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A scrambling of 64-bit numbers that is not undone by the next part's exclusive or."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return (x ^ (x >> np.uint64(32))) + np.uint64(0x9E3779B97F4A7C15)


def _buckets(batches: Iterator[pa.RecordBatch], plan: Scheme) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            vectors, sizes = _matrix(batch.column("vector"))
            names = bucket_names(vectors, sizes, batch.column("label").to_numpy(zero_copy_only=False), plan)
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            for number in range(plan.tables):
                columns = [pa.array(names[:, number].copy()), pa.array(np.full(len(ids), number, np.int32)), pa.array(ids)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "number", "id"])


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches ordered by ``group``, cut so that no group is in two of them."""
    kept = None
    for batch in batches:
        batch = pa.concat_batches([kept, batch]) if kept is not None else batch
        if len(batch):
            group = batch.column("group").to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(group, group[-1], "left"))
            if cut:
                yield batch.slice(0, cut)
            kept = batch.slice(cut)
    if kept is not None and len(kept):
        yield kept


def _compare(batch: pa.RecordBatch, cosine: float, plan: Scheme) -> pa.RecordBatch:
    """Links found in the groups of a batch: per vector their number, and a spanning forest.

    Rows are compared with those 1, 2, 3, … places on, as long as their group lasts. A pair counts if
    it is of one label, meets in no earlier table, and joins the two parts that the group is for.
    """
    group, number, part, label, other, ids, copies = (
        batch.column(c).to_numpy(zero_copy_only=False)
        for c in ("group", "number", "part", "label", "other_label", "id", "copies")
    )
    one_part = batch.column("one_part").to_numpy(zero_copy_only=False)
    vectors, sizes = _matrix(batch.column("vector"))
    names = bucket_names(vectors, sizes, label, plan)
    begins = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    left = np.repeat(np.append(begins[1:], len(group)), np.diff(np.append(begins, len(group)))) - np.arange(len(group))
    earlier = np.arange(plan.tables) < number[:, None]
    links, tree = np.zeros(len(group), np.int64), np.arange(len(group))
    ones, others = [], []
    at, step = np.arange(len(group)), 1
    while len(at := at[left[at] > step]):
        b = at + step
        ok = (one_part[at] | (part[at] != part[b])) & (label[at] == label[b]) & (other[at] == other[b]) & (sizes[at] == sizes[b])
        a = at[ok & (number[at] == number[b])]
        a = a[np.einsum("ij,ij->i", vectors[a], vectors[a + step]) >= cosine]
        a = a[~((names[a] == names[a + step]) & earlier[a]).any(axis=1)]
        b = a + step
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        parent: dict[int, int] = {}
        for i in a[tree[a] != tree[b]].tolist():
            x, y = _root(parent, int(tree[i])), _root(parent, int(tree[i + step]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                ones.append(i)
                others.append(i + step)
        if parent:
            to = np.arange(len(group))
            for x in parent:
                to[x] = _root(parent, x)
            tree = to[tree]
        step += 1
    some = np.flatnonzero(links)
    a = np.concatenate([ids[some], ids[ones]])
    b = pa.array(np.concatenate([ids[some], ids[others]]))
    counted = np.concatenate([links[some], np.zeros(len(ones), np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(counted)], ["a", "b", "links"])


def _root(parent: dict[int, int], x: int) -> int:
    while x in parent:
        x = parent[x]
    return x


def _meetings(classes: DataFrame, chunk: int, plan: Scheme) -> DataFrame:
    """The vectors of each bucket that has several, in groups of at most two parts of the bucket.

    A bucket of more than ``chunk`` vectors has several parts; each two of them make a group, and so
    does each part alone. ``group`` names the group, ``one_part`` says whether it is one part alone.
    """
    buckets = classes.select("id", "label", "vector").mapInArrow(lambda b: _buckets(b, plan), "bucket long, number int, id long")
    buckets = materialize(buckets, "buckets")
    counts = buckets.groupBy("bucket").count().filter("count > 1")
    parts = counts.select("bucket", F.ceil(F.col("count") / chunk).cast("int").alias("parts"))
    members = buckets.join(parts, "bucket")
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    members = members.withColumn("part", part).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("part", "with"), F.greatest("part", "with")
    return members.select(
        "id", "number", "part", (F.col("part") == F.col("with")).alias("alone"),
        F.xxhash64("bucket", "number", low, high).alias("group"),
    )


def links(classes: DataFrame, cosine: float = COSINE, chunk: int = CHUNK) -> DataFrame:
    """(a, b, links): for a = b the links of a vector found in some group, else a link of a forest."""
    rows = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    plan = scheme(rows, cosine)
    meetings = _meetings(classes, chunk, plan)
    dealt = meetings.join(classes.select("id", "label", "other_label", "vector", "copies"), "id")
    dealt = dealt.withColumnRenamed("alone", "one_part").repartition("group").sortWithinPartitions("group", "id")

    def run(batches):
        for batch in _whole_groups(batches):
            yield _compare(batch, cosine, plan)

    return dealt.mapInArrow(run, "a long, b long, links long")


def _label_number(vectors: DataFrame, label: str, half: int) -> Column:
    """A label as two numbers: itself and 0 if it is an integer, else 128 bits of it."""
    if isinstance(vectors.schema[label].dataType, T.IntegralType):
        return F.col("label").cast("long") if half == 0 else F.lit(0).cast("long")
    return F.xxhash64(F.lit(half), "label")


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row (vec_id, n_links, component_id, kept) per vector.

    Labels may be of any type that Spark can hash. Vectors of equal label are linked if they meet in some table and their cosine, in double
    precision, is at least ``cosine``. Vectors without label, missing, zero, or with a missing or
    non-finite component link with nothing, nor do vectors of different lengths. Equal vectors of a
    label are compared once and count as often as they occur; each row gives a row. ``component_id``
    is the least id that links lead to; a missing id is that only if all are missing.
    """
    rows = vectors.select(
        F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"), F.col(f"`{label}`").alias("label")
    )
    valid = F.col("label").isNotNull() & usable("vector")
    # 128 bits name a vector together with its label.
    name = F.when(valid, F.struct(F.xxhash64("label", "vector").alias("x"), F.xxhash64(F.lit(1), "vector", "label").alias("y")))
    rows = rows.withColumn("name", name)
    classes = rows.filter("name is not null").groupBy("name").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"),
        F.first(_label_number(vectors, label, 0)).alias("label"), F.first(_label_number(vectors, label, 1)).alias("other_label"),
        F.first("vector").alias("vector"),
    )
    classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    found = materialize(links(classes, cosine, chunk), "links")
    counted = found.filter("a = b").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    joined = components(found.filter("a != b"), "vector-links").withColumnRenamed("node", "id")
    named = classes.select("id", "name", "least", "copies").join(joined, "id", "left").join(counted, "id", "left")
    named = named.withColumn("root", F.coalesce("root", "id"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    n_links = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    named = materialize(named.join(least, "root").select("name", n_links, "component_id"), "vector-components")
    out = rows.select("vec_id", "name").join(named, "name", "left")
    component = F.when(F.col("name").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


# All pairs of a label compared; the tables find 99.9 % of such links on large sets, all on small ones.
SQL = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), good AS (
    SELECT * FROM v
    WHERE label IS NOT NULL AND len(e) > 0 AND len([x for x in e if x IS NULL OR NOT isfinite(x)]) = 0
        AND len([x for x in e if x <> 0]) > 0
), link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {COSINE}
), reach AS (
    SELECT vec_id AS id, vec_id AS other FROM v UNION SELECT reach.id, link.b FROM reach JOIN link ON reach.other = link.a
), named AS (
    SELECT id, min(other) AS component_id FROM reach GROUP BY id
), counted AS (
    SELECT a AS id, count(*) AS n FROM link GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN named ON named.id = vec_id LEFT JOIN counted ON counted.id = vec_id
"""
