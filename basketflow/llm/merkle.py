"""Merkle manifest of a dataset: stored node rows with parent links, proved by a recursive query.

Documents are the leaves of one tree per group (source); the groups' subroots are the leaves of the
tree above. A node is the digest of up to three consecutive nodes below it. What is stored are node
rows at every sixth level: a row holds its digest, the siblings met on the way up to the row it links
to (its parent row), and that link. A Spark recursive query starts at the leaves, joins the parent
rows step by step, appends the siblings and folds the digest a document shows today. A document is
proved if its fold ends in the stored root.

Leaves are numbered by one global sort, so a group of any share is spread over tasks; building works
on runs of 729 nodes. A parent row that many leaves climb to is stored in copies, one per million
leaves, and leaves are dealt to them: no key of the climb's joins is hot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from basketflow.llm.common import table
from basketflow.operators.ordering import with_row_index
from basketflow.session import materialize

# Fixed values of the manifest: nodes under a node, and the fields a leaf covers, in order.
ARITY = 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

# Levels between stored rows, and the leaves that may climb to one copy of a row.
STRIDE = 6
COPY_ROWS = 1_000_000
_RUN = ARITY**STRIDE
_TOP = -1  # number of the tree over the groups
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"

_STORED = (
    "station int, path array<struct<left binary, right binary>>, top binary, "
    "p_tree long, p_station int, p_pos long, p_rows long"
)


@dataclass(frozen=True)
class Manifest:
    """The node rows, and among them the rows of the leaves, with what was kept of each document."""

    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def field(value: Column) -> Column:
    """A value as a leaf covers it: ``-`` if missing, else its length in bytes, a colon, its text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def as_hex(digest: str | Column) -> Column:
    return F.lower(F.hex(digest))


def _parent(nodes: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(nodes).hex().encode()).digest()


def _climb_run(nodes: list[bytes], levels: int) -> tuple[list[list[dict]], bytes]:
    """The siblings of every node of a run on each of the next levels, and the digest on top."""
    paths: list[list[dict]] = [[] for _ in nodes]
    width = 1
    for _ in range(levels):
        above = []
        for start in range(0, len(nodes), ARITY):
            three = nodes[start : start + ARITY]
            above.append(_parent(three))
            for i in range(len(three)):
                step = {"left": b"".join(three[:i]), "right": b"".join(three[i + 1 :])}
                first = (start + i) * width
                for path in paths[first : first + width]:
                    path.append(step)
        nodes, width = above, width * ARITY
    return paths, nodes[0]


def _build_station(current: DataFrame, station: int) -> DataFrame:
    """Stored rows of nodes (tree, pos, digest, rows, remaining levels, group leaves), run by run."""
    keep = [f for f in current.schema.fields if f.name != "run"]
    described = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep) + ", " + _STORED
    ends = T.StructType.fromDDL(described)
    types = to_arrow_schema(ends)

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.drop_columns(["run"]).sort_by("pos")
        tree, pos, remaining = (rows[c][0].as_py() for c in ("tree", "pos", "remaining"))
        paths, top = _climb_run(rows["digest"].to_pylist(), min(STRIDE, remaining))
        if remaining > STRIDE:
            parent = (tree, station + 1, pos // _RUN)
        else:
            parent = (None, None, None) if tree == _TOP else (_TOP, 0, tree)
        below = sum(rows["rows"].to_pylist())
        n = rows.num_rows
        columns = [[station] * n, paths, [top] * n, *([p] * n for p in parent), [below] * n]
        for name, values in zip(ends.names[len(keep) :], columns, strict=True):
            rows = rows.append_column(name, pa.array(values, types.field(name).type))
        return rows

    # Runs begin at multiples of their length, so threes inside a run are the threes of the level.
    cut = current.withColumn("run", F.floor(F.col("pos") / _RUN))
    return materialize(cut.groupBy("tree", "run").applyInArrow(run, ends), f"station-{station}")


def _levels(n: str) -> Column:
    """Levels above ``n`` nodes: the least d with 3^d >= n."""
    powers = F.array(*[F.lit(ARITY**k).cast("long") for k in range(39)])
    return F.size(F.filter(powers, lambda p: p < F.col(n)))


def _build_tree(current: DataFrame, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """Stations of one or many trees of at most ``depth`` levels, and the last row of each tree."""
    stations, tops = [], None
    for station in range(max(1, -(-depth // STRIDE))):
        built = _build_station(current, station)
        stations.append(built)
        first = built.filter(F.col("pos") % _RUN == 0)
        ended = first.filter(F.col("remaining") <= STRIDE).select("tree", F.col("top"), F.col("p_rows"))
        tops = ended if tops is None else tops.unionByName(ended)
        current = first.filter(F.col("remaining") > STRIDE).select(
            "tree",
            F.col("p_pos").alias("pos"),
            F.col("top").alias("digest"),
            F.col("p_rows").alias("rows"),
            (F.col("remaining") - STRIDE).alias("remaining"),
        )
    return stations, tops


def build(leaves: DataFrame) -> Manifest:
    """Manifest of the rows (key, group, leaf, and whatever else is to be kept with a leaf).

    Groups are ordered by their UTF-8 bytes, a missing group first; leaves inside a group by key, a
    missing key first, rows of one key by digest. Repeated rows are leaves of their own.
    """
    hashed = materialize(leaves, "leaves")
    order = [F.col("group").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("leaf")]
    rows = with_row_index(hashed, order, "row", 0)
    groups = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    groups = materialize(with_row_index(groups, [F.col("group").asc_nulls_first()], "tree", 0), "groups")
    n_groups, depth = groups.select("n", _levels("n").alias("d")).agg(F.count(F.lit(1)), F.max("d")).first()
    named = rows.alias("r").join(groups.alias("g"), F.col("r.group").eqNullSafe(F.col("g.group")))
    current = named.select(
        "r.*",
        "g.tree",
        (F.col("row") - F.col("first")).alias("pos"),
        F.col("leaf").alias("digest"),
        F.lit(1).cast("long").alias("rows"),
        _levels("n").alias("remaining"),
    )
    stations, tops = _build_tree(current, depth or 0)
    above = tops.select(
        F.lit(_TOP).cast("long").alias("tree"),
        F.col("tree").alias("pos"),
        F.col("top").alias("digest"),
        F.col("p_rows").alias("rows"),
        F.lit(n_groups).cast("long").alias("n"),
    ).withColumn("remaining", _levels("n"))
    height = next(d for d in range(64) if ARITY**d >= n_groups)
    upper, last = _build_tree(above.drop("n"), height)
    root = last.select(as_hex("top").alias("root")).first()
    stored = ["tree", "station", "pos", "digest", "rows", "path", "p_tree", "p_station", "p_pos", "p_rows"]
    nodes = stations[1:] + upper
    joined = nodes[0].select(*stored)
    for station in nodes[1:]:
        joined = joined.unionByName(station.select(*stored))
    copies = F.sequence(F.lit(0).cast("long"), _copies("rows") - 1)
    return Manifest(
        stations[0], materialize(joined.withColumn("copy", F.explode(copies)), "nodes"), root and root["root"]
    )


def _copies(rows: str) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.col(rows) / COPY_ROWS)).cast("long")


@contextmanager
def _unlimited_recursion(spark: SparkSession) -> Iterator[None]:
    """Spark stops a recursive query at a million rows unless told otherwise."""
    before = spark.conf.get(_ROW_LIMIT, None)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_ROW_LIMIT)
        else:
            spark.conf.set(_ROW_LIMIT, before)


_FOLD = """aggregate({n}.path, {hash}, (acc, s) ->
    unhex(sha2(concat(lower(hex(s.left)), lower(hex(acc)), lower(hex(s.right))), 256)))"""
_SIBLINGS = "aggregate({n}.path, {start}, (acc, s) -> concat(acc, s.left, s.right))"

CLIMB = f"""
WITH RECURSIVE climb(row, kept, folded, proof, subroot, p_tree, p_station, p_pos, copy) AS (
  SELECT row, kept, {_FOLD.format(n="l", hash="l.shown")}, {_SIBLINGS.format(n="l", start="X''")},
    CAST(NULL AS BINARY), p_tree, p_station, p_pos, pmod(row, CAST(greatest(1, ceil(p_rows / {COPY_ROWS})) AS BIGINT))
  FROM {{leaves}} l
  UNION ALL
  SELECT c.row, c.kept, {_FOLD.format(n="n", hash="c.folded")}, {_SIBLINGS.format(n="n", start="c.proof")},
    CASE WHEN n.tree = {_TOP} AND n.station = 0 THEN n.digest ELSE c.subroot END,
    n.p_tree, n.p_station, n.p_pos, pmod(c.row, CAST(greatest(1, ceil(n.p_rows / {COPY_ROWS})) AS BIGINT))
  FROM climb c JOIN {{nodes}} n
    ON c.p_tree = n.tree AND c.p_station = n.station AND c.p_pos = n.pos AND c.copy = n.copy)
SELECT kept.*, folded, proof, subroot FROM climb WHERE p_tree IS NULL
"""


def climb(manifest: Manifest, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every leaf with ``folded`` (the root that ``shown`` folds to), ``proof``
    (the digests of all siblings met, in order) and ``subroot``, as bytes."""
    kept = F.struct(*[F.col(c) for c in keep]).alias("kept")
    start = manifest.leaves.select("row", kept, "shown", "path", "p_tree", "p_station", "p_pos", "p_rows")
    spark = start.sparkSession
    with _unlimited_recursion(spark):
        return materialize(spark.sql(CLIMB, leaves=start, nodes=manifest.nodes), "climbed")


def verify(
    docs: DataFrame, shown: Column, doc_id: str = "doc_id", group: str = "source", fields: list[str] = FIELDS
) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of each row of ``docs``.

    ``shown`` is the digest a row shows when it is checked (``leaf_digest`` of its values then). A
    missing value counts as ``-``, unlike an empty one. The only row of a group is its subroot, the
    only row of a table its root, with an empty proof. An empty table gives an empty result.
    """
    leaves = docs.select(
        F.col(f"`{doc_id}`").alias("key"),
        F.col(f"`{group}`").cast("string").alias("group"),
        leaf_digest(*[F.col(f"`{c}`") for c in fields]).alias("leaf"),
        shown.alias("shown"),
    )
    manifest = build(leaves)
    root, found = F.lit(manifest.root).cast("string"), climb(manifest, ["key", "leaf"])
    return found.select(
        "key",
        as_hex("leaf").alias("leaf"),
        as_hex("subroot").alias("subroot"),
        root.alias("root"),
        F.sha2(as_hex("proof"), 256).alias("proof_sha256"),
        as_hex("folded").alias("folded_root"),
        (as_hex("folded") == root).alias("verified"),
    )


def tampered_text(doc_id: str, text: str) -> Column:
    """The contract's tampering: no line feeds where 2 divides the CRC-32 of the id as text."""
    body = F.col(f"`{text}`")
    hit = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 2 == 0
    return F.when(hit, F.replace(body.cast("string"), F.lit("\n"), F.lit(""))).otherwise(body)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    shown = leaf_digest(*[tampered_text("doc_id", "text") if c == "text" else F.col(c) for c in FIELDS])
    return verify(docs, shown).withColumnRenamed("key", "doc_id")


# CRC-32 by its byte table, for texts of ASCII.
_CRC_TABLE = """list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END))"""


def crc32_sql(text: str) -> str:
    """CRC-32 of a text of ASCII in DuckDB, with the column ``tab`` of the table ``crc`` in scope."""
    codes = f"list_transform(range(1, strlen({text}) + 1), lambda i: CAST(ascii(substr({text}, i, 1)) AS BIGINT))"
    step = "lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {codes}), {step}))"


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ["doc_id", "source", "lang", "n_chars", text]) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    """Levels of the trees over ``leaves`` (tree, pos, digest), and the siblings of each node."""
    return f"""
{name}(tree, level, pos, digest) AS (
  SELECT tree, 0, pos, digest FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}) WHERE n > 1 GROUP BY tree, level, pos // 3),
{name}_up AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3
  WHERE a.level < (SELECT max(level) FROM {name} t WHERE t.tree = a.tree) GROUP BY a.tree, a.level, a.pos)"""


SQL = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS tab),
marked AS (
  SELECT *, CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS shown_text
  FROM documents, crc),
hashed AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree, {_leaf_sql("text")} AS leaf,
    {_leaf_sql("shown_text")} AS shown FROM marked),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS digest FROM hashed),
{_tree_sql("low", "numbered")},
subroots AS (
  SELECT 0 AS tree, tree AS pos, arg_max(digest, level) AS digest FROM low GROUP BY tree),
{_tree_sql("high", "subroots")},
climb(doc_id, tree, leaf, start, level, pos, folded, proof) AS (
  SELECT doc_id, tree, leaf, pos, 0, pos, shown, '' FROM numbered
  UNION ALL
  SELECT doc_id, c.tree, leaf, start, c.level + 1, c.pos // 3, sha256(l || folded || r), proof || l || r
  FROM climb c JOIN low_up u ON c.tree = u.tree AND c.level = u.level AND c.pos = u.pos),
gone_up AS (SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY tree, start ORDER BY level DESC) = 1),
over_all(doc_id, tree, leaf, start, level, pos, folded, proof) AS (
  SELECT doc_id, tree, leaf, start, 0, tree, folded, proof FROM gone_up
  UNION ALL
  SELECT doc_id, c.tree, leaf, start, c.level + 1, c.pos // 3, sha256(l || folded || r), proof || l || r
  FROM over_all c JOIN high_up u ON c.level = u.level AND c.pos = u.pos),
ended AS (SELECT * FROM over_all QUALIFY row_number() OVER (PARTITION BY tree, start ORDER BY level DESC) = 1)
SELECT e.doc_id, e.leaf, s.digest AS subroot, r.root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root,
  e.folded = r.root AS verified
FROM ended e JOIN subroots s ON s.pos = e.tree, (SELECT arg_max(digest, level) AS root FROM high) r
"""
