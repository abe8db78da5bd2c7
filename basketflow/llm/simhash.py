"""Near duplicates by 64-bit SimHash, linked where fingerprints differ in few bits.

Equal fingerprints are one from the start. For the links between different ones, a fingerprint is cut
into twice as many blocks as bits may differ: two fingerprints within that distance agree in at least
half of the blocks, so they meet in one of the tables keyed by half of the blocks. With 8 blocks and
4 bits a key has 32 bits, and rows that meet by chance stay rare for billions of fingerprints.

Inside the tables, pivots choose the pairs: each fingerprint's Hamming distances to many reference
fingerprints are worked out once, and by the triangle inequality a pair whose distances to any of them
differ by more than the limit is no link. Groups are put in the order of these distances, so that such
pairs are never formed: a row meets the rows in windows of near distances only. The bits of the others
are compared. Pivots without the tables would be no choice: distances to any reference crowd around
32, so that the cells of a distance table hold a fixed share of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.common import annotate, components, table, whole_row
from basketflow.session import materialize

BITS = 64
SHINGLE = 4
SEED = 42
MAX_BITS = 4
# Reference fingerprints, and those of them that a large group is ordered by.
PIVOTS = 16
ORDERING = 2
# Rows of a group that one pivot orders, rows of the largest group a task compares alone, pairs looked at together.
SMALL_GROUP = 128
LARGE_GROUP = 16_384
CHUNK_PAIRS = 1 << 18


def shingle_hashes(text: bytes, size: int = SHINGLE) -> list[int]:
    """Hashes of all runs of ``size`` words, or of all words of a shorter text; repeats included."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    stops = np.cumsum([len(w) + 1 for w in words]) - 1
    first = np.concatenate([[0], stops[:-1] + 1])
    last = stops[min(size, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(first[: len(last)].tolist(), last.tolist(), strict=True)]


def fingerprints(texts: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """One unsigned number per text: bit i is set if it is in over half of the shingle hashes."""
    out = np.zeros(len(texts), np.uint64)
    weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    for i, text in enumerate(texts):
        hashes = np.array(shingle_hashes(text, size), "<u8")
        if len(hashes):
            ones = np.zeros(BITS, np.int64)
            for at in range(0, len(hashes), 1 << 16):
                part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
                ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[i] = weights[2 * ones > len(hashes)].sum()
    return out


def with_fingerprints(
    docs: DataFrame, text: str = "text", size: int = SHINGLE, keep: list[str] | None = None
) -> DataFrame:
    """``doc`` (the columns of a row, or those in ``keep``) with ``print``, the fingerprint as a signed number.

    A text without words (missing, empty or white space) has fingerprint 0.
    """

    def make():
        return lambda texts: [pa.array(fingerprints(texts, size).view(np.int64))]

    return annotate(docs, text, "print long", make, keep)


def _tables(blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Shift of each block's bits and, per table, the blocks of its key."""
    edges = np.linspace(0, BITS, blocks + 1).astype(int)
    masks = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    chosen = list(combinations(range(blocks), blocks - blocks // 2))
    return np.array(masks, np.uint64), np.array([sum(masks[b] for b in c) for c in chosen], np.uint64)


def _spread(batches: Iterator[pa.RecordBatch], masks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each fingerprint once per table, with a hash of table and key bits."""
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for number, mask in enumerate(masks):
            key = _mixed((prints & mask) ^ _mixed(np.full(1, number + 1, np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0)], ["key", "print"])


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    for multiplier in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(multiplier)
    return x ^ (x >> np.uint64(31))


def pivot_prints(count: int = PIVOTS) -> np.ndarray:
    return _mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _pairs(first: np.ndarray, stop: np.ndarray, row: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every row with each place of its window, some ``CHUNK_PAIRS`` pairs at a time."""
    length = np.maximum(stop - first, 0)
    row, first, length = row[length > 0], first[length > 0], length[length > 0]
    ends = np.cumsum(length)
    at = 0
    while at < len(row):
        done = ends[at - 1] if at else 0
        until = max(at + 1, int(np.searchsorted(ends, done + CHUNK_PAIRS, "right")))
        n = length[at:until]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(row[at:until], n), np.repeat(first[at:until], n) + inside
        at = until


def _windows(group: np.ndarray, distance: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the places (first, stop) of the rows behind it in its group with a distance near its own.

    Rows come ordered by group and distance.
    """
    near = group * (2 * BITS) + distance
    return np.arange(len(group)) + 1, np.searchsorted(near, near + limit, "right")


def _cells(distance: np.ndarray, limit: int) -> Iterator[tuple[int, int, int, int]]:
    """(first, stop, from, until): rows of equal distances to all pivots, and rows to compare them with.

    Rows of one group come ordered by their distances, so that a cell's partners are a few windows of
    rows that lie together; what is farther away than ``limit`` in any distance is in none of them.
    Every two cells meet once, a cell's own rows meet in its first window.
    """
    columns = [c.astype(np.int64) for c in distance.T]

    def code(parts: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(parts[0]), np.int64)
        for c in parts:
            # Room for distances of up to BITS and the limit on either side.
            out = out * (BITS + 2 * limit + 2) + c + limit
        return out

    places = code(columns)
    first = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
    stop = np.append(first[1:], len(places))
    cells = [c[first] for c in columns]
    windows = []
    for steps in product(*[range(-limit, limit + 1)] * (len(columns) - 1)):
        leading = next((x for x in steps if x), 0)
        if leading < 0:
            continue
        near = [c + x for c, x in zip(cells, steps)]
        low, high = (code([*near, cells[-1] + x]) for x in (-limit, limit))
        start = np.searchsorted(places, low, "left") if leading else first
        windows.append((start, np.searchsorted(places, high, "right")))
    for i in range(len(first)):
        for start, until in windows:
            if start[i] < until[i]:
                yield int(first[i]), int(stop[i]), int(start[i]), int(until[i])


def _order(key: np.ndarray, distance: np.ndarray, prints: np.ndarray) -> np.ndarray:
    return np.lexsort([prints, *distance.T[::-1], key])


def _linked(
    key: np.ndarray, prints: np.ndarray, limit: int, pivots: np.ndarray, counted: list[int] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between rows of equal key; rows come ordered by key.

    Groups are put in order of their rows' distances to pivots, small ones by one pivot, large ones by
    the two to which their distances vary most; only pairs whose distances to these differ by at most
    ``limit`` are formed, and of these the bits are compared. ``counted`` is told how many were formed.
    """
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(begins, len(key)))
    counted = [0] if counted is None else counted
    forest: list[tuple[np.ndarray, np.ndarray]] = []
    small = np.repeat(sizes <= SMALL_GROUP, sizes)
    if small.any():
        number, own = np.repeat(np.arange(len(sizes)), sizes)[small], prints[small]
        distance = np.bitwise_count(own[:, None] ^ pivots[:1]).astype(np.int8)
        order = _order(number, distance, own)
        own, found = own[order], _Forest(len(own))
        first, stop = _windows(number[order], distance[order, 0].astype(np.int64), limit)
        for a, b in _pairs(first, stop, np.arange(len(own))):
            counted[0] += len(a)
            near = np.bitwise_count(own[a] ^ own[b]) <= limit
            found.add(a[near], b[near])
        forest.append((own[found.ones], own[found.others]))
    for at, n in zip(begins[sizes > SMALL_GROUP].tolist(), sizes[sizes > SMALL_GROUP].tolist()):
        own = prints[at : at + n]
        distance = np.bitwise_count(own[:, None] ^ pivots).astype(np.int8)
        best = np.argsort(-np.var(distance.astype(np.float32), axis=0), kind="stable")[:ORDERING]
        order = _order(np.zeros(n, np.int8), distance[:, best], own)
        own, found = own[order], _Forest(n)
        for first, stop, start, until in _cells(distance[order][:, best], limit):
            # Some rows of the cell at a time, with all of the window.
            step = max(1, CHUNK_PAIRS // (until - start))
            for row in range(first, stop, step):
                rows = own[row : min(row + step, stop)]
                counted[0] += len(rows) * (until - start)
                near = np.flatnonzero(np.bitwise_count(rows[:, None] ^ own[start:until]) <= limit)
                found.add(row + near // (until - start), start + near % (until - start))
        forest.append((own[found.ones], own[found.others]))
    ones, others = (np.concatenate(x) for x in zip(*forest))
    return ones.view(np.int64), others.view(np.int64)


class _Forest:
    """Links that connect what was not connected before."""

    def __init__(self, rows: int):
        self.label = np.arange(rows)
        self.ones: list[int] = []
        self.others: list[int] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        apart = self.label[a] != self.label[b]
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        pair = np.sort(np.stack([self.label[a], self.label[b]]), axis=0)
        _, one = np.unique(pair[0] * len(self.label) + pair[1], return_index=True)
        parent: dict[int, int] = {}
        for i, j, x, y in zip(a[one].tolist(), b[one].tolist(), pair[0][one].tolist(), pair[1][one].tolist()):
            x, y = _root(parent, x), _root(parent, y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                self.ones.append(i)
                self.others.append(j)
        to = np.arange(len(self.label))
        for x in parent:
            to[x] = _root(parent, x)
        self.label = to[self.label]


def _root(parent: dict[int, int], x: int) -> int:
    while x in parent:
        x = parent[x]
    return x


def _links(batches: Iterator[pa.RecordBatch], limit: int, pivots: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) inside the groups of equal key; a group may continue in the next batch.

    Rows of a group of more than ``most`` rows are handed on as (key, print) instead.
    """
    kept, passing = [np.zeros(0, np.int64), np.zeros(0, np.int64)], None
    for batch in batches:
        key, prints = (
            np.concatenate([k, c.to_numpy(zero_copy_only=False)]) for k, c in zip(kept, batch.columns, strict=True)
        )
        cut = int(np.searchsorted(key, key[-1], "left")) if len(key) else 0
        yield from _found(key[:cut], prints[:cut], limit, pivots, passing, most)
        kept = [key[cut:], prints[cut:]]
        if len(kept[0]) > most:
            passing = int(kept[0][0])
            yield _handed_on(*kept)
            kept = [key[:0], prints[:0]]
    yield from _found(*kept, limit, pivots, passing, most)


def _handed_on(key: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    nothing = pa.nulls(len(key), pa.int64())
    return pa.RecordBatch.from_arrays([nothing, nothing, pa.array(key), pa.array(prints)], ["a", "b", "key", "print"])


def _found(
    key: np.ndarray, prints: np.ndarray, limit: int, pivots: np.ndarray, passing: int | None, most: int
) -> Iterator[pa.RecordBatch]:
    same = np.append(False, key[1:] == key[:-1])
    grouped = same | np.append(same[1:], False)[: len(same)]
    if passing is not None:
        # The rest of a group whose other rows were handed on.
        rest = key == passing
        if rest.any():
            yield _handed_on(key[rest], prints[rest])
            grouped &= ~rest
    if len(key) and grouped.any():
        sizes = np.unique(key[grouped], return_counts=True)
        large = grouped & np.isin(key, sizes[0][sizes[1] > most])
        if large.any():
            yield _handed_on(key[large], prints[large])
            grouped &= ~large
        a, b = _linked(key[grouped], prints[grouped].view(np.uint64), limit, pivots)
        nothing = pa.nulls(len(a), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), nothing, nothing], ["a", "b", "key", "print"])


def _meetings(large: DataFrame, most: int) -> DataFrame:
    """(key, low, high, print): the rows of large groups in parts, every two parts of a group together."""
    sizes = large.groupBy("key").agg(F.ceil(F.count(F.lit(1)) * 2 / F.lit(most)).cast("int").alias("parts"))
    # A group here has over ``most`` rows: there are few of them for their rows.
    dealt = large.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("print", F.lit(1)), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    met = dealt.select("key", "print", "part", other)
    return met.select("key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "print")


def _met(batches: Iterator[pa.RecordBatch], limit: int, pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Links of the rows of each meeting; meetings are bounded and come one after the other."""
    def flush(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        prints = np.concatenate(parts).view(np.uint64)
        a, b = _linked(np.zeros(len(prints), np.int64), prints, limit, pivots)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    now, held = None, []
    for batch in batches:
        key, low, high, prints = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(key):
            continue
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(key)]):
            meeting = (key[a], low[a], high[a])
            if held and meeting != now:
                yield from flush(held)
                held = []
            now = meeting
            held.append(prints[a:b])
    if held:
        yield from flush(held)


def print_links(distinct: DataFrame, limit: int = MAX_BITS, pivots: int = PIVOTS, most: int = LARGE_GROUP) -> DataFrame:
    """Links (a, b) between different fingerprints that differ in at most ``limit`` bits.

    Not all of them: a spanning forest per group of equal key, which connects the same fingerprints.
    A group of more than ``most`` rows is dealt out in parts, every two of which meet in a task.
    """
    _, masks = _tables(2 * limit)
    references = pivot_prints(pivots)
    spread = distinct.select("print").mapInArrow(lambda b: _spread(b, masks), "key long, print long")
    dealt = spread.repartition("key").sortWithinPartitions("key")
    found = dealt.mapInArrow(lambda b: _links(b, limit, references, most), "a long, b long, key long, print long")
    found = materialize(found, "print-links")
    links, large = found.filter("a is not null").select("a", "b"), found.filter("a is null").select("key", "print")
    if large.isEmpty():
        return links
    meetings = _meetings(large, most).repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return links.unionByName(meetings.mapInArrow(lambda b: _met(b, limit, references), "a long, b long"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, limit: int = MAX_BITS
) -> DataFrame:
    """One row (doc_id, print, component_id) per document.

    ``component_id`` is the least id that can be reached over links of at most ``limit`` bits, the
    document itself included; equal fingerprints are linked. Texts without words share fingerprint 0
    and are linked like any other. A missing id never is a component's name unless all ids in it are
    missing. Rows with the same id each give a row. An empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = with_fingerprints(rows, "text", size, ["doc_id"]).select("doc.doc_id", "print")
    prints = materialize(prints, "prints")
    return prints.join(_components(prints, limit), "print").select("doc_id", "print", "component_id")


def _components(prints: DataFrame, limit: int) -> DataFrame:
    """(print, root, component_id) of each fingerprint."""
    distinct = materialize(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-prints")
    joined = components(print_links(distinct, limit), "print-links").withColumnRenamed("node", "print")
    named = distinct.join(joined, "print", "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return materialize(named.join(least, "root").select("print", "root", "component_id"), "print-components")


def _one_of(rows: DataFrame, group: str) -> DataFrame:
    """The ``doc`` of one row of each group, the least by a hash of its values."""
    return rows.groupBy(group).agg(F.min_by("doc", F.xxhash64("doc")).alias("doc")).select("doc")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = MAX_BITS) -> DataFrame:
    """The documents whose id names their group, with their columns: one of each group stays.

    Rows are judged one by one, also where an id repeats: of a group's rows with its name one stays,
    the least by a hash of the values, and rows of that id in other groups are judged there. Of a
    group in which no row has an id one row stays, too.
    """
    own_id = F.col(f"`{doc_id}`")
    rows = docs.select(own_id.alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = materialize(with_fingerprints(rows, keep=["doc_id"]).select("doc.doc_id", "print"), "prints")
    names = _components(prints, limit)
    named = F.count_if(F.col("doc_id") == F.col("component_id"))
    ids = prints.join(names, "print").groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("count"), named.alias("named"))
    kept = materialize(ids.filter("named > 0").select("id", "count"), "kept-documents")
    whole = docs.select(own_id.alias("id"), whole_row(docs).alias("doc"))
    # The kept ids grow with the documents: they are merged at every size, never broadcast.
    stay = whole.join(kept.filter("count = 1").hint("merge"), "id", "left_semi").select("doc")
    repeated = kept.filter("count > 1")
    if not repeated.isEmpty():
        several = whole.join(repeated, "id", "left_semi").select("doc.*")
        found = with_fingerprints(several, text).join(names, "print")
        found = found.filter(F.col("doc").getField(doc_id) == F.col("component_id"))
        stay = stay.unionByName(_one_of(found, "root"))
    unnamed = names.filter("component_id is null")
    if not unnamed.isEmpty():
        without = with_fingerprints(docs.filter(own_id.isNull()), text).join(unnamed, "print")
        stay = stay.unionByName(_one_of(without, "root"))
    return stay.select("doc.*")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
