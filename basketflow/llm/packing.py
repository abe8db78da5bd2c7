"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

A document's ids, followed by the end id, stay together if they fit a sequence; longer ones are cut
into whole sequences, but for the first piece. What is left to pack are pieces shorter than a
sequence, at most one per document. They are ranked by length and dealt out in turn, so that every
shard of 8,192 has the lengths of the whole table and loses next to nothing to being packed alone.

Each shard is evolved on several islands. A member of a population is a whole packing. Crossover
injects well-filled sequences of one parent into the other, removes the sequences that hold a piece
twice, and best-fits the displaced pieces, longest first; mutation dissolves badly filled sequences.
After each epoch, an island's best member migrates to the next island through a shuffle. A shard that
has reached its lower bound is done. Epochs are written tables, and an island's random
numbers depend on shard, island and epoch only: a lost executor costs a repeated step.
"""

from __future__ import annotations

import json
import random
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from basketflow.llm.common import annotate, table
from basketflow.llm.token_counts import _COMMON, _common_pattern, byte_symbols, library_cut
from basketflow.llm.token_counts import Tokenizer as Tables
from basketflow.operators.ordering import with_row_index
from basketflow.session import materialize

# Fixed values of the packing.
CAPACITY = 1024
END_ID = 2

# Pieces packed together, islands of a shard, members of an island, and how long they evolve.
SHARD = 8192
ISLANDS = 3
MEMBERS = 6
EPOCHS = 3
GENERATIONS = 16
MOST_TASKS = 2_000

# Pre-tokens whose ids a worker remembers; characters of a text that are cut at a time.
REMEMBERED = 300_000
STRETCH = 1 << 20

_ENCODERS: dict[int, Encoder] = {}


def merges_by_rank(path: str) -> bool:
    """Whether merging the neighbours whose joined bytes have the least id gives the library's ids.

    The library only merges listed pairs. If merges are listed in the order of the ids they make, and
    every vocabulary string merges to itself alone, no unlisted pair is ever met: once all earlier
    merges are done, the bytes of a token stand as its listed pair, wherever they stand.
    """
    model, symbols = json.loads(Path(path).read_text(encoding="utf-8"))["model"], byte_symbols()
    made = [model["vocab"]["".join(pair)] for pair in model["merges"]]
    strings = [bytes(symbols[c] for c in t) for t in model["vocab"] if all(c in symbols for c in t)]
    return made == sorted(made) and set(Tables(path).merge(strings)) == {1} and not model.get("ignore_merges")


class Encoder(dict):
    """Ids of texts as the library gives them, as little-endian unsigned 32-bit numbers.

    Texts are cut into pre-tokens, which merges never cross; this dictionary holds the ids of those
    met so far, up to a bound. Strings of added tokens count wherever they stand, as is the library's
    default. ``by_rank`` (see ``merges_by_rank``) allows the faster of two ways to merge.
    """

    def __init__(self, file: str, by_rank: bool, remembered: int = REMEMBERED):
        super().__init__()
        self.library, self.limit = Tokenizer.from_str(file), remembered
        self.common = _common_pattern().findall
        self.added = {t.content: struct.pack("<I", i) for i, t in self.library.get_added_tokens_decoder().items()}
        names = "|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))
        self.special = re.compile(f"({names})") if names else None
        # Between a letter and a single space with a letter behind it there is always a cut.
        self.safe = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")
        self.merge = None
        if by_rank:
            symbols = byte_symbols()
            vocab = json.loads(file)["model"]["vocab"]
            plain = {t: i for t, i in vocab.items() if t not in self.added and all(c in symbols for c in t)}
            ranks = {bytes(symbols[c] for c in t): i for t, i in plain.items()}
            self.merge = tiktoken.Encoding("ranks", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        body = word.encode()
        found = self.merge(body) if self.merge else self.library.encode(word, add_special_tokens=False).ids
        ids = self[word] = struct.pack(f"<{len(found)}I", *found)
        return ids

    def _stretches(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > STRETCH and (cut := self.safe.search(text, start + STRETCH)):
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def _cut(self, text: str) -> list[str]:
        return (library_cut if text.encode().translate(None, _COMMON) else self.common)(text)

    def ids(self, text: str) -> bytes:
        out = []
        for stretch in self._stretches(text):
            parts = self.special.split(stretch) if self.special else [stretch]
            for i, part in enumerate(parts):
                out.append(self.added[part] if i % 2 else b"".join(map(self.__getitem__, self._cut(part))))
        return b"".join(out)


def _encoder(file: str, by_rank: bool) -> Encoder:
    """One encoder a worker, shared by its tasks."""
    key = zlib.crc32(file.encode())
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(file, by_rank)
    return _ENCODERS[key]


def cut_ids(ids: bytes, capacity: int) -> list[bytes]:
    """Whole sequences of ids, but for the first piece."""
    if len(ids) <= 4 * capacity:
        return [ids]
    first = len(ids) % (4 * capacity) or 4 * capacity
    return [ids[:first], *(ids[at : at + 4 * capacity] for at in range(first, len(ids), 4 * capacity))]


def encode(
    docs: DataFrame, path: str, text: str, keep: list[str], capacity: int, end_id: int, with_ids: bool
) -> DataFrame:
    """(doc, n_ids, pieces) of each document: its number of ids, and CRC-32 (and ids) of its pieces."""
    file = docs.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))
    by_rank = merges_by_rank(path)
    end = np.uint32(end_id).tobytes()

    def make() -> Callable:
        encoder = _encoder(file.value, by_rank)

        def handle(texts: list[bytes]) -> list[list]:
            counts, pieces = [], []
            for body in texts:
                ids = encoder.ids(body.decode("utf-8", "replace")) + end
                counts.append(len(ids) // 4)
                cut = cut_ids(ids, capacity)
                pieces.append([{"crc": zlib.crc32(p), "ids": p if with_ids else None} for p in cut])
            return [counts, pieces]

        return handle

    return annotate(docs, text, "n_ids long, pieces array<struct<crc long, ids binary>>", make, keep)


class Bins:
    """Open sequences by the room that is left in them, for best fit in a few steps."""

    def __init__(self, capacity: int):
        self.capacity, self.mask, self.by_room = capacity, 0, [[] for _ in range(capacity + 1)]

    def add(self, number: int, room: int) -> None:
        if not self.by_room[room]:
            self.mask |= 1 << room
        self.by_room[room].append(number)

    def best_fit(self, size: int) -> tuple[int | None, int]:
        """The sequence whose room exceeds ``size`` least, and what is left there; None if none has it."""
        fits = self.mask >> size
        if not fits:
            return None, self.capacity - size
        room = size + (fits & -fits).bit_length() - 1
        stack = self.by_room[room]
        number = stack.pop()
        if not stack:
            self.mask &= ~(1 << room)
        return number, room - size


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs.

    For each k: pieces over ``capacity - k`` share with none of at least k, and pieces over half a
    sequence not with each other; those of at least k fill the room beside the latter, then more.
    """
    count = np.bincount(sizes, minlength=capacity + 1)
    tokens = np.cumsum(count * np.arange(capacity + 1))
    pieces = np.cumsum(count)
    half = capacity // 2
    k = np.arange(half + 1)
    big = pieces[-1] - pieces[half]
    room = (pieces[capacity - k] - pieces[half]) * capacity - (tokens[capacity - k] - tokens[half])
    small = tokens[half] - np.append(0, tokens)[k]
    return int((big + np.maximum(0, -(-(small - room) // capacity))).max())


class Island:
    """A population of packings of one shard; a packing is the sequence number of every piece."""

    def __init__(self, sizes: np.ndarray, capacity: int, seed: int):
        self.sizes, self.capacity, self.random = sizes, capacity, random.Random(seed)
        self.bound = lower_bound(sizes, capacity)

    def place(self, packing: np.ndarray, pieces: list[int], fills: np.ndarray) -> np.ndarray:
        """Best-fit the pieces, in the order given, into the sequences of the others."""
        bins = Bins(self.capacity)
        for number, fill in enumerate(fills.tolist()):
            bins.add(number, self.capacity - fill)
        following, sizes = len(fills), self.sizes
        for piece in pieces:
            number, room = bins.best_fit(int(sizes[piece]))
            if number is None:
                number, following = following, following + 1
            bins.add(number, room)
            packing[piece] = number
        return packing

    def fills(self, packing: np.ndarray) -> np.ndarray:
        return np.bincount(packing, weights=self.sizes).astype(np.int64)

    def fitness(self, packing: np.ndarray) -> tuple[int, int]:
        """Few sequences first; of as many, unevenly filled ones, which leave room in one place."""
        fills = self.fills(packing)
        return -len(fills), int((fills * fills).sum())

    def fresh(self, noise: float) -> np.ndarray:
        """All pieces by best fit, longest first, their lengths blurred by ``noise``."""
        blurred = [(-s * (1 + noise * self.random.random()), i) for i, s in enumerate(self.sizes.tolist())]
        return self.place(np.full(len(self.sizes), -1, np.int64), [i for _, i in sorted(blurred)], np.zeros(0, np.int64))

    def _refill(self, packing: np.ndarray, free: np.ndarray, noise: float = 0.0) -> np.ndarray:
        """Number the sequences without the free pieces anew, and place those, longest first, blurred by ``noise``."""
        rest = ~free
        numbers, packing[rest] = np.unique(packing[rest], return_inverse=True)
        fills = np.bincount(packing[rest], weights=self.sizes[rest], minlength=len(numbers)).astype(np.int64)
        pieces = np.flatnonzero(free)
        blur = np.array([self.random.random() for _ in pieces]) if noise else 0.0
        order = pieces[np.argsort(-self.sizes[pieces] * (1 + noise * blur), kind="stable")]
        return self.place(packing, order.tolist(), fills)

    def cross(self, host: np.ndarray, donor: np.ndarray) -> np.ndarray:
        """Well-filled sequences of ``donor``, the sequences of ``host`` without their pieces, the rest refilled."""
        fills = self.fills(donor)
        best = np.argsort(-fills, kind="stable")[: max(1, len(fills) * 3 // 4)]
        chosen = np.zeros(len(fills), bool)
        chosen[[b for b in best.tolist() if self.random.random() < 0.5] or best[:1]] = True
        injected = chosen[donor]
        doubled = np.zeros(int(host.max()) + 1, bool)
        doubled[host[injected]] = True
        child = np.where(injected, donor + len(doubled), host)
        return self._refill(child, doubled[host] & ~injected)

    def mutate(self, packing: np.ndarray) -> np.ndarray:
        """Dissolve some of the worst filled sequences and some others."""
        fills = self.fills(packing)
        worst = np.argsort(fills, kind="stable")[: max(2, len(fills) // 50)]
        gone = np.zeros(len(fills), bool)
        gone[worst] = True
        gone[self.random.sample(range(len(fills)), min(len(fills), max(2, len(fills) // 20)))] = True
        return self._refill(packing.copy(), gone[packing], self.random.choice([0.0, 0.1]))

    def evolve(self, members: list[np.ndarray], generations: int, size: int) -> list[np.ndarray]:
        """The population after some generations, best first; a packing at the bound is enough."""
        ranked = sorted(((self.fitness(m), m) for m in members), key=lambda r: r[0], reverse=True)[:size]
        for _ in range(generations):
            if -ranked[0][0][0] <= self.bound or len(ranked) < 2:
                break
            host, donor = (min(self.random.sample(range(len(ranked)), 2)) for _ in range(2))
            child = self.cross(ranked[host][1], ranked[donor][1]) if host != donor else self.mutate(ranked[host][1])
            worth = self.fitness(child)
            if worth > ranked[-1][0] and worth not in [r[0] for r in ranked]:
                ranked = sorted([*ranked, (worth, child)], key=lambda r: r[0], reverse=True)[:size]
        return [m for _, m in ranked]


_ISLAND = "shard long, island int, sizes binary, members array<binary>"


def _island(shard: int, island: int, epoch: int, sizes: bytes, capacity: int) -> Island:
    return Island(np.frombuffer(sizes, "<i4").astype(np.int64), capacity, zlib.crc32(f"{shard}:{island}:{epoch}".encode()))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    return (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))


def _map(rows: DataFrame, work: Callable[[tuple], list[tuple]], schema: str) -> DataFrame:
    kind = T.StructType.fromDDL(schema)
    target = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            made = work(row)
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*made), target, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return rows.mapInArrow(run, kind)


def _evolved(islands: DataFrame, epoch: int, capacity: int, last: bool) -> DataFrame:
    """One epoch of every island: its population, and its best member on the way to the next island."""

    def work(row: tuple) -> list[tuple]:
        shard, island, sizes, members = row
        here = _island(shard, island, epoch, sizes, capacity)
        if epoch == 0:
            first = here.fresh(0.0)
            done = int(first.max()) + 1 <= here.bound
            population = [first] if done else [first, *(here.fresh(0.1 * k) for k in range(1, MEMBERS))]
            if island and not done:
                population = population[1:]
        else:
            population = [np.frombuffer(m, "<u2").astype(np.int64) for m in members]
        kept = [m.astype("<u2").tobytes() for m in here.evolve(population, GENERATIONS, MEMBERS)]
        if last:
            return [(shard, island, sizes, kept[:1])]
        return [(shard, island, sizes, kept), (shard, (island + 1) % ISLANDS, sizes, kept[:1])]

    return materialize(_map(islands, work, _ISLAND), "islands")


def _best(evolved: DataFrame, capacity: int) -> DataFrame:
    """(shard, packing): the best packing of all islands, by sequences, fill, then bytes."""

    def work(row: tuple) -> list[tuple]:
        shard, island, sizes, members = row
        here = _island(shard, island, 0, sizes, capacity)
        count, fill = here.fitness(np.frombuffer(members[0], "<u2").astype(np.int64))
        return [(shard, -count, -fill, members[0])]

    worth = _map(evolved, work, "shard long, bins long, fill long, packing binary")
    return worth.groupBy("shard").agg(F.min(F.struct("bins", "fill", "packing")).alias("m")).select("shard", "m.packing")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(row, sequence, offset) of each piece in (row, length): few sequences of at most ``capacity``.

    ``row`` is unique; lengths are from 1 to ``capacity``. Sequence numbers are not dense. No rows
    give no rows.
    """
    if not 0 < capacity < 1 << 16:
        raise ValueError("a sequence holds from 1 to 65,535 tokens")
    ranked = materialize(with_row_index(pieces, [F.col("length").desc(), F.col("row")], "rank", 0), "ranked")
    count = ranked.count()
    n_shards = max(1, -(-count // SHARD))
    dealt = ranked.select((F.col("rank") % n_shards).alias("shard"), F.struct("rank", "length", "row").alias("piece"))
    # At most SHARD pieces each: dealing by rank makes shards of equal size.
    shards = dealt.groupBy("shard").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    kind = "shard long, sizes binary, rows array<long>"

    def arrays(row: tuple) -> list[tuple]:
        shard, members = row
        return [(shard, np.array([m["length"] for m in members], "<i4").tobytes(), [m["row"] for m in members])]

    shards = materialize(_map(shards, arrays, kind), "shards")
    # Islands are long work on few bytes: as many tasks as there are, not as many as their bytes fill.
    tasks = min(n_shards * ISLANDS, MOST_TASKS)
    islands = shards.select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        "sizes",
        F.lit(None).cast("array<binary>").alias("members"),
    ).repartition(tasks, "shard", "island")
    for epoch in range(EPOCHS):
        evolved = _evolved(islands, epoch, capacity, epoch == EPOCHS - 1)
        met = F.array_sort(F.array_distinct(F.flatten(F.collect_list("members")))).alias("members")
        dealt = evolved.repartition(tasks, "shard", "island")
        islands = dealt.groupBy("shard", "island").agg(F.first("sizes").alias("sizes"), met)

    def places(row: tuple) -> list[tuple]:
        shard, sizes, rows, packing = row
        lengths, numbers = np.frombuffer(sizes, "<i4").astype(np.int64), np.frombuffer(packing, "<u2").astype(np.int64)
        order = np.argsort(numbers, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        begins = np.append(True, np.diff(numbers[order]) != 0)
        offset = before - before[np.flatnonzero(begins)[np.cumsum(begins) - 1]]
        return [(rows[i], shard << 16 | n, o) for i, n, o in zip(order.tolist(), numbers[order].tolist(), offset.tolist())]

    best = shards.join(_best(evolved, capacity), "shard").select("shard", "sizes", "rows", "packing")
    return materialize(_map(best, places, "row long, sequence long, offset long"), "packed")


def pack_documents(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) of every piece, ``ids`` if asked for.

    A missing or empty text has the end id only. Repeated rows are documents of their own. Sequence
    ids of whole sequences are negative. An empty table gives no rows.
    """
    found = encode(docs, path, text, [doc_id], capacity, end_id, with_ids)
    own = found.select(F.col("doc").getField(doc_id).alias("key"), "n_ids", "pieces")
    counted = materialize(own.withColumn("row", F.monotonically_increasing_id()), "encoded")
    first = F.col("n_ids") - (F.size("pieces") - 1) * capacity
    packed = pack(counted.select("row", first.alias("length")).filter(F.col("length") < capacity), capacity)
    joined = counted.join(packed, "row", "left").withColumn("first", first)
    piece = joined.select("*", F.posexplode("pieces").alias("piece", "p"))
    short = (F.col("piece") == 0) & F.col("sequence").isNotNull()
    head = F.col("piece") == 0
    out = piece.select(
        "key",
        F.col("piece").cast("int").alias("piece"),
        F.when(head, F.lit(0)).otherwise(F.col("first") + (F.col("piece") - 1) * capacity).cast("long").alias("start"),
        F.when(head, F.col("first")).otherwise(F.lit(capacity)).cast("long").alias("length"),
        F.col("p.crc").alias("ids_crc32"),
        F.when(short, F.col("sequence")).otherwise(-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.when(short, F.col("offset")).otherwise(F.lit(0)).cast("long").alias("offset"),
        F.col("p.ids").alias("ids"),
    )
    return out if with_ids else out.drop("ids")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids) from pieces with their ids: the packed sequences themselves."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    return pack_documents(table(spark, sf_dir, "documents"), path).withColumnRenamed("key", "doc_id")
