"""Removal of documents that quote a benchmark, by suffix arrays over the training texts.

Each task is a shard: it numbers the words of its texts, sorts the suffixes by their first words and
looks up every suffix of every test item in them by binary search. A suffix that cannot begin a
match - its first word begins no window, or a word that no item has comes too early - is left out of
the array; that changes no result and keeps the array to some thousandths of the text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.common import annotate, table, utf8
from basketflow.session import materialize

WINDOW = 10
# Test items go to the tasks in blocks of this many bytes of text; the driver holds one at a time.
BLOCK_BYTES = 4 << 20
# Occurrences that are extended to their longest match at a time.
STEP = 1 << 18

_LETTERS = bytes(range(0x61, 0x7B))
_KEPT = {*range(0x30, 0x3A), *_LETTERS, *range(0x80, 0x100)}
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))

_FIELDS = (
    "n_words long, spans array<struct<start: long, stop: long>>, items array<string>,"
    " matches array<struct<item_id: string, n_words: int, item_word: int, doc_word: long>>"
)


def words(text: bytes) -> list[bytes]:
    """Runs of digits, letters in lower case (A-Z only) and characters beyond ASCII."""
    return text.translate(_LOWER).split()


class TestSuffixes:
    """The windows of some test items, ready to be searched for."""

    __test__ = False

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        listed = [[number(w, len(self.vocabulary) + 1) for w in words(text)] for _, text in items]
        starts, lengths, owners, flat, self.first = [], [], [], [], []
        for owner, ids in enumerate(listed):
            if not ids:
                continue
            length = min(window, len(ids))
            count = len(ids) - length + 1
            starts.append(np.arange(count) + len(flat))
            lengths.append(np.full(count, length))
            owners.append(np.full(count, owner))
            self.first.append((owner, len(flat)))
            flat += [*ids, 0]
        empty = np.zeros(0, np.int64)
        self.names = [name for name, _ in items]
        self.flat = np.array([*flat, *[0] * window], np.int64)
        self.starts = np.concatenate([*starts, empty]).astype(np.int64)
        self.lengths = np.concatenate([*lengths, empty]).astype(np.int64)
        self.owners = np.concatenate([*owners, empty]).astype(np.int64)
        self.item_start = np.zeros(len(items), np.int64)
        for owner, at in self.first:
            self.item_start[owner] = at
        # The least length of a window that begins with a word.
        self.least = np.full(len(self.vocabulary) + 1, np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.flat[self.starts], self.lengths)
        heads = self.flat[self.starts[:, None] + np.arange(window)]
        beyond = np.arange(window) >= self.lengths[:, None]
        # Equal windows are searched for once: their keys and lengths, and the windows that are each.
        self.low, one, kind = np.unique(keys(np.where(beyond, 0, heads)), return_index=True, return_inverse=True)
        self.high = keys(np.where(beyond, 0xFFFFFFFF, heads)[one])
        self.kind_length = self.lengths[one]
        self.members = np.argsort(kind, kind="stable")
        self.n_members = np.bincount(kind, minlength=len(one))
        self.first_member = np.cumsum(self.n_members) - self.n_members


def keys(ids: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings in the same order."""
    width = ids.shape[1] * 4
    return np.ascontiguousarray(ids.astype(">u4")).view(f"S{width}").reshape(-1)


def search(texts: list[bytes], tests: TestSuffixes) -> tuple[np.ndarray, ...]:
    """All places where windows occur, found in the suffix array of these texts.

    Gives the word numbers of the texts, the first word of each text, and the word and the distinct
    window of each occurrence: at most one for each length of a window at any word.
    """
    get = tests.vocabulary.get
    numbers, bounds = [], [0]
    for text in texts:
        # One 0 behind each text ends every match there.
        numbers += [get(w, 0) for w in words(text)]
        numbers.append(0)
        bounds.append(len(numbers))
    ids = np.array([*numbers, *[0] * tests.window], np.int64)
    gaps = np.flatnonzero(ids == 0)
    begins = np.flatnonzero(tests.least[ids] <= tests.window)
    run = gaps[np.searchsorted(gaps, begins)] - begins
    begins = begins[run >= tests.least[ids[begins]]]
    suffixes = keys(ids[begins[:, None] + np.arange(tests.window)])
    order = np.argsort(suffixes, kind="stable")
    array, suffixes = begins[order], suffixes[order]
    low = np.searchsorted(suffixes, tests.low, "left")
    count = np.searchsorted(suffixes, tests.high, "right") - low
    kind = np.repeat(np.arange(len(count)), count)
    inside = np.arange(len(kind)) - np.repeat(np.cumsum(count) - count, count)
    return ids, np.array(bounds), array[low[kind] + inside], kind


def occurrences(tests: TestSuffixes, place: np.ndarray, kind: np.ndarray, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places with each window that is found there, ``step`` of them at a time."""
    stops = np.cumsum(tests.n_members[kind])
    for start in range(0, int(stops[-1]) if len(stops) else 0, step):
        number = np.arange(start, min(start + step, int(stops[-1])))
        row = np.searchsorted(stops, number, "right")
        inside = number - stops[row] + tests.n_members[kind[row]]
        yield place[row], tests.members[tests.first_member[kind[row]] + inside]


def longest(ids: np.ndarray, tests: TestSuffixes, place: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, ...]:
    """Matches that cannot be extended to the left, extended to the right as far as they go."""
    start = tests.starts[window]
    before = (place > 0) & (ids[place - 1] == tests.flat[start - 1]) & (ids[place - 1] > 0)
    first = ~(before & (start > tests.item_start[tests.owners[window]]))
    place, window, start = place[first], window[first], start[first]
    length = tests.lengths[window].copy()
    alive = np.arange(len(place))
    while len(alive):
        a, b = ids[place[alive] + length[alive]], tests.flat[start[alive] + length[alive]]
        alive = alive[(a == b) & (a > 0)]
        length[alive] += 1
    return place, window, length


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def find(texts: list[bytes], tests: TestSuffixes) -> list[list]:
    """Per text: its words, the ranges of words that are hit, the items, their longest matches."""
    ids, bounds, place, kind = search(texts, tests)
    spans: dict[int, set] = defaultdict(set)
    best: dict[int, dict] = defaultdict(dict)
    doc = np.searchsorted(bounds, place, "right") - 1
    hit = np.unique(np.stack([doc, place - bounds[doc], tests.kind_length[kind]]), axis=1)
    for d, at, length in hit.T.tolist():
        spans[d].add((at, at + length))
    for at, windows in occurrences(tests, place, kind, STEP):
        where, which, length = longest(ids, tests, at, windows)
        owner = tests.owners[which]
        offset = tests.starts[which] - tests.item_start[owner]
        of = np.searchsorted(bounds, where, "right") - 1
        # The best match of each item in each text of this step.
        order = np.lexsort((offset, where, -length, owner, of))
        of, owner, length, offset, where = (x[order] for x in (of, owner, length, offset, where))
        best_of = np.append(True, (of[1:] != of[:-1]) | (owner[1:] != owner[:-1]))[: len(of)]
        of, owner, length, offset, where = (x[best_of] for x in (of, owner, length, offset, where))
        for d, o, n, q, p in zip(*(x.tolist() for x in (of, owner, length, offset, where - bounds[of])), strict=True):
            name = tests.names[o]
            if name is not None and (name not in best[d] or (-n, p, q) < best[d][name]):
                best[d][name] = (-n, p, q)
    count = np.diff(bounds) - 1
    rows = range(len(texts))
    return [
        count.tolist(),
        [[{"start": a, "stop": b} for a, b in _merged(list(spans.get(d, ())))] for d in rows],
        [sorted(best.get(d, ())) for d in rows],
        [
            [{"item_id": i, "n_words": -n, "item_word": q, "doc_word": p} for i, (n, p, q) in sorted(best.get(d, {}).items())]
            for d in rows
        ],
    ]


def _blocks(benchmark: DataFrame, item_id: str, text: str, limit: int):
    """The test items in blocks of about ``limit`` bytes, one at a time."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), utf8(text).alias("body"))
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = 1 + total // limit
    for part in range(parts):
        chosen = items.filter(F.pmod(F.xxhash64("item", "body"), F.lit(parts)) == part)
        yield [(r["item"], bytes(r["body"])) for r in chosen.distinct().collect()]


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    keep: list[str] | None = None,
) -> DataFrame:
    """What each document shares with the test items: ``doc`` (its columns, or those in ``keep``) and matches.

    ``n_words``; ``spans``, the merged ranges of words inside occurrences of a window; ``items``, the
    item ids, sorted as strings; ``matches``, the longest match of each such item and where it is. A
    window is ``window`` consecutive words of an item, or all words of a shorter one.

    Texts are read once, nothing is shuffled. The items reach the tasks in blocks of a checked size:
    beyond one block, documents pass through a written table for each further block. A missing text
    has no words; an item without words matches nothing; an item without id hits words but is not
    listed; equal item rows count once; an empty table on either side gives no matches.
    """
    out, sc = docs, docs.sparkSession.sparkContext
    makers = []
    for block in _blocks(benchmark, item_id, item_text, block_bytes):
        tests = sc.broadcast(TestSuffixes(block, window))
        makers.append(lambda tests=tests: lambda texts: find(texts, tests.value))
        if len(makers) == 1:
            out = annotate(docs, text, _FIELDS, makers[0], keep)
            continue
        if len(makers) == 2:
            # Further blocks need the text again.
            out = annotate(docs, text, _FIELDS, makers[0])
        before = materialize(out, "matches").select(F.col("doc").getField(text).alias("body"), F.struct("*").alias("before"))
        now = annotate(before, "body", _FIELDS, makers[-1], ["before"])
        out = now.select(
            "doc.before.doc",
            "n_words",
            _union_spans(F.concat("doc.before.spans", "spans")).alias("spans"),
            F.array_sort(F.array_union("doc.before.items", "items")).alias("items"),
            F.concat("doc.before.matches", "matches").alias("matches"),
        )
    if keep is not None and len(makers) > 1:
        out = out.withColumn("doc", F.struct(*[F.col("doc").getField(c).alias(c) for c in keep]))
    return out


def _union_spans(spans):
    """Merged ranges, in order."""
    none = F.array().cast("array<struct<start: long, stop: long>>")

    def add(done, span):
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        touches = (F.size(done) > 0) & (span["start"] <= F.get(done, F.size(done) - 1)["stop"])
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(F.array_sort(spans), none, add)


def hit_words():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that share no window with any test item, with their columns."""
    return find_matches(docs, benchmark, **options).filter(F.size("spans") == 0).select("doc.*")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_matches(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc.doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


# Windows of every length that occurs, as joined words, on both sides.
SQL = r"""
WITH item AS (
    SELECT DISTINCT item_id::VARCHAR AS item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), win AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
    FROM item, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i)
    WHERE len(w) > 0
), doc AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), place AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM doc, (SELECT DISTINCT n FROM win) AS l, unnest(range(1, len(w) - n + 2)) AS t(i)
), found AS (
    SELECT doc_id, item_id, n, i FROM place JOIN win USING (n, g)
), hit AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_hit
    FROM found, unnest(range(0, n)) AS t(k) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
