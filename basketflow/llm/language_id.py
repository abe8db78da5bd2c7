"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts of up to three bytes with frozen counts. A byte costs its
code length in the longest context known to the language: -log2 of its share there, or the context's
escape and then its cost in the next shorter context (method C: a context of n bytes, d of them
different, escapes with d / (n + d)). The language with the shortest code for the whole text wins.

With frozen counts a cost depends on four bytes only, so it is worked out once for every different
sequence of four bytes in a stretch of texts, from sorted tables of all contexts that were learned.
Costs are whole 1/1024 bits: sums are exact, whatever pieces a text comes in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.common import annotate, heavy_hash, held_out, table, utf8

ORDER = 3
# Expected bytes of training text in all, shared evenly by the languages: a hash sample of rows. Rows
# that are expected of a language at least, however long; a longer one than they allow lends pieces.
TRAIN_BYTES = 16 << 20
MIN_ROWS = 32
PIECE_BYTES = 1024
# Languages whose trees are kept together, bytes of text and different sequences worked on at a time.
GROUP = 32
_LANG_BITS = 5
STRETCH = 1 << 21
KINDS = 1 << 16
UNIT = 1024
UNKNOWN = "und"

_START = b"\n" * ORDER
_LATIN = re.compile(rb"[A-Za-z]")


def folded(text: bytes) -> bytes:
    return text.decode("utf-8", "replace").lower().encode("utf-8", "replace")


def has_letter(text: bytes) -> bool:
    return bool(_LATIN.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "ignore"))


def grams(text: np.ndarray) -> np.ndarray:
    """Every byte with the three before it, as one number, for a text that begins with its padding."""
    wide = text.astype(np.uint32)
    return wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:]


def pieces(text: bytes, most: int) -> list[bytes]:
    """A text, padded at its start, or evenly spaced pieces of it of about ``most`` bytes in all; not the padding's grams."""
    if len(text) <= most:
        return [_START + folded(text)]
    count = max(1, most // PIECE_BYTES)
    starts = [i * (len(text) - PIECE_BYTES) // max(1, count - 1) for i in range(count)]
    # Bytes of a letter that is cut are left out.
    cut = [text[at : at + PIECE_BYTES].decode("utf-8", "ignore").encode() for at in starts]
    return [(_START if at == 0 else b"") + folded(piece) for at, piece in zip(starts, cut, strict=True)]


def _count(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = batch.column("body").to_pylist()
        for lang in sorted(set(langs)):
            own = [p for name, t in zip(langs, texts, strict=True) if name == lang for p in pieces(t, most) if len(p) > ORDER]
            if not own:
                continue
            found, n = np.unique(np.concatenate([grams(np.frombuffer(t, np.uint8)) for t in own]), return_counts=True)
            names = pa.array([lang] * len(found), pa.string())
            counts = [pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([names, *counts], ["lang", "gram", "n"])


def count_contexts(rows: DataFrame, lang: str, text: str, row_id: str, train_bytes: int) -> DataFrame:
    """(lang, gram, n): the counts of four-byte sequences in a hash sample of the labelled rows.

    Each language has the same share of ``train_bytes``, and of it each row lends at most one part in
    32 (1 KB at least), a longer one by pieces from all over it: very long texts don't crowd out the
    others. The sample takes rows with a chance that makes about the share, or 32 rows if that is
    more, and in any case the row of the least mark; languages with less text are taken whole.
    """
    # The text is part of the mark: rows without an id are drawn one by one, too.
    mark = heavy_hash(F.col(row_id).cast("string"), F.col(text))
    labelled = rows.select(F.col(lang).alias("lang"), utf8(text).alias("body"), mark.alias("mark")).filter(F.col("lang").isNotNull() & (F.octet_length("body") > 0))
    share = train_bytes / max(1, labelled.select("lang").distinct().count())
    most = max(PIECE_BYTES, int(share / MIN_ROWS))
    lent = F.least(F.octet_length("body"), F.lit(most)).cast("long")
    sizes = labelled.groupBy("lang").agg(F.sum(lent).alias("size"), F.count("*").alias("rows"), F.min("mark").alias("least"))
    part = F.greatest(F.lit(share) / F.col("size"), F.lit(float(MIN_ROWS)) / F.col("rows"))
    chance = sizes.select(F.col("lang").alias("of"), (part * F.lit(float(1 << 62))).alias("below"), "least")
    drawn = (F.col("mark") < F.col("below")) | (F.col("mark") == F.col("least"))
    sample = labelled.join(F.broadcast(chance), F.col("lang") == F.col("of")).filter(drawn)
    counted = sample.select("lang", "body").mapInArrow(lambda b: _count(b, most), "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class _Entries:
    """Sorted keys, and for each the languages that know it with a value."""

    keys: np.ndarray
    first: np.ndarray
    lang: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, key: np.ndarray, lang: np.ndarray, value: np.ndarray) -> _Entries:
        """From values in the order of key and language."""
        keys, first = np.unique(key, return_index=True)
        return cls(keys.astype(np.uint32), np.append(first, len(key)), lang.astype(np.uint16), value)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``wanted``, language, value) of every language that knows a wanted key."""
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        rows = np.flatnonzero(self.keys[at] == wanted)
        first, count = self.first[at[rows]], self.first[at[rows] + 1] - self.first[at[rows]]
        entry = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return np.repeat(rows, count), self.lang[entry], self.value[entry]


class _Group:
    """The trees of a few languages: per order, escapes of their contexts and costs of bytes in them."""

    def __init__(self, lang: np.ndarray, gram: np.ndarray, n: np.ndarray, size: int):
        self.size = size
        self.escapes: list[_Entries] = []
        self.costs: list[_Entries] = []
        for length in range(ORDER + 1):
            part = gram & ((1 << 8 * (length + 1)) - 1)
            # Language last: entries of one key lie together.
            pair, where = np.unique(part << _LANG_BITS | lang, return_inverse=True)
            count = np.bincount(where, weights=n, minlength=len(pair))
            key, of = pair >> _LANG_BITS, pair & ((1 << _LANG_BITS) - 1)
            context, at = np.unique(key >> 8 << _LANG_BITS | of, return_inverse=True)
            total, kinds = np.bincount(at, weights=count), np.bincount(at)
            whole = total + kinds
            owner = context & ((1 << _LANG_BITS) - 1)
            self.escapes.append(_Entries.of(context >> _LANG_BITS, owner, -np.log2(kinds / whole)))
            self.costs.append(_Entries.of(key, of, -np.log2(count / whole[at])))

    def units(self, gram: np.ndarray) -> np.ndarray:
        """Cost of the last byte of each four-byte sequence behind the others, by language, in units."""
        out = np.full((len(gram), self.size), 8.0)
        for length, (escapes, costs) in enumerate(zip(self.escapes, self.costs, strict=True)):
            part = gram & np.uint32((1 << 8 * (length + 1)) - 1)
            rows, lang, bits = escapes.find(part >> np.uint32(8))
            out[rows, lang] += bits
            rows, lang, bits = costs.find(part)
            out[rows, lang] = bits
        return np.round(out * UNIT).astype(np.int32)


class ContextTrees:
    """The trees of all languages with every context that was learned, in groups of languages.

    A learned sequence takes some 14 bytes per order: all of them at most some 60 bytes per byte of
    training text.
    """

    def __init__(self, counts: list[tuple[str, int, int]]):
        self.langs = sorted({lang for lang, _, _ in counts})
        number = {lang: i for i, lang in enumerate(self.langs)}
        of = np.array([number[c[0]] for c in counts], np.int64)
        gram = np.array([c[1] for c in counts], np.int64)
        n = np.array([c[2] for c in counts], np.int64)
        self.groups = []
        for first in range(0, len(self.langs), GROUP):
            own = (of >= first) & (of < first + GROUP)
            size = min(GROUP, len(self.langs) - first)
            self.groups.append(_Group(of[own] - first, gram[own], n[own], size))

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language, in units of 1/1024 bit."""
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        padded = [_START + t for t in texts]
        joined = np.frombuffer(b"".join(padded), np.uint8)
        ends = np.cumsum([len(t) for t in padded], dtype=np.int64)
        for start in range(0, max(0, len(joined) - ORDER), STRETCH):
            gram = grams(joined[start : start + STRETCH + ORDER])
            owner = np.searchsorted(ends, np.arange(start, start + len(gram)), "right")
            # The three sequences before each text's first byte cross from one text into the next.
            inside = np.arange(start, start + len(gram)) + ORDER < ends[owner]
            gram, owner = gram[inside], owner[inside]
            if not len(gram):
                continue
            kinds, where = np.unique(gram, return_inverse=True)
            texts_here, row = np.unique(owner, return_inverse=True)
            for g, group in enumerate(self.groups):
                units = np.concatenate([group.units(kinds[at : at + KINDS]) for at in range(0, len(kinds), KINDS)])
                for lang in range(group.size):
                    sums = np.bincount(row, weights=units[where, lang], minlength=len(texts_here))
                    out[texts_here, g * GROUP + lang] += sums.astype(np.int64)
        return out


def identify(texts: list[bytes], trees: ContextTrees) -> list[list]:
    lower = [folded(t) for t in texts]
    lengths = trees.lengths(lower)
    best = lengths.argmin(axis=1) if trees.langs else np.zeros(len(texts), np.int64)
    spare = np.minimum((lengths - lengths.min(axis=1, keepdims=True, initial=1 << 62)) / UNIT, 1000.0)
    share = 1.0 / np.maximum(np.exp2(-spare).sum(axis=1), 1.0)
    named = [bool(trees.langs) and has_letter(t) for t in texts]
    return [
        [trees.langs[b] if ok else UNKNOWN for b, ok in zip(best, named, strict=True)],
        [float(s) if ok else 0.0 for s, ok in zip(share, named, strict=True)],
    ]


def train(
    labelled: DataFrame, lang: str = "lang", text: str = "text", row_id: str = "doc_id", train_bytes: int = TRAIN_BYTES
) -> ContextTrees:
    """Context trees of the languages in ``lang``; rows without language or text teach nothing.

    What reaches the driver is bounded by the training sample: at most one count per byte of it.
    """
    counted = count_contexts(labelled, lang, text, row_id, train_bytes).toPandas()
    rows = zip(counted["lang"].tolist(), counted["gram"].tolist(), counted["n"].tolist(), strict=True)
    return ContextTrees(list(rows))


def predict(docs: DataFrame, trees: ContextTrees, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``doc`` (the columns of a row, or those in ``keep``) with ``lang_pred`` and ``score``, the winner's share of 2^-length.

    A text that is missing, empty or without any letter, and every text if nothing was learned, is
    ``und`` with score 0. Equal lengths go to the first language by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    fields = "lang_pred string, score double"
    return annotate(docs, text, fields, lambda: lambda texts: identify(texts, shared.value), keep)


def with_letters(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text has a letter."""
    marked = annotate(docs, text, "lettered boolean", lambda: lambda texts: [[has_letter(t) for t in texts]])
    return marked.filter("lettered").select("doc.*")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    trees = train(docs.filter(~held_out("doc_id")))
    found = predict(docs, trees, keep=["doc_id"])
    return found.select("doc.doc_id", held_out("doc.doc_id").alias("held_out"), "lang_pred", "score")
