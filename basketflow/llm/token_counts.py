"""Token counts of byte-level BPE: whole tokens are counted, only the other pre-tokens are merged.

Before the run it is proved for each vocabulary string, by merging it, whether it encodes to itself
alone. A pre-token that is such a string is one token. The others are merged many at a time: each
round merges the pair of the lowest rank of every pre-token.
"""

from __future__ import annotations

import json
import re
import unicodedata
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from basketflow.llm.common import annotate, table

LIMIT = 512
# Counts of merged pre-tokens that a task remembers.
REMEMBERED = 300_000
_NEVER = np.iinfo(np.int64).max

# Characters below U+0240 are those whose first byte in UTF-8 is at most 0xC8; their classes are
# spelled out, which is several times as fast as the library's cut, used for texts with others.
_COMMON = bytes(range(0xC9))


def _class(test) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x240) if test(chr(c)))


def library_cut(text: str) -> list[str]:
    """Pre-tokens as the library cuts them, by its own tables of all characters."""
    return [text[a:b] for _, (a, b) in ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]


def _common_pattern() -> re.Pattern:
    letter = _class(lambda c: unicodedata.category(c)[0] == "L")
    number = _class(lambda c: unicodedata.category(c)[0] == "N")
    space = _class(lambda c: c in "\t\n\v\f\r \x85" or unicodedata.category(c)[0] == "Z")
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


def byte_symbols() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizer:
    """What counting needs of a tokenizer file: merges, whole tokens and added tokens."""

    def __init__(self, path: str):
        file = json.loads(Path(path).read_text(encoding="utf-8"))
        symbols, vocab = byte_symbols(), file["model"]["vocab"]
        self.first = np.zeros(256, np.int64)
        for symbol, byte in symbols.items():
            self.first[byte] = vocab[symbol]
        pairs = [(vocab[a] << 20 | vocab[b], vocab[a + b]) for a, b in file["model"]["merges"]]
        keys, merged = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.merged = keys[order], order, merged[order]
        self.added = [t["content"] for t in file["added_tokens"]]
        strings = {bytes(symbols[c] for c in t): i for t, i in vocab.items() if all(c in symbols for c in t)}
        lengths = self.merge(list(strings))
        self._counter: Counter | None = None
        # Whole tokens by the text they stand for; pieces of characters never are a pre-token.
        self.whole = {
            text: 1
            for s, n in zip(strings, lengths, strict=True)
            if n == 1 and (text := s.decode("utf-8", "ignore")).encode() == s
        }

    def counter(self) -> Counter:
        """A counter over this tokenizer that lives as long as it does."""
        if self._counter is None:
            self._counter = Counter(self)
        return self._counter

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        return np.where(known, self.rank[at], _NEVER), self.merged[at]

    def merge(self, words: list[bytes]) -> list[int]:
        """Number of tokens of each byte string."""
        count = np.zeros(len(words), np.int64)
        lengths = np.array([len(w) for w in words], np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        symbol = self.first[np.frombuffer(b"".join(words), np.uint8)]
        rank, into = self._pairs(symbol, word)
        while len(word):
            begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, begin)
            sizes = np.diff(np.append(begin, len(word)))
            done = least == _NEVER
            count[word[begin[done]]] = sizes[done]
            if done.any():
                going = np.repeat(~done, sizes)
                word, symbol, rank, into = word[going], symbol[going], rank[going], into[going]
                least, sizes = least[~done], sizes[~done]
                if not len(word):
                    break
            at = np.flatnonzero(rank == np.repeat(least, sizes))
            # Of overlapping pairs (the same symbol repeated) every second one merges, from the left.
            run = np.append(True, np.diff(at) != 1)
            at = at[(np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]) % 2 == 0]
            symbol[at] = into[at]
            keep = np.ones(len(word), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            word, symbol, rank, into = word[keep], symbol[keep], rank[keep], into[keep]
            touched = np.zeros(len(word) + 1, bool)
            touched[place[at]] = True
            touched[place[at] - 1] = True
            inner = np.flatnonzero(touched[: len(word) - 1])
            fresh, target = self._ranks(symbol[inner], symbol[inner + 1])
            rank[inner] = np.where(word[inner] == word[inner + 1], fresh, _NEVER)
            into[inner] = target
            rank[-1] = _NEVER
        return count.tolist()

    def _pairs(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, into = np.full(len(symbol), _NEVER), np.zeros(len(symbol), np.int64)
        if len(symbol) > 1:
            fresh, into[:-1] = self._ranks(symbol[:-1], symbol[1:])
            rank[:-1] = np.where(word[:-1] == word[1:], fresh, _NEVER)
        return rank, into


class Counter:
    """Counts texts; remembers what it has merged, up to a bound."""

    def __init__(self, tokenizer: Tokenizer, remembered: int = REMEMBERED):
        self.tokenizer, self.limit = tokenizer, len(tokenizer.whole) + remembered
        self.known = dict(tokenizer.whole)
        self.common, self.other = _common_pattern().findall, library_cut
        added = sorted(tokenizer.added, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, added))) if added else None

    def pieces(self, body: bytes) -> tuple[int, list[str]]:
        """Number of added tokens in a text, and the pre-tokens between them."""
        cut = self.other if body.translate(None, _COMMON) else self.common
        text = body.decode("utf-8", "replace")
        if not self.special or not self.special.search(text):
            return 0, cut(text)
        parts = self.special.split(text)
        return len(parts) - 1, [p for part in parts for p in cut(part)]

    def __call__(self, texts: list[bytes]) -> list[int]:
        cut = [self.pieces(t) for t in texts]
        known = self.known
        rest = set().union(*(p for _, p in cut)).difference(known)
        if len(known) + len(rest) > self.limit:
            known = self.known = dict(self.tokenizer.whole)
            rest = set().union(*(p for _, p in cut)).difference(known)
        rest = list(rest)
        known.update(zip(rest, self.tokenizer.merge([p.encode() for p in rest]), strict=True))
        return [n + sum(map(known.__getitem__, p)) for n, p in cut]


def count_tokens(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``doc`` (the columns of a row, or those in ``keep``) with ``n_bytes`` and ``n_tokens`` under the tokenizer file ``path``.

    Strings of added tokens count as one token each, wherever they stand. A missing or empty text has
    no token. The file is read on the driver; tasks get its tables.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Tokenizer(path))

    def make():
        # What one task has merged serves the next ones of the same worker.
        count = shared.value.counter()
        return lambda texts: [[len(t) for t in texts], count(texts)]

    return annotate(docs, text, "n_bytes long, n_tokens long", make, keep)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    found = count_tokens(table(spark, sf_dir, "documents"), path, keep=["doc_id"])
    return found.select("doc.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
