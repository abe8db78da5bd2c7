"""Search for secrets: keywords first, anchored patterns only at their hits, then embedded checks.

An Aho-Corasick automaton over all keywords passes once over each text. Every pattern begins with one
of its keywords, so it is tried only where one was found, in order, and skips what the match before
it took: the same matches as a search with the pattern alone. Runs of hexadecimal digits have no
keyword; there the text is mapped to digit or not, and sixteen digits in a row are the keyword.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

import ahocorasick
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.common import annotate, table


def _always(_: re.Match) -> bool:
    return True


_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62_crc(body: bytes) -> bytes:
    """CRC-32 of ``body`` in six base-62 digits, as access tokens of code hosts end with."""
    n, digits = zlib.crc32(body), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        digits = _BASE62[digit] + digits
    return digits.encode()


# A longer header of a web token is no header.
MAX_HEADER = 1 << 14
_BASE58 = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def checked_key(m: re.Match) -> bool:
    """Whether an extended private key ends with the double SHA-256 of what is before."""
    n = 0
    for digit in m[0]:
        n = 58 * n + _BASE58.index(digit)
    if n.bit_length() > 8 * 82:
        return False
    body = n.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(body[:78]).digest()).digest()[:4] == body[78:]


def checked_account(m: re.Match) -> bool:
    """Whether an account number behind its label has the remainder 1 by 97."""
    number = m["number"].replace(b" ", b"").upper().decode()
    return 15 <= len(number) <= 34 and int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def checked_token(m: re.Match) -> bool:
    return base62_crc(m["body"]) == m["check"]


def signed_header(m: re.Match) -> bool:
    """Whether the first part of a signed web token decodes to a header that names its algorithm."""
    part = m["header"]
    if len(part) > MAX_HEADER:
        return False
    try:
        header = json.loads(base64.urlsafe_b64decode(part + b"=" * (-len(part) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


@dataclass(frozen=True)
class Kind:
    """A kind of secret. ``keywords`` are in lower case; one of them begins every match."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    valid: Callable[[re.Match], bool] = field(default=_always)
    # Where the pattern fails, it fails at every place in the run of these that follows.
    run: re.Pattern | None = None


# The patterns of the kinds, in the order in which equal starts are listed.
ASSIGN = Kind(
    "assign",
    ("password", "passwd", "secret", "token", "apikey", "api_key"),
    re.compile(
        rb"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    ),
    lambda m: len(m[2]) >= 12,
)
ACCESS = Kind("access", ("akia",), re.compile(rb"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18)
HEX = Kind("hex", (), re.compile(rb"[0-9a-f]+"), lambda m: len(m[0]) >= 16)
HOST_TOKEN = Kind(
    "host_token",
    ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
    re.compile(rb"(?:gh[pousr]|npm)_(?P<body>[A-Za-z0-9]{30})(?P<check>[A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    checked_token,
)
WEB_TOKEN = Kind(
    "web_token",
    ("eyj",),
    re.compile(rb"(?P<header>eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    signed_header,
    re.compile(rb"[A-Za-z0-9_-]+"),
)
WALLET = Kind(
    "wallet_key",
    ("xprv", "yprv", "zprv", "tprv"),
    re.compile(rb"[xyzt]prv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])"),
    checked_key,
)
ACCOUNT = Kind(
    "account",
    ("iban",),
    re.compile(rb"(?i:iban)[:=]?\x20?(?P<number>[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"),
    checked_account,
)
KINDS = (ASSIGN, ACCESS, HEX, HOST_TOKEN, WEB_TOKEN, WALLET, ACCOUNT)
BASE = ("assign", "access", "hex")

_HEX_MAP = bytes(0x78 if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))
_HEX_RUN = b"x" * 16


def automaton(kinds: tuple[Kind, ...] = KINDS) -> ahocorasick.Automaton:
    words: dict[str, list[int]] = {}
    for number, kind in enumerate(kinds):
        for word in kind.keywords:
            words.setdefault(word, []).append(number)
    found = ahocorasick.Automaton()
    for word, numbers in words.items():
        found.add_word(word, (len(word) - 1, tuple(numbers)))
    found.make_automaton()
    return found


def _hex_runs(text: bytes) -> list[tuple[int, int]]:
    mapped = text.translate(_HEX_MAP)
    spans, at = [], mapped.find(_HEX_RUN)
    while at >= 0:
        stop = mapped.find(b" ", at)
        stop = len(mapped) if stop < 0 else stop
        spans.append((at, stop))
        at = mapped.find(_HEX_RUN, stop)
    return spans


def scan(text: bytes, words: ahocorasick.Automaton, kinds: tuple[Kind, ...] = KINDS) -> list[tuple[int, int, int]]:
    """(start, kind, stop) of all secrets in a text, in order, in bytes."""
    # One character per byte, lower case for A-Z only: offsets are those of the bytes.
    hits: dict[int, list[int]] = {}
    for last, (back, numbers) in words.iter(text.lower().decode("latin-1")):
        for number in numbers:
            hits.setdefault(number, []).append(last - back)
    spans = []
    for number, starts in hits.items():
        kind, free = kinds[number], 0
        for start in sorted(starts):
            if start < free:
                continue
            m = kind.pattern.match(text, start)
            if m:
                free = m.end()
                if kind.valid(m):
                    spans.append((start, number, free))
            elif kind.run:
                free = kind.run.match(text, start).end()
    if HEX in kinds:
        spans += [(a, kinds.index(HEX), b) for a, b in _hex_runs(text)]
    return sorted(spans)


def in_characters(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The same spans counted in code points."""
    if not spans or text.isascii():
        return spans
    points, at, count = {}, 0, 0
    for place in sorted({p for start, _, stop in spans for p in (start, stop)}):
        count += len(text[at:place].decode("utf-8", "replace"))
        at, points[place] = place, count
    return [(points[a], k, points[b]) for a, k, b in spans]


def _redacted(text: bytes, spans: list[tuple[int, int, int]], mark: bytes) -> bytes:
    out, at = [], 0
    for start, _, stop in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, stop)
    return b"".join([*out, text[at:]])


def find_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``doc`` (the columns of a row, or those in ``keep``) and ``spans``: kind, start and stop of each secret, in code points.

    Base kinds are what their patterns find from left to right; the further kinds need a right
    checksum (access tokens of code hosts, extended private keys, account numbers behind their label)
    or header (signed web tokens; up to 16 KB of it). Spans of different kinds
    may overlap. A missing or empty text has none.
    """

    def make():
        words = automaton()

        def handle(texts: list[bytes]) -> list[list]:
            found = [in_characters(t, scan(t, words)) for t in texts]
            return [[[{"kind": KINDS[k].name, "start": a, "stop": b} for a, k, b in spans] for spans in found]]

        return handle

    return annotate(docs, text, "spans array<struct<kind: string, start: long, stop: long>>", make, keep)


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars", mark: str = "[secret]") -> DataFrame:
    """The rows with every secret in ``text`` replaced by ``mark``; overlapping ones give one mark.

    ``length`` names the column that counts the text's characters, if there is one. Texts without
    secrets stay as they are; a missing text stays missing.
    """

    def make():
        words, sign = automaton(), mark.encode()

        def handle(texts: list[bytes]) -> list[list]:
            spans = [scan(t, words) for t in texts]
            clean = [_redacted(t, s, sign).decode("utf-8", "replace") if s else None for t, s in zip(texts, spans, strict=True)]
            return [clean]

        return handle

    found = annotate(docs, text, "clean string", make)
    columns = []
    for name in docs.columns:
        column = F.col("doc").getField(name)
        if name == text:
            column = F.coalesce("clean", column)
        elif name == length:
            changed = F.char_length("clean").cast(docs.schema[name].dataType)
            column = F.when(F.col("clean").isNotNull(), changed).otherwise(column)
        columns.append(column.alias(name))
    return found.select(*columns)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])
    count = [_count(kind).alias(f"n_{kind}") for kind in BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc.doc_id", *count, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )
