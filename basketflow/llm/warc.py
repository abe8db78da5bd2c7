"""Web archives: one record per page, and a reader that splits archives anywhere.

An archive is a row of gzip members, one per record. A reading task gets a byte range: it looks for
the two bytes that begin a gzip member, tries to decode what follows, and takes it for a record only
if it begins with a version line and its member is whole, checksum included. It owns the records that
begin in its range and reads the last one past the range's end. No index is needed.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.common import table, utf8
from basketflow.session import materialize, scratch_path

# A writing task starts another archive beyond this size; a reading task gets this many bytes.
ARCHIVE_BYTES = 256 << 20
RANGE_BYTES = 32 << 20
_READ = 1 << 20
_STEP = 8 << 10
_MAGIC = b"\x1f\x8b\x08"
_VERSION = b"WARC/1.1"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# Fixed value of the revisit profile.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: 160 bits are four numbers of 40 bits, eight letters each."""
    digest, letters = F.sha1(payload), F.array(*[F.lit(c) for c in _ALPHABET])
    parts = []
    for i in range(4):
        number = F.conv(F.substring(digest, 10 * i + 1, 10), 16, 10).cast("long")
        parts += [F.get(letters, F.shiftright(number, 35 - 5 * k).bitwiseAND(F.lit(31)).cast("int")) for k in range(8)]
    return F.concat(*parts)


def record(page: dict) -> bytes:
    """A page as a gzip member: record headers, HTTP headers and, for responses, the payload.

    The page's id and the length of its whole payload go along as headers of our own.
    """
    revisit, payload = page["refers_to"] is not None, page["payload"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page['payload_bytes']}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page['page_id']} {page['url']} {page['payload_digest']}")
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{name}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", _header(page["url"])),
        ("WARC-Payload-Digest", f"sha1:{page['payload_digest']}"),
        ("X-Payload-Length", page["payload_bytes"]),
        ("X-Page-ID", _id(page["page_id"])),
    ]
    if revisit:
        headers += [("WARC-Profile", _PROFILE), ("X-Refers-To-Page", _id(page["refers_to"]))]
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    body = b"".join([_VERSION, b"\r\n", head.encode(), b"\r\n", block, b"\r\n\r\n"])
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packed.compress(body) + packed.flush()


def _header(value: str | None) -> str | None:
    """A value on one line; line breaks and the escape sign itself are percent-encoded."""
    return None if value is None else value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _id(value: object | None) -> str | None:
    """An id of any kind as a header's value, percent-encoded but for letters, digits and ``_.-~``."""
    return None if value is None else quote(str(value), safe="")


def _plain(value: str | None) -> str | None:
    return None if value is None else value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _write(batches: Iterator[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    """Writes archives; gives the name and size of each whole one.

    Names are new for each attempt of a task: what a lost attempt left is named by no manifest.
    """
    store, root = place(folder)
    store.create_dir(root, recursive=True)
    out, name, size, done = None, "", 0, []
    for batch in batches:
        for page in batch.to_pylist():
            if out is None:
                name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                out = store.open_output_stream(f"{root}/{name}", compression=None)
            member = record(page)
            out.write(member)
            size += len(member)
            if size >= archive_bytes:
                out.close()
                done, out = [*done, (name, size)], None
    if out is not None:
        out.close()
        done.append((name, size))
    yield pa.RecordBatch.from_pydict(
        {"file": pa.array([n for n, _ in done], pa.string()), "size": pa.array([s for _, s in done], pa.int64())}
    )


def with_revisits(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, refers_to): what the archives will say.

    Of equal payloads, by digest and length, the one with the least page id is the response, and all
    others name it in ``refers_to``; rows of the same least id are all responses. A missing id comes
    after all others. A missing html is an empty payload.
    """
    payload = utf8(html)
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), base32_sha1(payload).alias("payload_digest"),
    )
    same = ["payload_digest", "payload_bytes"]
    groups = rows.groupBy(*same).agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n"))
    # Only payloads that occur again are looked up; most rows pass through unjoined elsewhere.
    again = materialize(groups.filter("n > 1").select(*same, "least"), "repeated-payloads")
    refers = F.when(~F.col("least").eqNullSafe(F.col("page_id")), F.col("least"))
    return rows.join(again, same, "left").select("page_id", "url", "payload", *same, refers.alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, **columns: str
) -> DataFrame:
    """Writes one record per page to archives in ``folder``; returns the manifest (file, size).

    Each writing task streams its rows into archives of its own. The manifest is written before it is
    returned, and names only archives of tasks that ended well. ``folder`` is a URI of a store that
    all executors reach: file (shared), hdfs, s3 or gs. Ids are of any type that is told by its text.
    """
    rows = with_revisits(pages, **columns)
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    manifest = rows.mapInArrow(lambda b: _write(b, folder, archive_bytes), "file string, size long")
    return materialize(manifest, "archives")


class _Window:
    """Bytes of a file from a place on, read as they are asked for."""

    def __init__(self, source, at: int):
        self.source, self.start, self.data = source, at, bytearray()
        source.seek(at)

    def reach(self, stop: int) -> bool:
        """Whether the file has bytes up to ``stop``; they are then at hand."""
        while self.start + len(self.data) < stop:
            more = self.source.read(max(_READ, stop - self.start - len(self.data)))
            if not more:
                return False
            self.data += more
        return True

    def part(self, start: int, stop: int) -> bytes:
        return bytes(self.data[start - self.start : stop - self.start])

    def find(self, what: bytes, at: int) -> int:
        """Where ``what`` is next among the bytes at hand, or -1."""
        found = self.data.find(what, at - self.start)
        return found if found < 0 else found + self.start

    def forget(self, at: int) -> None:
        """Bytes before ``at`` aren't asked for again; they go once they are many."""
        if at - self.start >= _READ:
            del self.data[: at - self.start]
            self.start = at


def _member(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The record that begins at ``at`` and where it ends, or None if none does."""
    window.reach(at + _STEP)
    try:
        if not zlib.decompressobj(31).decompress(window.part(at, at + _STEP), len(_VERSION)).startswith(b"WARC/1."):
            return None
        whole, parts, place = zlib.decompressobj(31), [], at
        while not whole.eof:
            if not window.reach(place + 1):
                return None
            piece = window.part(place, place + _STEP)
            parts.append(whole.decompress(piece))
            place += len(piece) - len(whole.unused_data)
    except zlib.error:
        return None
    return b"".join(parts), place


def records(source, start: int, stop: int) -> Iterator[bytes]:
    """The records that begin in [start, stop), decoded. ``source`` is a seekable binary file."""
    window, at = _Window(source, start), start
    while at < stop:
        window.forget(at)
        if not window.reach(at + len(_MAGIC)):
            return
        found = window.find(_MAGIC, at)
        if found < 0:
            # The first bytes of a member may be the last ones at hand.
            at = window.start + len(window.data) - len(_MAGIC) + 1
            continue
        at = found
        if at >= stop:
            return
        member = _member(window, at)
        if member is None:
            at += 1
            continue
        yield member[0]
        at = member[1]


def parse(data: bytes, ids: Callable = int) -> dict:
    """A record's headers and payload; the digest and length of a response come from its payload.

    ``ids`` makes an id of its text.
    """
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    payload = rest[: int(headers["content-length"])].partition(b"\r\n\r\n")[2]
    revisit = headers["warc-type"] == "revisit"
    named = {k: ids(unquote(headers[k])) if k in headers else None for k in ("x-page-id", "x-refers-to-page")}
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    return {
        "page_id": named["x-page-id"],
        "url": _plain(headers.get("warc-target-uri")),
        "record_type": headers["warc-type"],
        "payload_bytes": int(headers["x-payload-length"]) if revisit else len(payload),
        "payload_digest": digest if revisit else base64.b32encode(hashlib.sha1(payload).digest()).decode(),
        "refers_to": named["x-refers-to-page"],
        "payload": None if revisit else payload,
    }


_FIELDS = {
    "page_id": pa.string(),
    "url": pa.string(),
    "record_type": pa.string(),
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
    "refers_to": pa.string(),
    "payload": pa.binary(),
}
_RECORDS_PER_BATCH, _BYTES_PER_BATCH = 2000, 8 << 20


def _read(batches: Iterator[pa.RecordBatch], folder: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    store, root = place(folder)
    schema = pa.schema([(n, _FIELDS[n]) for n in names])
    for batch in batches:
        for part in batch.to_pylist():
            rows, size = [], 0
            with store.open_input_file(f"{root}/{part['file']}") as source:
                for data in records(source, part["start"], part["stop"]):
                    parsed = parse(data, str)
                    rows.append({n: parsed[n] for n in names})
                    size += len(data)
                    if len(rows) >= _RECORDS_PER_BATCH or size >= _BYTES_PER_BATCH:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(
    manifest: DataFrame,
    folder: str,
    range_bytes: int = RANGE_BYTES,
    names: list[str] | None = None,
    id_type: str = "long",
) -> DataFrame:
    """One row per record of the manifest's archives, each archive read in byte ranges by many tasks.

    Columns: page_id, url, record_type, payload_bytes, payload_digest, refers_to and payload (null
    for revisits), or those in ``names``. Ids are of the type ``id_type``. A member cut off at the end of an archive is left out.
    """
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long")))
    ranges = manifest.filter("size > 0").select("file", "size", begin.alias("start"))
    ranges = ranges.select("file", "start", F.least("size", F.col("start") + range_bytes).alias("stop"))
    names = names or list(_FIELDS)
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    schema = ", ".join(f"{n} {kinds[_FIELDS[n]]}" for n in names)
    # A range for each task: ranges are few and tiny, and dealt out in their order, not by hash.
    count = ranges.count()
    spread = ranges.repartitionByRange(max(1, count), "file", "start") if count else ranges
    found = spread.mapInArrow(lambda b: _read(b, folder, names), schema)
    return found.select(*[F.col(n).cast(id_type) if n in ("page_id", "refers_to") else F.col(n) for n in names])


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    manifest = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(manifest, folder, names=[n for n in _FIELDS if n not in ("url", "payload")])


# 40 bits of the digest make eight letters.
_LETTERS = " || ".join(
    f"substr('{_ALPHABET}', (((('0x' || substr(d, {10 * i + 1}, 10))::BIGINT >> {35 - 5 * k}) & 31) + 1)::INTEGER, 1)"
    for i in range(4)
    for k in range(8)
)
SQL = f"""
WITH page AS (
    SELECT page_id, sha1(coalesce(html, '')) AS d, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages
), named AS (
    SELECT *, min(page_id) OVER (PARTITION BY d, payload_bytes) AS least FROM page
)
SELECT page_id, payload_bytes, {_LETTERS} AS payload_digest,
    CASE WHEN least = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN least <> page_id THEN least END AS refers_to
FROM named
"""
