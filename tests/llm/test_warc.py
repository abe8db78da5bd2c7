import base64
import gzip
import hashlib
import io
import random
import time

import pytest
from pyspark.sql import functions as F

from basketflow.llm import warc as W
from basketflow.session import scratch_path


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page(number, payload, refers_to=None):
    return {"page_id": number, "url": f"http://x/{number}%\n", "payload": payload, "payload_bytes": len(payload),
            "payload_digest": digest(payload), "refers_to": refers_to}


@pytest.mark.parametrize("step", [1, 7, 1000, 10**9])
def test_ranges_own_the_records_that_start_inside(step):
    rnd = random.Random(1)
    payloads = [rnd.choice([b"", W._MAGIC * 9, rnd.randbytes(300), rnd.randbytes(30_000 if step > 900 else 40)]) for _ in range(40)]
    data = b"".join(W.record(page(i, p)) for i, p in enumerate(payloads))
    got = [W.parse(r) for a in range(0, len(data), step) for r in W.records(io.BytesIO(data), a, min(len(data), a + step))]
    assert [(g["page_id"], g["payload"]) for g in got] == list(enumerate(payloads))


def test_a_record_inside_a_stored_payload_is_not_taken_for_one_at_the_start():
    inner = W.record(page(1, b"inner"))
    outer = W.record(page(2, inner * 3))
    assert [W.parse(r)["page_id"] for r in W.records(io.BytesIO(outer), 0, len(outer))] == [2]


def test_broken_members_are_left_out():
    whole = W.record(page(1, b"one"))
    data = b"junk" + W._MAGIC + whole + whole[:-9]
    assert [W.parse(r)["page_id"] for r in W.records(io.BytesIO(data), 0, len(data))] == [1]


def test_records_are_valid_gzip():
    text = gzip.decompress(W.record(page(5, "é".encode(), 3))).decode()
    assert text.startswith("WARC/1.1\r\nWARC-Type: revisit\r\n") and "é" not in text


def test_round_trip(spark):
    rows = [(3, "http://a", "<p>x"), (1, "http://b\r\nInjected: 1", "<p>x"), (1, None, "<p>x"), (4, "u", None), (5, "u", ""),
            (6, "u", "é" * 50_000), (None, "u", "<p>x"), (None, "u", "alone")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string").repartition(3)
    folder = f"file://{scratch_path(spark, 'warc-test')}"
    manifest = W.write_archives(pages, folder, archive_bytes=300)
    got = W.read_archives(manifest, folder, range_bytes=100).collect()
    want = []
    for number, url, html in rows:
        least = min((r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None), default=None)
        refers = least if least != number else None
        payload = (html or "").encode()
        want.append((number, url, "response" if refers is None else "revisit", len(payload), digest(payload), refers))
    key = str
    assert sorted([tuple(r)[:6] for r in got], key=key) == sorted(want, key=key)
    assert all((r["payload"] is None) == (r["record_type"] == "revisit") for r in got)
    none = W.write_archives(pages.limit(0), folder + "-none")
    assert W.read_archives(none, folder + "-none").count() == 0


@pytest.mark.parametrize("kind", ["string", "double", "date", "decimal(20,3)"])
def test_ids_of_any_type(spark, kind):
    texts = [" a\r\nb%20 ", "", "007", "é/漢", "a\r\nb%20"]
    column = {"string": "t", "double": "n / 3", "date": "date_add(date'2024-01-01', n)", "decimal(20,3)": "cast(n / 3 as decimal(20,3))"}[kind]
    rows = spark.createDataFrame([(i, t, ["x", "y"][i % 2]) for i, t in enumerate(texts)], "n int, t string, html string")
    pages = rows.selectExpr(f"{column} AS page_id", "'u' AS url", "html")
    folder = f"file://{scratch_path(spark, 'warc-ids')}"
    got = W.read_archives(W.write_archives(pages, folder), folder, range_bytes=150, id_type=kind)
    assert got.schema["page_id"].dataType == got.schema["refers_to"].dataType == pages.schema["page_id"].dataType
    ids = {r["page_id"]: r["html"] for r in pages.collect()}
    least = {h: min(i for i, x in ids.items() if x == h) for h in ("x", "y")}
    assert {r["page_id"]: r["refers_to"] for r in got.collect()} == {i: None if least[h] == i else least[h] for i, h in ids.items()}


def test_each_task_reads_a_range(spark):
    rows = [(i, "u", random.Random(i).randbytes(400).hex()) for i in range(300)]
    folder = f"file://{scratch_path(spark, 'warc-even')}"
    manifest = W.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), folder)
    found = W.read_archives(manifest, folder, range_bytes=10_000)
    per_task = found.groupBy(F.spark_partition_id()).count().collect()
    ranges = sum(-(-r["size"] // 10_000) for r in manifest.collect())
    assert found.rdd.getNumPartitions() == ranges and len(per_task) >= ranges - 2
    assert found.count() == 300


def test_large_members_are_read_in_linear_time():
    began = time.time()
    data = W.record(page(1, random.Random(0).randbytes(60 << 20))) + W.record(page(2, b"x"))
    assert [len(W.parse(r)["payload"]) for r in W.records(io.BytesIO(data), 0, len(data))] == [60 << 20, 1]
    assert time.time() - began < 30
