import random
import re
from fractions import Fraction

import pytest

from basketflow.llm import mixing as M
from tests.conftest import SMALL


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    """Shares by weight; what is above a stop goes to the others, again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: Fraction(rest * weight[s], sum(weight[t] for t in free)) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed |= {s: 3 * sizes[s] for s in over}


def check(docs, got):
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + words(r["text"])
    assert sorted((str(r["doc_id"]), words(r["text"])) for r in rows) == sorted((str(r["doc_id"]), r["size"]) for r in got)
    targets, taken = brute_targets(sizes), {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(float(targets[r["source"]]), abs=1e-6)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[s] - float(targets[s])) <= 0.5 for s in taken)


def test_query_and_reruns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    first = M.taken_words(docs).collect()
    check(docs, first)
    again = M.taken_words(docs.repartition(7)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    assert M.op8_mix(spark, SMALL).columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_edge_rows(edge, no_docs):
    check(edge, M.taken_words(edge, block_words=64).collect())
    assert M.taken_words(no_docs).count() == 0


def test_small_sources_stop_at_three_passes(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(1, "a"), (2, "a"), (1000, "b"), (30, "c"), (10, None), (5, "é")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.taken_words(docs, block_words=4).collect()
    check(docs, got)
    assert {r["doc_id"]: r["taken"] for r in got}[1] == 6


def test_the_schedule_is_even(spark):
    docs = spark.createDataFrame([(i, "w " * 640, "abc"[i % 3]) for i in range(90)], "doc_id long, text string, source string")
    placed, mixed = M.mix(docs, block_words=64)
    source = {r["row"]: r["source"] for r in placed.collect()}
    rows = sorted(mixed.collect(), key=lambda r: (r["position"], r["row"]))
    by_slot = {}
    for r in rows:
        by_slot.setdefault(r["position"], []).append(r)
    assert all(sum(r["to_word"] - r["from_word"] for r in b) <= 64 for b in by_slot.values())
    slots = [source[b[0]["row"]] for _, b in sorted(by_slot.items())]
    for name in "abc":
        share = slots.count(name) / len(slots)
        so_far = 0
        for i, s in enumerate(slots, 1):
            so_far += s == name
            assert abs(so_far - share * i) <= 6


def test_running_total(spark):
    rnd = random.Random(8)
    rows = [(rnd.randrange(3), i, rnd.randrange(5)) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, at int, n int")
    from pyspark.sql import functions as F

    got = M.running_total(df, ["g"], F.floor(F.col("at") / 16), ["at"], "n", "before").collect()
    assert all(r["before"] == sum(n for g, at, n in rows if g == r["g"] and at < r["at"]) for r in got)
