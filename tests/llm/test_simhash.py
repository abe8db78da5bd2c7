import random
import re

import numpy as np
import pytest
import xxhash

from basketflow.llm import simhash as S
from basketflow.llm.common import components
from tests.conftest import SMALL

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def brute_print(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute(rows):
    """component_id of each (doc_id, print) row."""
    prints = np.array([p for _, p in rows], np.uint64)
    pairs = [(i, i + 1 + j) for i in range(len(rows)) for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[i + 1 :]) <= 4)]
    root = groups(len(rows), pairs)
    least = {}
    for (doc_id, _), r in zip(rows, root, strict=True):
        if doc_id is not None:
            least[r] = min(doc_id, least.get(r, doc_id))
    return [least.get(r) for r in root]


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = [(r["doc_id"], brute_print(r["text"])) for r in docs]
    want = {(i, f"{p:016x}", c) for (i, p), c in zip(rows, brute(rows), strict=True)}
    assert {tuple(r) for r in S.op7_simhash(spark, SMALL).collect()} == want


def test_edge_rows(edge, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect()]
    rows = [(i, brute_print(t)) for i, t in rows]
    want = sorted((str(i), p, str(c)) for (i, p), c in zip(rows, brute(rows), strict=True))
    got = S.near_duplicates(edge).collect()
    assert sorted((str(r["doc_id"]), r["print"] % (1 << 64), str(r["component_id"])) for r in got) == want
    assert S.near_duplicates(no_docs).count() == 0


def test_one_of_each_group_stays(edge, no_docs):
    kept = S.keep_one(edge)
    assert kept.columns == edge.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted(["1", "4", "5", "7", "8", "-9", "None"])
    assert S.keep_one(no_docs).count() == 0


@pytest.mark.parametrize("spread", [0, 3, 12])
def test_links_of_planted_fingerprints(spark, spread):
    rnd = random.Random(spread)
    prints = [rnd.getrandbits(64) for _ in range(30)]
    for _ in range(400):
        p = rnd.choice(prints)
        for _ in range(rnd.randrange(spread + 1)):
            p ^= 1 << rnd.randrange(64)
        prints.append(p)
    prints = sorted(set(prints))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame(signed, "print long").repartition(5)
    found = components(S.print_links(df), "test")
    root = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in found.collect()}
    array = np.array(prints, np.uint64)
    pairs = [(i, i + 1 + j) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(array[i] ^ array[i + 1 :]) <= 4)]
    want = groups(len(prints), pairs)
    mine = [root.get(p, p) for p in prints]
    assert len(set(zip(mine, want, strict=True))) == len(set(want)) == len(set(mine))


@pytest.mark.parametrize("n", [0, 1, 2, 300])
def test_components_of_chains_stars_and_rings(spark, n):
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1001 + i) for i in range(n)] + [(5000 + i, 5000 + (i + 1) % max(1, n)) for i in range(n)]
    found = components(spark.createDataFrame(edges, "a long, b long"), "test").collect()
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert {r["node"] for r in found} == nodes
    by_part = {}
    for r in found:
        by_part.setdefault((r["node"] >= 1000) + (r["node"] >= 5000), set()).add(r["root"])
    assert all(len(v) == 1 for v in by_part.values())


def test_an_id_with_several_texts(spark):
    def text(seed):
        return " ".join(random.Random(seed).choices([f"word{i}" for i in range(500)], k=200))

    a, b, c, d = map(text, "abcd")
    # 5 names two groups, of one of which it has two rows; 6 is in a group of its own and in that of 3.
    rows = [(5, a, 1), (5, b, 2), (5, b, 3), (9, a, 4), (3, c, 5), (6, c, 6), (6, d, 7), (8, d, 8)]
    kept = S.keep_one(spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(5, a), (5, b), (3, c), (6, d)])


def template_prints(n, seed=1):
    """Fingerprints of texts from one template: half of the bits fixed, some near copies."""
    rng = np.random.default_rng(seed)
    prints = rng.integers(0, 1 << 32, n, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 32, (3, n // 4), dtype=np.uint64)
    near = prints[: n // 4] ^ flips[0] ^ flips[1] ^ flips[2]
    return np.unique(np.concatenate([prints, near]) | np.uint64(0xABCD1234) << np.uint64(32))


def partition(n, links):
    return [*map({}.setdefault, groups(n, links), range(n))]


def all_links(prints):
    return [
        (i, i + 1 + j) for i in range(len(prints) - 1) for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[i + 1 :]) <= 4).tolist()
    ]


@pytest.mark.parametrize("n", [5, 100, 128, 129, 3000])
def test_pivots_choose_the_pairs(n):
    prints = template_prints(n)
    np.random.default_rng(0).shuffle(prints)
    formed = [0]
    a, b = S._linked(np.zeros(len(prints), np.int64), prints, 4, S.pivot_prints(), formed)
    place = {p: i for i, p in enumerate(prints.tolist())}
    found = [(place[x], place[y]) for x, y in zip(a.view(np.uint64).tolist(), b.view(np.uint64).tolist())]
    assert all((prints[i] ^ prints[j]).bit_count() <= 4 for i, j in found)
    assert partition(len(prints), found) == partition(len(prints), all_links(prints))
    every = len(prints) * (len(prints) - 1) // 2
    assert formed[0] < every * (0.65 if n >= 1000 else 1)


def test_many_groups_at_once():
    rng = np.random.default_rng(3)
    prints = np.concatenate([template_prints(n, n) for n in (2, 3, 40, 200, 2, 700)])
    key = np.sort(rng.integers(0, 9, len(prints)))
    a, b = S._linked(key, prints, 4, S.pivot_prints())
    want = set()
    for k in range(9):
        own = prints[key == k]
        want |= {(len(own), tuple(partition(len(own), all_links(own))), k)}
        place = {p: i for i, p in enumerate(own.tolist())}
        links = [(place[x], place[y]) for x, y in zip(a.view(np.uint64).tolist(), b.view(np.uint64).tolist()) if x in place and y in place]
        assert partition(len(own), [l for l in links if (own[l[0]] ^ own[l[1]]).bit_count() <= 4]) == partition(len(own), all_links(own))


@pytest.mark.parametrize("large", [40, 300])
def test_large_groups_are_dealt_out(spark, monkeypatch, large):
    prints = template_prints(1500)
    rows = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints.tolist()], "print long").repartition(3)
    met = []
    meetings = S._meetings
    monkeypatch.setattr(S, "_meetings", lambda df, n: met.append(meetings(df, n)) or met[0])
    found = components(S.print_links(rows, most=large), "test").collect()
    root = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in found}
    want = groups(len(prints), all_links(prints))
    mine = [root.get(p, p) for p in prints.tolist()]
    assert len(set(zip(mine, want, strict=True))) == len(set(want)) == len(set(mine))
    sizes = [r["count"] for r in met[0].groupBy("key", "low", "high").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 2 * large
