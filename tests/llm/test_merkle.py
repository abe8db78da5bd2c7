"""The manifest against hashes computed by hand, on odd rows, deep trees and tampered texts."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from basketflow.llm import merkle

ROWS = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def climbed(tree, pos, digest):
    """Proof parts and folded digest of one node of a tree."""
    proof = []
    for nodes in tree[:-1]:
        first = pos // 3 * 3
        run = nodes[first : first + 3]
        proof += [n for i, n in enumerate(run) if first + i != pos]
        run[pos - first] = digest
        digest, pos = h(*run), pos // 3
    return proof, digest


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append(levels([leaf(r) for r in groups[s]]))
    upper = levels([t[-1][0] for t in trees])
    out = []
    for at, s in enumerate(sources):
        for pos, row in enumerate(groups[s]):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
            shown = (*row[:4], row[4].replace("\n", "") if hit and row[4] is not None else row[4])
            proof, folded = climbed([list(x) for x in trees[at]], pos, leaf(shown))
            more, folded = climbed([list(x) for x in upper], at, folded)
            root = upper[-1][0]
            out.append((row[0], leaf(row), trees[at][-1][0], root, h(*proof, *more), folded, folded == root))
    return out


def found(docs):
    fields = [F.col(c) for c in merkle.FIELDS]
    fields[-1] = merkle.tampered_text("doc_id", "text")
    return [tuple(r) for r in merkle.verify(docs, merkle.leaf_digest(*fields)).collect()]


def same(a, b):
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_odd_rows(edge):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in edge.collect()]
    same(found(edge), brute(rows))


def test_no_rows(no_docs):
    assert found(no_docs) == []


@pytest.mark.parametrize("n", [1, 2, 3, 4, 27, 28, 82])
def test_one_source(spark, n):
    rows = [(i, "a", "en", 3, f"t\n{i}") for i in range(n)]
    same(found(spark.createDataFrame(rows, ROWS)), brute(rows))


def test_deep_trees_and_many_sources(spark, monkeypatch):
    """Trees over several stations, a hot source, copies of the rows that many leaves climb to."""
    monkeypatch.setattr(merkle, "COPY_ROWS", 50)
    monkeypatch.setattr(merkle, "CLIMB", merkle.CLIMB.replace("1000000", "50"))
    rows = [(i, "hot" if i % 3 else f"s{i % 900}", None, i, f"a\n{i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, ROWS)
    same(found(docs.repartition(5)), brute(rows))


def test_any_type_of_key(spark):
    docs = spark.createDataFrame([("x", 1.5, "a"), ("y", None, "b")], "id string, part double, body string")
    shown = merkle.leaf_digest(F.col("id"), F.upper("body"))
    rows = merkle.verify(docs, shown, "id", "part", ["id", "body"]).collect()
    assert {r.key for r in rows} == {"x", "y"} and not any(r.verified for r in rows)
