import datetime as dt
import math

import numpy as np
import pytest

from basketflow.llm import embedding_dedup as E
from tests.conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, id long, links string"


def brute(rows, cosine=0.98):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def good(r):
        v = r[1]
        return r[2] is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n_links = [0] * len(rows)
    for i, a in enumerate(rows):
        for j in range(i + 1, len(rows)):
            b = rows[j]
            if good(a) and good(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    n_links[i] += 1
                    n_links[j] += 1
                    p, q = find(i), find(j)
                    parent[max(p, q)] = min(p, q)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted(str((r[0], n_links[i], least.get(find(i)), r[0] == least.get(find(i)))) for i, r in enumerate(rows))


def made(seed, n, size=16):
    """Vectors in tight groups, far from the limit of 0.98 on either side."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, size))
    out = []
    for i in range(n):
        v = centres[i % 8] + rng.standard_normal(size) * 0.02 * (i % 3)
        out.append((1000 - i, [float(x) for x in v.astype(np.float32)], int(i % 8 < 6)))
    return out


@pytest.mark.parametrize("chunk", [1024, 7])
def test_equals_brute_force(spark, chunk):
    rows = made(1, 120)
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA).repartition(4)
    got = E.near_duplicates(df, chunk=chunk).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows)


def test_edge_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(5, v, 1), (5, v, 1), (3, [2.0, 4.0, 6.0], 1), (2, v, 2), (1, v, None), (7, None, 1), (8, [0.0, 0.0, 0.0], 1), (9, [], 1),
            (10, [1.0, None, 2.0], 1), (11, [1.0, float("nan"), 2.0], 1), (12, [float("inf"), 1.0, 2.0], 1), (None, v, 1), (None, v, 3),
            (13, [1.0, 2.0, 3.0, 0.0], 1), (14, [1e-30, 2e-30, 3e-30], 1), (15, [1e30, 2e30, 3e30], 1)]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA).repartition(3)
    got = E.near_duplicates(df).collect()
    want = brute([(r[0], None if r[1] is None else [None if x is None else x for x in r[1]], r[2]) for r in rows])
    assert sorted(str((r[0], r[1], r[2], bool(r[3]) if r[0] is not None else r[0] == r[2])) for r in got) == want
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_recall_of_borderline_pairs(spark):
    """Pairs of a cosine just above the limit: the hardest ones to meet."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(400):
        a = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(64)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        angle = math.acos(0.981)
        rows += [(2 * i, a.astype(np.float32).tolist(), 0), (2 * i + 1, (a * math.cos(angle) + b * math.sin(angle)).astype(np.float32).tolist(), 0)]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA)
    found = E.near_duplicates(df).agg({"n_links": "sum"}).first()[0]
    assert found / 800 > 0.97


def test_query(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = E.op10_embedding_dedup(spark, SMALL).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows)


def test_schemes_grow_with_the_rows():
    assert E.scheme(50_000) == E.Scheme(E.TABLES, E.PROJECTIONS)
    for rows in (10**6, 10**8, 10**10):
        plan = E.scheme(rows)
        found = 1 - (1 - E.same_cell(E.COSINE) ** plan.projections) ** plan.tables
        assert found >= E.RECALL and rows * E.same_cell(E.BACKGROUND) ** plan.projections * plan.tables <= E.MET_BY_CHANCE
        assert plan.tables < 500


@pytest.mark.parametrize("rows", [50_000, 10**7])
@pytest.mark.parametrize("background", [0.0, 0.5])
def test_recall_of_the_tables(rows, background):
    """Pairs at the least cosine of a link among vectors of a common direction meet in some table."""
    rng, plan = np.random.default_rng(1), E.scheme(rows)
    shared = rng.standard_normal(48)
    shared /= np.linalg.norm(shared)

    def some(n):
        x = rng.standard_normal((n, 48))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        x = np.sqrt(background) * shared + np.sqrt(1 - background) * x
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    x, y = some(2000), rng.standard_normal((2000, 48))
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.981 * x + np.sqrt(1 - 0.981**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    names = [E.bucket_names(v, np.full(2000, 48), np.zeros(2000, np.int64), plan) for v in (x, y, some(2000))]
    assert (names[0] == names[1]).any(axis=1).mean() >= 0.99
    strangers = (names[0] == names[2]).sum(axis=1).mean() * rows
    assert strangers <= 3 * E.MET_BY_CHANCE


@pytest.mark.parametrize("kind", ["string", "boolean", "double", "date", "int"])
def test_labels_of_any_type(spark, kind):
    values = {"string": ["a", "b"], "boolean": [True, False], "double": [0.5, 1.5], "date": [dt.date(2024, 1, 1), dt.date(2024, 1, 2)], "int": [-1, 7]}[kind]
    rows = [(i, [1.0, float(i // 4), 0.0], [*values, None][i % 3]) for i in range(12)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in E.near_duplicates(df).collect()}
    for i, v, label in rows:
        near = [j for j, w, other in rows if j != i and label is not None and other == label and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98]
        assert got[i][0] == len(near), (i, near)
