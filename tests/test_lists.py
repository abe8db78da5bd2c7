"""List arithmetic against plain Python written from the definitions."""

import random

from pyspark.sql import functions as F

from basketflow.functions import lists, text

LISTS = "a array<long>, b array<long>, c array<long>"


def python_ap(actual, predicted, k):
    top, hits, score = predicted[:k], 0, 0.0
    for i, p in enumerate(top):
        if p in actual and p not in top[:i]:
            hits += 1
            score += hits / (i + 1)
    return score / min(len(actual), k) if actual else 0.0


def python_blend(weighted, k):
    scores = {}
    for ids, weight in weighted:
        for i, a in enumerate(ids[:k]):
            scores[a] = scores.get(a, 0) + weight / (i + 1)
    order = {a: i for i, a in enumerate(scores)}
    return sorted(scores, key=lambda a: (-round(scores[a], 12), order[a]))[:k]


def test_average_precision(spark):
    random.seed(5)
    cases = [
        ([1, 2, 3], [1, 4, 3, 2], 3),
        ([4, 5], [5, 6, 4], 3),
        ([1, 1, 1], [1], 12),
        ([1], [1, 1, 1], 12),
        ([], [1, 2], 12),
        ([1, 2], [], 12),
        ([2], [1, 2], 1),
    ]
    for _ in range(200):
        actual = [random.randrange(12) for _ in range(random.randrange(15))]
        predicted = [random.randrange(12) for _ in range(random.randrange(18))]
        cases.append((actual, predicted, random.choice([1, 3, 5, 12])))
    for k in (1, 3, 5, 12):
        rows = [(a, p) for a, p, size in cases if size == k]
        df = spark.createDataFrame(rows, "a array<long>, b array<long>")
        found = df.select("a", "b", lists.average_precision(F.col("a"), F.col("b"), k).alias("ap")).collect()
        for r in found:
            assert abs(r["ap"] - python_ap(r["a"], r["b"], k)) < 1e-12
    first = spark.createDataFrame([([1, 2, 3], [1, 4, 3, 2])], "a array<long>, b array<long>")
    assert abs(first.select(lists.average_precision(F.col("a"), F.col("b"), 3)).first()[0] - 5 / 9) < 1e-12


def test_blend(spark):
    random.seed(6)
    rows = [([], [], []), ([1], [], []), ([1, 2], [2, 1], []), ([3, 3, 4], [4], [5])]
    for _ in range(200):
        rows.append(tuple([random.randrange(9) for _ in range(random.randrange(16))] for _ in range(3)))
    for weights in ((0.2, 0.3, 0.5), (1.0, 1.0, 1.0), (0.0, 0.5, 0.0)):
        for k in (3, 12):
            df = spark.createDataFrame(rows, LISTS)
            parts = list(zip((F.col("a"), F.col("b"), F.col("c")), weights, strict=True))
            for r in df.select("*", lists.blend(parts, k).alias("out")).collect():
                expected = python_blend(list(zip((r["a"], r["b"], r["c"]), weights, strict=True)), k)
                assert r["out"] == expected


def test_blend_takes_missing_lists_as_empty(spark):
    df = spark.createDataFrame([(None, [7], None)], LISTS)
    out = df.select(lists.blend([(F.col(c), 1.0) for c in "abc"], 12).alias("o")).first()["o"]
    assert out == [7]


def test_pad_left(spark):
    df = spark.createDataFrame([([],), ([1, 2],), ([1, 2, 3, 4, 5],)], "a array<long>")
    out = [r[0] for r in df.select(lists.pad_left(F.col("a"), 4)).collect()]
    assert out == [[0, 0, 0, 0], [0, 0, 1, 2], [2, 3, 4, 5]]


def test_parse_id_list(spark):
    rows = ["[1, 2]", "1 2", "['1','2']", '["1", "2"]', "", "[]", "  7,,8  ", "a b", " ".join(map(str, range(20)))]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    out = [r[0] for r in df.select(text.parse_id_list(F.col("t"), 12)).collect()]
    assert out[:8] == [["1", "2"], ["1", "2"], ["1", "2"], ["1", "2"], [], [], ["7", "8"], ["a", "b"]]
    assert out[8] == [str(i) for i in range(12)]


def test_zero_fill_and_path(spark):
    df = spark.createDataFrame([(5,), (123456789012,)], "a long")
    paths = [r[0] for r in df.select(text.image_path(F.col("a"), "/v")).collect()]
    assert paths == ["/v/images/000/0000000005.jpg", "/v/images/123/123456789012.jpg"]
