"""Distributed ranks equal the window functions they replace."""

import math
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketflow.operators.filters import page_of
from basketflow.operators.ordering import with_ntiles, with_row_index
from basketflow.operators.selection import keys_at, quantiles, sorting
from basketflow.session import materialize


def heavy_ties(spark, n):
    # A third of the rows share one value.
    value = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(50)).cast("int"))
    return spark.range(n).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("key"), value.alias("v"))


@pytest.mark.parametrize("n", [0, 1, 4, 5, 7, 1000])
def test_ntile(spark, n):
    df = heavy_ties(spark, n)
    orders = {"up": [(F.col("v"), False), (F.col("key"), False)], "down": [(F.col("v"), True), (F.col("key"), False)]}
    found = {r["key"]: (r["up"], r["down"]) for r in with_ntiles(df, 5, orders).collect()}
    window = df.select("key", *[F.ntile(5).over(Window.orderBy(*sorting(o))).alias(c) for c, o in orders.items()])
    assert found == {r["key"]: (r["up"], r["down"]) for r in window.collect()}


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_row_index_does_not_depend_on_partitions(spark, parts):
    df = heavy_ties(spark, 500).repartition(parts)
    found = {r["key"]: r["i"] for r in with_row_index(df, [F.col("v"), F.col("key")], "i").collect()}
    expected = df.select("key", F.row_number().over(Window.orderBy("v", "key")).alias("i")).collect()
    assert found == {r["key"]: r["i"] for r in expected}


def test_row_index_of_nothing(spark):
    assert with_row_index(heavy_ties(spark, 0), [F.col("v"), F.col("key")], "i").count() == 0


def test_row_index_of_few_rows(spark):
    assert [r["i"] for r in with_row_index(heavy_ties(spark, 1), [F.col("key")], "i").collect()] == [1]


@pytest.mark.parametrize("page", [1, 2, 10, 99, 125, 126, 700])
def test_pages_however_deep(spark, page):
    df = heavy_ties(spark, 500)
    order = [(F.col("v"), True), (F.col("key"), False)]
    expected = [r["key"] for r in df.orderBy(*sorting(order)).collect()][4 * page - 4 : 4 * page]
    found = page_of(df, order, page, 4)
    assert [r["key"] for r in found.collect()] == expected
    limits = [int(n) for n in re.findall(r"limit=(\d+)", found._jdf.queryExecution().executedPlan().toString())]
    assert limits == [] or max(limits) <= 4


@pytest.mark.parametrize("sample", [5, 40, 10**6])
def test_keys_by_selection(spark, sample):
    value = F.when(F.col("id") % 3 == 0, 7.5).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.pmod(F.xxhash64("id"), F.lit(90)) / 4)
    df = materialize(spark.range(3000).select(value.alias("v"), F.concat(F.lit("é"), "id").alias("key")), "selection")
    for order in ([(F.col("v"), False), (F.col("key"), False)], [(F.col("v"), True), (F.col("key"), True)], [(F.col("v"), True)]):
        rows = [tuple(r) for r in df.orderBy(*sorting(order)).select(*[c for c, _ in order]).collect()]
        places = [0, 1, 700, 1500, 2999, 3000]
        assert keys_at(df, order, places, sample) == {p: rows[p] for p in places[:-1]}


@pytest.mark.parametrize("sample", [7, 10**6])
def test_quartiles_are_exact_at_any_size(spark, sample):
    df = materialize(spark.range(1001).select(F.when(F.col("id") % 4 > 0, F.pmod(F.xxhash64("id"), F.lit(50))).cast("double").alias("v")), "q")
    values = sorted(r["v"] for r in df.collect() if r["v"] is not None)
    want = [values[max(1, math.ceil(q * len(values))) - 1] for q in (0.0, 0.25, 0.5, 0.75, 1.0)]
    assert quantiles(df, "v", [0.0, 0.25, 0.5, 0.75, 1.0], sample) == want
    assert quantiles(df.filter("v is null"), "v", [0.5]) == [None]
