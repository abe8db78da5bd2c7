"""Clustered files, digests of snapshots, key lookups in scans, selection in many columns."""

import datetime as dt
import pathlib
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from basketflow.operators import profile, selection
from basketflow.session import materialize, scratch_path
from basketflow.sources import clustered, keyed
from basketflow.streaming import digests
from basketflow.streaming.change_feed import change_feed
from tests.test_jobs import no_broadcast, plan_of  # noqa: F401 - a fixture
from tests.test_states import rows_of


def purchases(spark, n=60_000):
    rng = random.Random(4)
    day = dt.date(2024, 1, 1)
    rows = [
        (f"c{int(rng.paretovariate(0.7)) % 3000:05d}", rng.randrange(2000), day + dt.timedelta(rng.randrange(365)), float(i), f"t{i}")
        for i in range(n)
    ]
    rows += [(None, 5, day, 1.0, "x"), ("c00001", None, day, 1.0, "y"), ("c00001", 7, None, 1.0, "z")]
    columns = "customer_id string, article_id long, t_dat date, price double, transaction_id string"
    return materialize(spark.createDataFrame(rows, columns).repartition(8), "purchases")


def matching(path, column, low, high):
    """(files, row groups, those of either whose statistics allow the value range)."""
    files, groups, some_files, some_groups = 0, 0, 0, 0
    for f in pathlib.Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        hits = 0
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            hits += s is None or not s.has_min_max or (s.min <= high and s.max >= low)
        files, groups = files + 1, groups + meta.num_row_groups
        some_files, some_groups = some_files + bool(hits), some_groups + hits
    return files, groups, some_files, some_groups


def test_clustered_files_leave_out_most_for_any_of_three(spark, no_broadcast):  # noqa: F811
    df = purchases(spark)
    plain, path = scratch_path(spark, "plain"), scratch_path(spark, "clustered")
    df.repartition(64).write.parquet(plain)
    clustered.write_clustered(df, path, files=64, row_group_bytes=1 << 16)
    assert rows_of(spark.read.parquet(path)) == rows_of(df)
    week = (dt.date(2024, 5, 6), dt.date(2024, 5, 12))
    for column, low, high in (("customer_id", "c00700", "c00700"), ("article_id", 77, 77), ("t_dat", *week)):
        files, groups, some_files, some_groups = matching(path, column, low, high)
        assert files == 64 and some_files <= files / 2 and some_groups <= groups / 2, column
        assert matching(plain, column, low, high)[2] >= 60
    chosen = clustered.read_clustered(spark, path, customer_id="c00700", t_dat=week)
    assert rows_of(chosen) == rows_of(df.filter(F.col("t_dat").between(*week) & (F.col("customer_id") == "c00700")))
    assert "PushedFilters: [" in plan_of(chosen) and "EqualTo(customer_id,c00700)" in plan_of(chosen)
    several = clustered.read_clustered(spark, path, article_id=[1, 2, 3])
    assert several.count() == df.filter("article_id in (1, 2, 3)").count()


def test_no_clustered_file_outgrows_its_rows(spark):
    df, path = purchases(spark), scratch_path(spark, "clustered")
    clustered.write_clustered(df, path, files=8, file_rows=2_000)
    rows = [pq.ParquetFile(f).metadata.num_rows for f in pathlib.Path(path).glob("*.parquet")]
    assert sum(rows) == df.count() and len(rows) >= 30 and max(rows) < 4_000


def test_interleaved_bits(spark):
    rows = spark.createDataFrame([(a, b, c) for a in range(4) for b in range(4) for c in range(4)], "a long, b long, c long")
    got = rows.withColumn("z", clustered.interleaved([F.col("a"), F.col("b"), F.col("c")], 2)).collect()
    for a, b, c, z in got:
        assert z == sum(((v >> bit) & 1) << (3 * bit + 2 - i) for i, v in enumerate((a, b, c)) for bit in range(2))


def snapshot(spark, changed=()):
    rows = [(i, i % 5, None if i % 7 == 0 else f"v{i}") for i in range(2000)]
    rows = [r for r in rows if ("delete", r[0]) not in changed]
    rows = [(k, v, "new" if ("update", k) in changed else t) for k, v, t in rows]
    rows += [(k, 1, "more") for kind, k in changed if kind == "insert"]
    random.Random(len(changed)).shuffle(rows)
    return spark.createDataFrame(rows, "k long, v long, t string").repartition(5)


def test_only_buckets_that_differ_are_read(spark):
    changed = [("delete", 17), ("update", 1003), ("insert", 5000), ("insert", -4)]
    frames = [snapshot(spark), snapshot(spark, changed)]
    paths = [scratch_path(spark, "snapshot") for _ in frames]
    marks = [digests.write_snapshot(df, path, ["k"]) for df, path in zip(frames, paths)]
    found = digests.changes_between(spark, *paths, ["k"])
    assert rows_of(found) == rows_of(change_feed(*frames, ["k"]))
    assert sorted((r.change, r.k) for r in found.collect()) == sorted(changed)
    nodes = digests.differing_buckets(*marks)
    assert 1 <= len(nodes) <= len(changed)
    plan = plan_of(found)
    assert plan.count("PartitionFilters: [") >= 2 and "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = found.inputFiles()
    assert read  # the files of the relation; which buckets are opened is in the plan's partition filters
    again = digests.write_snapshot(frames[0].repartition(3), scratch_path(spark, "again"), ["k"])
    assert digests.differing_buckets(marks[0], again) == []
    empty = digests.write_snapshot(frames[0].limit(0), scratch_path(spark, "empty"), ["k"])
    assert digests.differing_buckets(empty, empty) == [] and len(digests.differing_buckets(empty, marks[0])) > 200
    with pytest.raises(ValueError):
        digests.write_snapshot(frames[0], paths[0], ["k"], 100)


def test_digests_tell_missing_values_apart(spark):
    rows = [[(1, None, "a")], [(1, "a", None)], [(1, "", "a")], [(1, None, "a"), (1, None, "a")], [(1, "a", "a")]]
    marks = [
        digests.digests(spark.createDataFrame(r, "k long, x string, y string"), ["k"]).filter("level = 0").drop("level", "node").collect()
        for r in rows
    ]
    assert len({tuple(m) for m in marks}) == len(rows)


def test_few_keys_are_found_in_the_scan(spark, no_broadcast):  # noqa: F811
    rows = [(f"c{i:05d}", i % 9, float(i)) for i in range(20_000)]
    features = keyed.write_feature_table(spark.createDataFrame(rows, "customer_id string, part int, x double"), scratch_path(spark, "features"), ["customer_id", "part"])
    few = spark.createDataFrame([("c00070", 7, "a"), ("c00070", 7, "b"), ("c19999", None, "c"), ("none", 1, "d"), (None, None, "e")], "customer_id string, part int, note string")
    found = keyed.lookup_features(few, features, ["customer_id", "part"])
    assert found.columns == ["customer_id", "part", "note", "x"]
    assert rows_of(found) == rows_of(few.join(features, ["customer_id", "part"], "left"))
    assert "PushedFilters: [In(customer_id" in plan_of(found)
    for column, value in (("customer_id", "c00070"),):
        _, groups, _, some = matching(features.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0], column, value, value)
        assert some <= max(1, groups / 4)
    every = features.select("customer_id", "part")
    assert keyed.lookup_features(every, features, ["customer_id", "part"]).filter("x is null").count() == 0


def test_hot_keys_of_several_columns_are_dealt_out(spark, no_broadcast, monkeypatch):  # noqa: F811
    from basketflow.operators import skew

    seen = []
    deal = skew.with_parts
    monkeypatch.setattr(skew.lookup_join, "__defaults__", (*skew.lookup_join.__defaults__[:-1], 100))
    monkeypatch.setattr(skew, "with_parts", lambda df, hot, keys: seen.append(hot.count()) or deal(df, hot, keys))
    monkeypatch.setattr(keyed, "KEYS_IN_SCAN", 1)
    keys = spark.range(3000).select(F.when(F.col("id") < 2000, 1).otherwise(F.col("id")).alias("a"), F.lit(2).alias("b"), F.col("id").alias("n"))
    features = materialize(spark.range(5000).select(F.col("id").alias("a"), F.lit(2).alias("b"), (F.col("id") * 2).alias("x")), "features")
    found = keyed.lookup_features(keys, features, ["a", "b"])
    assert found.filter("x = 2 * a").count() == 3000 and seen and set(seen) == {1}


@pytest.mark.parametrize("sample", [7, 200, 100_000])
def test_quantiles_of_many_columns(spark, sample):
    rng = random.Random(3)
    rows = [
        (float(rng.randrange(9)), rng.gauss(0, 1), None, rng.expovariate(1) if rng.random() < 0.5 else None, 4.0, float("nan") if i % 50 == 0 else float(i))
        for i in range(3000)
    ]
    df = materialize(spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double"), "columns")
    shares = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = selection.quantiles_of(df, list("abcdef"), shares, sample)
    for i, c in enumerate("abcdef"):
        values = sorted((r[i] for r in rows if r[i] is not None), key=selection.in_order)
        want = [values[max(1, -int(-s * len(values) // 1)) - 1] if values else None for s in shares]
        assert list(map(repr, got[c])) == list(map(repr, want)), c


def test_passes_do_not_grow_with_the_columns(spark, monkeypatch):
    df = materialize(spark.range(40_000).select(*[((F.col("id") * p) % 40_009).cast("double").alias(f"c{p}") for p in range(1, 13)]), "wide")
    jobs = []
    samples = selection._samples
    monkeypatch.setattr(selection, "_samples", lambda *a: jobs.append(len(a[1])) or samples(*a))
    one = selection.quantiles_of(df, ["c1"], profile.QUARTILES, 3000)
    alone, jobs[:] = len(jobs), []
    every = selection.quantiles_of(df, df.columns, profile.QUARTILES, 36_000)
    assert every["c1"] == one["c1"] and len(jobs) <= alone + 1 and jobs[0] == 12
