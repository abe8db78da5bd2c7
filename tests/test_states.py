"""Logs with deletes, bitmaps that add up, searches by trigrams, pages by counted keys."""

import pathlib
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from basketflow.operators import bitmaps, dashboard, filters, text_index
from basketflow.registry import ORACLE, QUERIES, tables
from basketflow.session import materialize, scratch_path
from basketflow.sources.serving import ServingStore
from basketflow.streaming.change_feed import as_log, change_feed
from basketflow.streaming.publish import compact, list_folder, merge_log, refresh_serving, refreshed, start_refresh
from tests.conftest import SMALL
from tests.oracle import compare, connect
from tests.test_jobs import no_broadcast, plan_of  # noqa: F401 - a fixture


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def snapshots(spark, steps=6):
    rng, state, out = random.Random(9), {}, []
    for _ in range(steps):
        for k in range(30):
            if rng.random() < 0.3:
                state.pop(k, None)
            elif rng.random() < 0.4:
                state[k] = (rng.randrange(5), None if rng.random() < 0.2 else "t")
        out.append(spark.createDataFrame([(k, *v) for k, v in state.items()], "k long, v long, t string"))
    return out


def test_replayed_logs_equal_the_target_snapshot(spark):
    states = snapshots(spark)
    before, logs = states[0].limit(0), []
    for number, after in enumerate(states):
        logs.append(materialize(as_log(change_feed(before, after, ["k"]), F.lit(number)), "log"))
        before = after
    whole = logs[0]
    for log in logs[1:]:
        whole = whole.unionByName(log)
    wanted = rows_of(states[-1])
    assert rows_of(merge_log(whole, ["k"], ["version"]).drop("version")) == wanted
    assert {r.change for r in whole.select("change").distinct().collect()} == {"insert", "update", "delete"}

    source, target, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    schema, options = logs[0].schema, dict(files_per_batch=1, compact_every=2, change="change")

    def now():
        start_refresh(spark, source, target, state, schema, ["k"], ["version"], **options).awaitTermination()
        return rows_of(refreshed(spark, target, schema, ["k"], ["version"], "change").drop("version"))

    for number, log in enumerate(logs):
        log.coalesce(1).write.mode("append").parquet(source)
        assert now() == rows_of(states[number])
    # The same batches under a new checkpoint count once.
    state = scratch_path(spark, "state")
    assert now() == wanted
    store = ServingStore(spark, scratch_path(spark, "serving"))
    refresh_serving(store, "shared.log.table", target, schema, ["k"], ["version"], change="change")
    assert rows_of(store.read("shared.log.table").drop("version")) == wanted
    folders = list_folder(spark, target)
    assert all(f.startswith("snapshot") for f in folders)
    assert spark.read.parquet(f"{target}/{max(folders)}").filter("change = 'delete'").count() == 0


def test_a_log_is_a_batch_of_many_files(spark, monkeypatch):
    paths, setting = {}, "spark.sql.adaptive.coalescePartitions.enabled"
    monkeypatch.setattr(tables, "scratch_path", lambda s, label: paths.setdefault(label, scratch_path(s, label)))
    spark.conf.set(setting, "false")
    try:
        found = QUERIES["log_merge"](spark, SMALL)
        assert compare(found, connect(SMALL), ORACLE["log_merge"]) is None
    finally:
        spark.conf.unset(setting)
    logs = [f for f in list_folder(spark, paths["log-in"]) if f.startswith("part-")]
    batches = [f for f in list_folder(spark, f"{paths['log-state']}/commits") if f.isdigit()]
    assert len(batches) == 4 and len(logs) > 8


def test_kept_tombstones_hold_back_late_rows(spark):
    schema = "k long, v long, change string, version long"
    first = spark.createDataFrame([(1, 1, "insert", 1), (1, None, "delete", 5), (2, 7, "insert", 2)], schema)
    late = spark.createDataFrame([(1, 3, "update", 3), (2, 8, "update", 1)], schema)
    for keep, wanted in ((True, [2]), (False, [1, 2])):
        source, target, state = (scratch_path(spark, n) for n in ("in", "out", "state"))

        def feed(rows, keep=keep, source=source, target=target, state=state):
            rows.coalesce(1).write.mode("append").parquet(source)
            options = dict(change="change", keep_deletes=keep)
            start_refresh(spark, source, target, state, rows.schema, ["k"], ["version"], **options).awaitTermination()
            compact(spark, target, rows.schema, ["k"], ["version"], "change", keep)
            return refreshed(spark, target, rows.schema, ["k"], ["version"], "change")

        assert [r.k for r in feed(first).collect()] == [2]
        found = feed(late)
        assert sorted(r.k for r in found.collect()) == wanted
        assert {r.k: r.v for r in found.collect()}[2] == 7


def test_bitmaps_equal_counting_purchases(spark, x, no_broadcast):  # noqa: F811
    half = F.lit("2024-01-10").cast("date")
    days = [x.e.filter(F.col("t_dat") < half), x.e.filter(F.col("t_dat") >= half)]
    numbers, states = {n: None for n in bitmaps.COUNTED}, []
    for part in days:
        numbers = {n: bitmaps.value_numbers(part, c, numbers[n]) for n, c in bitmaps.COUNTED.items()}
        states.append(bitmaps.daily_state(part, numbers))
    state = bitmaps.merged(states)
    for name, column in bitmaps.COUNTED.items():
        known = [r.number for r in numbers[name].orderBy("number").collect()]
        assert known == list(range(1, x.e.select(column).distinct().count() + 1))
    for granularity in ("daily", "weekly", "monthly"):
        made = bitmaps.time_series(state, granularity, "2024-01-03", "2024-01-26")
        wanted = dashboard.time_series_exact(x.e, granularity, "2024-01-03", "2024-01-26")
        assert [(r.date, r.num_transactions, r.unique_customers, r.unique_products) for r in made.collect()] == [
            (r.date, r.num_transactions, r.unique_customers, r.unique_products) for r in wanted.collect()
        ]
        scans = set(re.findall(r"/(?:daily|numbers|positions)[^/\s,\]]*", plan_of(made)))
        assert scans and "events.parquet" not in plan_of(made) and all(s.startswith("/daily") for s in scans)


def test_daily_states_share_one_join(spark, monkeypatch):
    seen, state = [], bitmaps.daily_state
    monkeypatch.setattr(bitmaps, "daily_state", lambda t, numbers: seen.append(t) or state(t, numbers))
    assert QUERIES["time_series_from_state"](spark, SMALL).count() > 0
    assert len(seen) == 2 and not any("Join" in plan_of(t) for t in seen)


def test_bitmaps_of_any_group_and_many_blocks(spark):
    pairs = spark.range(200_000).select((F.col("id") % 7).alias("g"), F.when(F.col("id") % 11 > 0, F.col("id") % 70_001).alias("v"))
    numbers = bitmaps.value_numbers(pairs, "v")
    state = materialize(bitmaps.bitmaps(pairs.withColumn("d", F.col("g") % 3), ["g", "d"], "v", numbers), "state")
    assert state.select("block").distinct().count() == 3
    for by in (["g"], ["d"], []):
        found = {tuple(r[:-1]): r[-1] for r in bitmaps.distinct_in(state, by, "n").collect()}
        wanted = pairs.withColumn("d", F.col("g") % 3).groupBy(*by).agg(F.count_distinct("v").alias("n")).collect()
        assert found == {tuple(r[:-1]): r[-1] for r in wanted}


TEXTS = ["a red dress", "Red shoes", "dress, red", None, "", "ab", "re", "red", "rededed", "été d'été", "漢字かな 漢字", "a%b_c", "😀 red 😀", "x" * 3000 + "end"]


def test_searches_equal_contains(spark):
    rows = [(i, t, TEXTS[-1 - i % len(TEXTS)]) for i, t in enumerate(TEXTS * 30)]
    df = spark.createDataFrame(rows, "k long, name string, text string").repartition(7)
    path = scratch_path(spark, "index")
    text_index.write_index(df, "k", ["name", "text"], path)
    for search in ["red", "ress", "red dress", "R", "", "ete", "été", "漢字か", "字", "%b_", "😀 r", "red red", "xxxx", "xend", "dedede", "zzz"]:
        for columns in (["name", "text"], ["text"]):
            found = text_index.search_index(spark, path, "k", search, *columns)
            assert rows_of(found) == rows_of(df.filter(filters.contains_text(search, *columns))), search
    for limit in (0, 5):
        old, text_index.KEYS_IN_SCAN = text_index.KEYS_IN_SCAN, limit
        assert text_index.search_index(spark, path, "k", "red", "name").count() == df.filter("contains(name, 'red')").count()
        text_index.KEYS_IN_SCAN = old


def test_a_search_reads_little(spark):
    words = "alder birch cedar elm fir hazel larch maple oak pine rowan spruce willow yew".split()
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(words) + str(rng.randrange(500)) for _ in range(40))) for i in range(30_000)]
    rows[17_017] = (17_017, rows[17_017][1] + " zebrawood")
    df = spark.createDataFrame(rows, "k long, text string").repartition(8)
    path = scratch_path(spark, "index")
    text_index.write_index(df, "k", ["text"], path)
    found = text_index.search_index(spark, path, "k", "zebrawood", "text")
    assert [r.k for r in found.collect()] == [17_017]
    groups = [
        g.column(0).statistics
        for f in pathlib.Path(path, "rows").glob("*.parquet")
        for m in [pq.ParquetFile(f).metadata]
        for g in map(m.row_group, range(m.num_row_groups))
    ]
    assert len(groups) >= 6 and sum(g.min <= 17_017 <= g.max for g in groups) == 1
    buckets = {b for b, _ in text_index._parts(spark, "zebrawood")}
    assert len(buckets) <= 7 and len(list(pathlib.Path(path, "postings").glob("bucket=*"))) > 40
    plan = plan_of(text_index.candidates(spark, path, "zebrawood"))
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan) and "In(gram" in plan
    assert "In(k" in plan_of(text_index.search_index(spark, path, "k", "zebrawood", "text")) or "EqualTo(k" in plan_of(
        text_index.search_index(spark, path, "k", "zebrawood", "text")
    )


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("leading", [3, 100_000])
def test_deep_pages_are_the_rows_of_the_sorted_table(spark, monkeypatch, descending, leading):
    monkeypatch.setattr(filters, "LEADING_VALUES", leading)
    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 2, 2, 2, 2, 7]), i, "x") for i in range(500)]
    df = spark.createDataFrame(rows, "a long, b long, c string").repartition(5)
    order = [(F.col("a"), descending), (F.col("b"), False)]
    wanted = df.orderBy(F.col("a").desc() if descending else F.col("a").asc(), "b").collect()
    for page in (1, 2, 3, 9, 17, 45, 71, 72, 90):
        found = filters.page_of(df, order, page, 7, df.select("a", "b"), shallow=10).collect()
        assert found == wanted[(page - 1) * 7 : page * 7], page


def test_pages_of_the_dashboard_need_one_pass(spark, x, no_broadcast):  # noqa: F811
    page, counts = dashboard.transaction_lookup(x.t, x.articles, start="1996-01-01", page=2, known_articles=True)
    plan = plan_of(page)
    assert "TakeOrderedAndProject" in plan and "page-keys" not in plan and "BroadcastHashJoin" not in plan
    wanted = x.t.filter("t_dat >= '1996-01-01'").orderBy(F.desc("t_dat"), "transaction_id").limit(40).collect()[20:]
    assert [r.transaction_id for r in page.collect()] == [r.transaction_id for r in wanted]
    deep, _ = dashboard.transaction_lookup(x.t, x.articles, page=250, known_articles=True)
    assert deep.count() == 20


def test_pages_beyond_a_hundred_thousand_rows(spark, monkeypatch):
    rows = spark.range(300_000).select((F.col("id") % 400).alias("day"), F.col("id"), F.lit("x").alias("name"))
    written = materialize(rows, "rows")
    order = [(F.col("day"), True), (F.col("id"), False)]
    keys_written = []
    monkeypatch.setattr(filters, "materialize", lambda df, label: keys_written.append(label) or materialize(df, label))
    found = filters.page_of(written, order, 12_001, 20).collect()
    # 750 rows a day: place 240,000 is the first row of the 321st day from the end.
    assert [(r.day, r.id) for r in found[:2]] == [(79, 79), (79, 479)] and len(found) == 20 and keys_written == []


@pytest.mark.parametrize("key", ["ensemble_blend", "product_explorer", "customer_list", "transaction_lookup", "sequence_recommend", "log_merge"])
def test_queries_without_broadcast(spark, no_broadcast, key):  # noqa: F811
    found = QUERIES[key](spark, SMALL)
    assert compare(found, connect(SMALL), ORACLE[key]) is None
    assert "BroadcastHashJoin" not in plan_of(found).split("Final Plan")[-1].split("Initial Plan")[0]
