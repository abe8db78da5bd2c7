"""Whole jobs from files to served tables, and what they must not do."""

import datetime as dt
import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketflow.config import Cutoffs
from basketflow.functions.bands import with_age_group
from basketflow.functions.dates import with_date_features
from basketflow.operators import dashboard, features, labels, recommend
from basketflow.plans import models, retail_job, scoring, splits_job, training_job
from basketflow.plans.feature_job import build_features
from basketflow.registry.common import E_CUTS
from basketflow.session import materialize, scratch_path, scratch_scope
from basketflow.sources import files, keyed, schemas
from basketflow.sources.serving import ServingStore
from basketflow.streaming.publish import compact, latest_per_key, refresh_serving, refreshed


def rows_of(df):
    return Counter(str([r[c] for c in sorted(df.columns)]) for r in df.collect())


@pytest.fixture(scope="module")
def raw(spark, x):
    """The three tables as CSV files, a few lines of them broken."""
    folder, out = scratch_path(spark, "raw"), {}
    frames = {
        "articles": x.articles.select(*schemas.ARTICLES.fieldNames()),
        "customers": x.customers.select(*schemas.CUSTOMERS.fieldNames()),
        "transactions": x.e.select(*schemas.TRANSACTIONS.fieldNames()),
    }
    for name, df in frames.items():
        out[name] = f"{folder}/{name}"
        df.write.option("header", True).csv(out[name])
    with open(f"{out['transactions']}/part-broken.csv", "w") as f:
        f.write("t_dat,customer_id,article_id,price,sales_channel_id\n2024-01-02,c,not a number,1.0,1\n")
        f.write("2024-01-02,Customer#000000001,5,1.0,1\n" * 3)
    return out


@pytest.fixture(scope="module")
def tables(spark, raw):
    return retail_job.ingest(spark, raw, scratch_path(spark, "tables"))


def test_ingest_shows_bad_lines(spark, raw, x):
    out = scratch_path(spark, "tables")
    got = retail_job.ingest(spark, raw, out)
    assert got["transactions"].count() == x.e.count() + 3
    rejects = spark.read.parquet(f"{out}/rejects/transactions").collect()
    assert [r[0] for r in rejects] == ["2024-01-02,c,not a number,1.0,1"]
    quality = {(r["table_name"], r["column_name"]): r["null_count"] for r in spark.read.parquet(f"{out}/quality").collect()}
    assert quality[("transactions", "article_id")] == 0 and quality[("customers", "age")] > 0
    with pytest.raises(retail_job.TooManyRejects):
        retail_job.ingest(spark, raw, scratch_path(spark, "tables"), max_rejected=0.001)


def test_purchase_ids_are_the_same_on_every_load(spark, raw, tables):
    again = retail_job.ingest(spark, raw, scratch_path(spark, "tables"))["transactions"]
    assert rows_of(again) == rows_of(tables["transactions"])
    ids = [r["transaction_id"] for r in again.select("transaction_id").collect()]
    assert len(set(ids)) == len(ids)
    keyed.check_key(again, ["transaction_id"])


def test_rows_that_repeat_without_limit_get_ids(spark):
    rows = spark.range(250_000).select(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"))
    got = files.with_surrogate_key(rows)
    assert got.count() == 250_000 and got.select("transaction_id").distinct().count() == 250_000
    values = spark.createDataFrame([("x", None), (None, "x"), ("x|=y", "z"), ("x", "y|=z"), ("-", None)], "a string, b string")
    assert files.with_surrogate_key(values).select("transaction_id").distinct().count() == 5


def partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)


def test_months_are_pruned_everywhere(tables, x):
    t, day = tables["transactions"], "2024-01-20"
    cuts = Cutoffs(dt.date(2024, 1, 8), dt.date(2024, 1, 15), dt.date(2024, 1, 22))
    frames = [
        recommend.recent(t, day, 7),
        recommend.popular_items(t, reference=day),
        recommend.decayed_popularity(t, day),
        labels.truth_pairs(t, "2024-01-08", "2024-01-15"),
        *labels.temporal_split(t, cuts).values(),
        labels.split_summary(t, cuts),
        dashboard.transaction_lookup(t, tables["articles"], start="2024-01-02", end="2024-01-03")[0],
        dashboard.time_series_exact(t, "daily", "2024-01-01", "2024-01-05"),
    ]
    for df in frames:
        found = partition_filters(df)
        assert any("year_month" in f for f in found), df._jdf.queryExecution().executedPlan().toString()


def test_models_do_not_see_later_purchases(x):
    everything = models.fit(x.e, x.segments, E_CUTS.train)
    known = models.fit(x.e_train, x.segments, E_CUTS.train)
    assert {k: rows_of(v) for k, v in everything.items()} == {k: rows_of(v) for k, v in known.items()}
    a = models.predict(everything, x.segments, x.e, E_CUTS.train)
    b = models.predict(known, x.segments, x.e_train, E_CUTS.train)
    assert {k: rows_of(v) for k, v in a.items()} == {k: rows_of(v) for k, v in b.items()}


@pytest.mark.parametrize("catalog", [False, True])
def test_a_bad_key_leaves_the_old_table(spark, catalog):
    path = scratch_path(spark, "features")
    name, place = ("kept_features", path) if catalog else (path, None)
    good = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    keyed.write_feature_table(good, name, ["k"], place)
    with pytest.raises(keyed.KeyViolation):
        keyed.write_feature_table(good.unionByName(good), name, ["k"], place)
    assert rows_of(files.read_table(spark, name)) == rows_of(good)
    wider = good.withColumn("w", F.lit(1.5)).filter("k = 1")
    assert rows_of(keyed.write_feature_table(wider, name, ["k"], place)) == rows_of(wider)
    assert not [n for n in os.listdir(os.path.dirname(path)) if n.startswith(os.path.basename(path) + ".")]


def test_a_snapshot_is_written_once(spark):
    store, computed = ServingStore(spark, scratch_path(spark, "serving")), spark.sparkContext.accumulator(0)
    source = spark.range(10)
    store.publish(source, "shared.once.items")
    store.publish(source.filter("id < 4"), "shared.once.items", skip_if_exists=False)
    assert store.read("shared.once.items").count() == 4 and computed.value == 0
    assert len(os.listdir(f"{store.root}/shared__once/items")) == 1


def test_equal_versions_are_told_apart(spark):
    rows = [(1, 5, v) for v in "abcdefgh"] + [(2, 1, "x")]
    df = spark.createDataFrame(rows, "k long, at long, v string")
    results = {str(sorted(map(tuple, latest_per_key(df.repartition(n), ["k"], ["at"]).collect()))) for n in (1, 3, 8)}
    assert len(results) == 1


def test_compaction_bounds_what_is_read(spark):
    schema = spark.createDataFrame([], "k long, at long, v string").schema
    target = scratch_path(spark, "target")
    for n in range(5):
        batch = spark.createDataFrame([(n % 2, n, f"v{n}"), (9, 1, "same")], schema)
        latest_per_key(batch, ["k"], ["at"]).write.parquet(f"{target}/refresh-{n:012d}")
    want = {(0, 4, "v4"), (1, 3, "v3"), (9, 1, "same")}
    state = lambda: {tuple(r) for r in refreshed(spark, target, schema, ["k"], ["at"]).collect()}
    assert state() == want
    assert compact(spark, target, schema, ["k"], ["at"]) and not compact(spark, target, schema, ["k"], ["at"])
    assert os.listdir(target) == ["snapshot-000000000004"] and state() == want
    assert refreshed(spark, target, schema, ["k"], ["at"]).count() == 3
    spark.createDataFrame([(1, 7, "new")], schema).write.parquet(f"{target}/refresh-{5:012d}")
    store = ServingStore(spark, scratch_path(spark, "serving"))
    refresh_serving(store, "shared.live.items", target, schema, ["k"], ["at"])
    assert {tuple(r) for r in store.read("shared.live.items").collect()} == {(0, 4, "v4"), (1, 7, "new"), (9, 1, "same")}
    assert store.status(["shared.live.items"]).first()["policy"] == "TRIGGERED"


def test_scratch_is_freed(spark):
    with scratch_scope(spark, "outer") as outer:
        materialize(spark.range(3), "a")
        with scratch_scope(spark, "inner") as inner:
            assert inner.startswith(outer)
            materialize(spark.range(3), "b")
        assert not os.path.exists(inner) and os.path.exists(outer)
    assert not os.path.exists(outer)


def test_from_files_to_published_predictions(spark, tables, x):
    out, cuts = scratch_path(spark, "job"), E_CUTS
    splits = splits_job.build_splits(tables["transactions"], cuts, f"{out}/splits")
    assert splits["val"].join(splits["train"], "transaction_id").count() == 0
    assert rows_of(splits["val_truth"]) == rows_of(labels.truth_pairs(tables["transactions"], *cuts.truth_window("val")))
    built = build_features(tables, cuts.train, f"{out}/features")
    assert built["customer_features"].count() == tables["customers"].count()
    segments = with_age_group(tables["customers"]).select("customer_id", "age_group")
    trained = training_job.train_models(tables["transactions"], segments, splits["val_truth"], cuts, f"{out}/models")
    assert {r["model_name"] for r in trained["comparison"].collect()} == {"popularity", "age_rules", "next_item", "ensemble"}
    popular = trained["model_popularity"]
    ready = [scoring.Model("popularity", "1", "Champion", lambda c: recommend.popularity_predict(c, popular))]
    store = ServingStore(spark, scratch_path(spark, "serving"))
    written, status = scoring.scoring_job(segments, ready, "b1", "2024-01-08 00:00:00", f"{out}/scores", store, "shared.scores.predictions")
    served = store.read("shared.scores.predictions")
    assert served.count() == written.count() == segments.count()
    assert status.first()["status"] == "SUCCESS"
    keyed.check_key(served, ["customer_id", "model_name"])


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_catalogue_is_not_shuffled_for_a_few_names(spark, x, no_broadcast):
    popularity = materialize(recommend.decayed_popularity(x.e, E_CUTS.train), "popularity")
    articles = materialize(x.articles, "articles")
    plan = plan_of(recommend.popular_details(popularity, articles))
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_small_lists_and_lookups_without_broadcast(spark, x, no_broadcast):
    ranked = materialize(recommend.segment_top_n(x.e, x.segments, E_CUTS.train), "ranked")
    predicted = recommend.age_rules_predict(x.segments, ranked)
    assert "BroadcastHashJoin" not in plan_of(predicted) and predicted.count() > 0
    wide = materialize(features.customer_windows(x.t, "2001-07-01"), "wide")
    found = keyed.lookup_features(x.customers.select("customer_id"), wide, ["customer_id"])
    assert "BroadcastHashJoin" not in plan_of(found) and found.count() == x.customers.count()


def test_dates_of_other_columns_are_not_pruned(x):
    dated = with_date_features(x.e).withColumn("other", F.col("t_dat"))
    from basketflow.operators.filters import between_dates

    assert between_dates(dated, "other", "2024-01-05", "2024-01-06").count() == x.e.filter("t_dat between '2024-01-05' and '2024-01-06'").count()
