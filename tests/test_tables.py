"""Sources, sinks, publication, scoring and streams."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from basketflow.config import ServingTable
from basketflow.functions import encoding
from basketflow.operators import evaluate, pairs
from basketflow.operators.filters import between_dates
from basketflow.plans import propensity, retail_job, scoring
from basketflow.registry import QUERIES
from basketflow.session import materialize, scratch_path
from basketflow.sources import files, keyed, schemas, serving
from basketflow.sources.namespace import Namespace, ensure_namespace
from basketflow.sources.serving import ServingStore, parse_target, verify_tables
from basketflow.streaming.change_feed import apply_changes, change_feed
from basketflow.streaming.publish import latest_per_key, refreshed, start_refresh
from tests.conftest import SMALL
from tests.test_jobs import plan_of


def test_csv_keeps_bad_lines(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text('customer_id,age,FN,Active,club_member_status,fashion_news_frequency\n007,30,1.0,,"A, B",NONE\nx,old,,,,\n')
    df = files.read_csv(spark, str(path), schemas.CUSTOMERS, keep_corrupt=True).cache()
    rows = {r["customer_id"]: r for r in df.collect()}
    assert rows["007"]["age"] == 30 and rows["007"]["club_member_status"] == "A, B" and rows["007"]["Active"] is None
    assert rows["x"]["age"] is None and rows["x"][schemas.CORRUPT].startswith("x,old")
    inferred = files.read_csv(spark, str(path))
    assert dict(inferred.dtypes)["FN"] == "double"


def test_months_are_pruned(spark, x):
    path = scratch_path(spark, "months")
    files.write_by_month(x.t.withColumn("year_month", F.date_format("t_dat", "yyyy-MM")), path)
    df = files.read_by_month(spark, path, "2000-03-10", "2000-04-05")
    expected = between_dates(x.t, "t_dat", "2000-03-10", "2000-04-05")
    assert df.count() == expected.count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*year_month#\d+ >= 2000-03.*year_month#\d+ <= 2000-04", plan)


def test_bucketed_tables_join_without_shuffle(spark, x):
    names = []
    for label, df in {"a": x.customers, "b": x.segments}.items():
        name = f"bucketed_{label}"
        files.write_table(df, name, scratch_path(spark, name), "customer_id", 4)
        names.append(name)
    joined = spark.table(names[0]).hint("merge").join(spark.table(names[1]), "customer_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 150


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    with pytest.raises(keyed.KeyViolation):
        keyed.check_key(df, ["k"])
    with pytest.raises(keyed.KeyViolation):
        keyed.check_key(df, ["nothing"])
    with pytest.raises(keyed.KeyViolation):
        keyed.check_key(df.withColumn("k", F.lit(None).cast("long")).limit(1), ["k"])
    keyed.check_key(df, ["k", "v"])
    table = keyed.write_feature_table(df, scratch_path(spark, "ft"), ["k", "v"])
    wanted = spark.createDataFrame([(2, "c"), (9, "z")], "k long, v string")
    assert keyed.lookup_features(wanted, table, ["k", "v"]).count() == 2


def test_target_names():
    assert parse_target("my-catalog.retail.items") == ("my-catalog", "retail", "items")
    for bad in ("a.b", "a.b.c.d", "a.b-c.d", "a.b.d-e", "a.b.d;drop"):
        with pytest.raises(ValueError):
            parse_target(bad)
    names = Namespace("shared", "retail", "prod")
    assert names.table("x") == "shared.prod_retail.x" and names.source("x") == "shared.retail.x"


def test_namespace(spark):
    assert ensure_namespace(spark, "made_once", scratch_path(spark, "ns")) is True
    assert ensure_namespace(spark, "made_once") is False
    with pytest.raises(ValueError):
        ensure_namespace(spark, "not-a-name")


def test_serving(spark):
    store = ServingStore(spark, scratch_path(spark, "serving"))
    one, two = spark.range(3), spark.range(5)
    target = "shared.shop.items"
    assert not store.exists(target) and not store.drop(target)
    assert store.publish(one, target) == "published"
    assert store.publish(two, target) == "skipped" and store.read(target).count() == 3
    assert store.publish(two, target, skip_if_exists=False, policy="triggered") == "published"
    assert store.read(target).count() == 5
    with pytest.raises(keyed.KeyViolation):
        store.publish(two.union(two), target, skip_if_exists=False)
    assert store.read(target).count() == 5
    state = {r["target"]: r for r in store.status([target, "shared.shop.none"]).collect()}
    assert state[target]["policy"] == "TRIGGERED" and state[target]["primary_key"] == "id" and state[target]["num_rows"] == 5
    assert not state["shared.shop.none"]["exists"]
    report = store.publish_many(
        [ServingTable("a", "shared.shop.a"), ServingTable("b", "broken"), ServingTable("a", "shared.shop.c", ["id"], "CONTINUOUS")], {"a": one}
    )
    assert [(r["target"], r["success"]) for r in report.collect()] == [("shared.shop.a", True), ("broken", False), ("shared.shop.c", True)]
    assert store.drop(target) and not store.exists(target)


def test_a_bad_key_is_refused_before_the_copy(spark, monkeypatch):
    store, path = ServingStore(spark, scratch_path(spark, "serving")), scratch_path(spark, "source")
    files.write_table(spark.range(5_000).select((F.col("id") % 3).alias("id")), path)
    with monkeypatch.context() as patched:
        patched.setattr(serving, "write_version", lambda *_: pytest.fail("copied"))
        with pytest.raises(keyed.KeyViolation):
            store.publish(path, "shared.refused.items")
    # A key that fails behind the first rows fails in the copy.
    files.write_table(spark.range(3_000).union(spark.range(2_999, 3_000)).coalesce(1), path)
    with pytest.raises(keyed.KeyViolation):
        store.publish(path, "shared.refused.items")
    assert not store.exists("shared.refused.items")
    files.write_table(spark.range(3_000), path)
    assert store.publish(path, "shared.refused.items") == "published" and store.read("shared.refused.items").count() == 3_000


@pytest.mark.parametrize("key", ["serving_publish_many", "serving_status"])
def test_published_tables_share_one_join(spark, monkeypatch, key):
    seen, publish = {}, ServingStore.publish_many
    monkeypatch.setattr(ServingStore, "publish_many", lambda self, configs, sources: seen.update(sources) or publish(self, configs, sources))
    assert QUERIES[key](spark, SMALL).count() == 4
    assert len(seen) == 3 and not any("lineitem" in plan_of(df) for df in seen.values())


def test_missing_tables_are_named(spark, x):
    with pytest.raises(LookupError, match="nowhere"):
        verify_tables(spark, {"customers": x.customers, "nowhere": "no.such.table"})


def test_change_feed_round_trip(spark):
    schema = "k long, v string, w double"
    before = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)], schema)
    after = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (4, None, None)], schema)
    changes = change_feed(before, after, ["k"])
    assert sorted((r["k"], r["change"]) for r in changes.collect()) == [(2, "update"), (3, "delete"), (4, "insert")]
    rebuilt = apply_changes(before, changes, ["k"]).select("k", "v", "w")
    assert {tuple(r) for r in rebuilt.collect()} == {tuple(r) for r in after.collect()}
    assert change_feed(before, before, ["k"]).count() == 0


def test_refresh_restarts_and_replays(spark):
    schema = spark.createDataFrame([], "k long, at long, v string").schema
    source, target, state = (scratch_path(spark, n) for n in ("in", "out", "state"))

    def add(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def refresh():
        start_refresh(spark, source, target, state, schema, ["k"], ["at"], files_per_batch=1).awaitTermination()

    def now():
        return {(r["k"], r["at"], r["v"]) for r in refreshed(spark, target, schema, ["k"], ["at"]).collect()}

    add([(1, 1, "a"), (2, 1, "b"), (1, 2, "c")])
    add([(2, 5, "late"), (3, 1, "d")])
    refresh()
    assert now() == {(1, 2, "c"), (2, 5, "late"), (3, 1, "d")}
    refresh()
    add([(2, 3, "older than what is there"), (3, 9, "e")])
    refresh()
    assert now() == {(1, 2, "c"), (2, 5, "late"), (3, 9, "e")}
    everything = spark.read.schema(schema).parquet(source)
    assert now() == {tuple(r) for r in latest_per_key(everything, ["k"], ["at"]).select("k", "at", "v").collect()}


def test_continuous_refresh(spark):
    schema = spark.createDataFrame([], "k long, at long").schema
    source, target, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    spark.createDataFrame([(1, 1), (1, 2)], schema).write.parquet(source)
    query = start_refresh(spark, source, target, state, schema, ["k"], ["at"], policy="CONTINUOUS", interval="1 second")
    query.processAllAvailable()
    query.stop()
    assert [tuple(r) for r in refreshed(spark, target, schema, ["k"], ["at"]).collect()] == [(1, 2)]


def test_scoring_reports_every_model(spark):
    customers = spark.createDataFrame([("a", 1), ("b", 2)], "customer_id string, n int")

    def fixed(frame):
        return frame.withColumn("predicted_articles", F.array(F.lit(1), F.lit(2)))

    def failing(frame):
        return frame.withColumn("predicted_articles", F.array(F.raise_error(F.lit("out of order")).cast("long")))

    models = [
        scoring.Model("good", "1", None, failing),
        scoring.Model("good", "2", "CHAMPION", fixed),
        scoring.Model("idle", "1", "Challenger", fixed),
        scoring.Model("bad", "1", "Champion", failing),
    ]
    predictions, status = scoring.batch_scoring(customers, models, "b1", "2024-01-01 00:00:00")
    assert {(r["model_name"], r["model_version"], r["status"], r["num_predictions"]) for r in status.collect()} == {
        ("good", "2", "SUCCESS", 2), ("idle", None, "SKIPPED", 0), ("bad", "1", "FAILED", 0)
    }
    assert predictions.columns == schemas.PREDICTIONS.fieldNames() and predictions.count() == 2
    assert predictions.first()["prediction_timestamp"] == dt.datetime(2024, 1, 1)
    with pytest.raises(RuntimeError):
        scoring.batch_scoring(customers, [models[3]], "b1", "2024-01-01 00:00:00")


def test_whole_job(spark, x):
    raw, out = {}, scratch_path(spark, "job")
    for name, schema, df in (
        ("articles", schemas.ARTICLES, x.articles),
        ("customers", schemas.CUSTOMERS, x.customers),
        ("transactions", schemas.TRANSACTIONS, x.t),
    ):
        raw[name] = scratch_path(spark, f"raw-{name}")
        df.select(*schema.fieldNames()).write.option("header", True).csv(raw[name])
    tables = retail_job.ingest(spark, raw, out)
    assert tables["transactions"].select("transaction_id").distinct().count() == 6000
    summaries = retail_job.build_gold(tables, out)
    store = ServingStore(spark, scratch_path(spark, "job-serving"))
    report = retail_job.publish_all(store, {**tables, **summaries}, "shared", "job")
    assert [r["target"] for r in report.collect() if not r["success"]] == []
    assert report.count() == 7
    assert store.read("shared.job.product_sales_summary_synced").count() == 200


def test_submission_in_one_file(spark, tmp_path):
    df = spark.createDataFrame([("a", [1, 2]), ("b", [])], "customer_id string, predicted_articles array<long>")
    files.write_submission(df, str(tmp_path / "out"), single_file=True)
    parts = list((tmp_path / "out").glob("*.csv"))
    assert len(parts) == 1 and parts[0].read_text().splitlines()[:2] == ["customer_id,prediction", "a,1 2"]


def test_materialized_rows_keep_their_schema(spark):
    df = spark.createDataFrame([], "a long, b array<string>")
    assert materialize(df, "empty").schema == df.schema and materialize(df, "empty").count() == 0


def test_network_and_logistic_compete(x):
    coded = pairs.training_pairs(x.e, encoding.encode_customers(x.customers), encoding.encode_articles(x.articles))
    candidates = {"logistic": propensity.logistic(0.01, 10), "network": propensity.network(3)}
    model, report = propensity.train_propensity(coded, coded, candidates)
    rows = {r["candidate"]: r for r in report.collect()}
    assert set(rows) == set(candidates) and sum(r["is_best"] for r in rows.values()) == 1
    best = min(rows.values(), key=lambda r: r["log_loss"])
    assert best["is_best"] and 0.5 < best["accuracy"] <= 1 and best["num_pairs"] == coded.count()


def test_pairs_are_made_once_for_all_candidates(spark, monkeypatch):
    seen, train = [], propensity.train_propensity
    monkeypatch.setattr(propensity, "train_propensity", lambda *pairs: seen.extend(pairs) or train(*pairs))
    assert QUERIES["purchase_propensity"](spark, SMALL).count() == 1 + len(propensity.REGULARIZATION)
    assert len(seen) == 2 and not any("Join" in plan_of(df) for df in seen)


def test_report_without_model_names(spark):
    predicted = spark.createDataFrame([("a", [1, 2]), ("b", [3])], "customer_id string, predicted_articles array<long>")
    bought = spark.createDataFrame([("a", 2, 1), ("c", 9, 4)], "customer_id string, article_id long, copies long")
    report = evaluate.eval_report(predicted, bought).collect()
    assert len(report) == 1
    assert (report[0]["map_at_12"], report[0]["catalog_coverage"], report[0]["num_customers"]) == (0.5, 1.5, 2)
    nobody = evaluate.eval_report(predicted, bought.filter("customer_id = 'c'")).first()
    assert nobody["map_at_12"] is None and nobody["num_customers"] == 2
