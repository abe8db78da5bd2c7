"""Bands, encodings, windows and pairs on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketflow.config import PairSampling
from basketflow.functions import bands, encoding
from basketflow.operators import dashboard, features, filters, gold, labels, pairs, profile, recommend, sequences
from basketflow.plans import feature_job
from basketflow.registry.common import T_CUTS
from basketflow.registry.rows import _candidates
from basketflow.session import scratch_path


def test_band_edges(spark):
    ages = [None, -1, 0, 17, 18, 19, 20, 24, 25, 29, 30, 34, 35, 44, 45, 54, 55, 59, 60, 64, 65, 100]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    out = df.select(
        "age",
        bands.age_group(F.col("age")).alias("g"),
        bands.age_bin(F.col("age")).alias("b"),
        bands.age_group_eval(F.col("age")).alias("e"),
    )
    found = {r["age"]: (r["g"], r["b"], r["e"]) for r in out.collect()}
    assert found[None] == ("Unknown", "Unknown", None)
    assert found[-1] == ("Under 18", "<20", None)
    assert found[17][0] == "Under 18" and found[18][0] == "18-24" and found[24][0] == "18-24"
    assert found[25] == ("25-34", "20-29", "25-34")
    assert found[55] == ("55+", "50-59", "55-64") and found[65] == ("55+", "60+", "65+")
    assert found[0][2] == "18-24"


def test_missing_subscription_counts_as_subscribed(spark):
    rows = [("a", None, None, None, None), ("b", 30, 0.0, 1.0, "ACTIVE"), ("c", 31, 1.0, None, "LEFT CLUB")]
    df = spark.createDataFrame(rows, "customer_id string, age int, FN double, Active double, club_member_status string")
    out = {r["customer_id"]: tuple(r)[1:] for r in encoding.encode_customers(df).collect()}
    assert out == {"a": (0, 1, 0.0, 0), "b": (30, 0, 1.0, 1), "c": (31, 1, 0.0, 0)}


def test_future_purchases_fall_into_windows_unless_filtered(spark):
    rows = [(dt.date(2024, 1, d), "a", 1, 2.0) for d in (1, 5, 20)]
    df = spark.createDataFrame(rows, "t_dat date, customer_id string, article_id long, price double")
    out = features.customer_windows(df, "2024-01-06").first()
    assert (out["purchases_7d"], out["purchases_lifetime"], out["unique_items_7d"]) == (3, 3, 1)
    cut = features.customer_windows(df.filter("t_dat <= '2024-01-06'"), "2024-01-06").first()
    assert cut["purchases_7d"] == 2


def test_missing_price_is_no_part_of_the_mean(spark):
    rows = [(dt.date(2024, 1, 5), "a", 1, 2.0), (dt.date(2024, 1, 5), "a", 1, None), (dt.date(2024, 1, 5), "b", 2, None)]
    df = spark.createDataFrame(rows, "t_dat date, customer_id string, article_id long, price double")
    out = {r["customer_id"]: r for r in features.customer_windows(df, "2024-01-06").collect()}
    assert out["a"]["avg_price_7d"] == 2.0 and out["b"]["avg_price_7d"] is None
    sales = {r["article_id"]: r for r in gold.article_sales(df).collect()}
    assert sales[1]["avg_price"] == 2.0 and sales[1]["num_transactions"] == 2 and sales[2]["avg_price"] is None
    daily = gold.time_series_daily(df).first()
    assert daily["num_transactions"] == 3 and daily["avg_transaction_value"] == 2.0


@pytest.mark.parametrize("parts", [1, 7, 60])
def test_features_do_not_depend_on_partitions(x, parts):
    few = ["customer_id", "purchases_30d", "unique_items_lifetime", "rfm_score"]
    base = {tuple(r) for r in features.customer_feature_set(x.t_train, x.customers, T_CUTS.train).select(few).collect()}
    other = features.customer_feature_set(x.t_train.repartition(parts), x.customers, T_CUTS.train)
    assert {tuple(r) for r in other.select(few).collect()} == base


def test_approximate_daily_is_close(x):
    exact = {r["date"]: r for r in gold.time_series_daily(x.t).collect()}
    for r in gold.time_series_daily(x.t, approximate=True).collect():
        assert abs(r["unique_customers"] - exact[r["date"]]["unique_customers"]) <= 1
        assert r["num_transactions"] == exact[r["date"]]["num_transactions"]


def test_splits_are_disjoint_where_they_should_be(x):
    parts = labels.temporal_split(x.t, T_CUTS)
    assert parts["train"].join(parts["val"], "transaction_id").count() == 0
    inside = parts["train"].count() + parts["val"].count()
    assert parts["test"].join(parts["train"].unionByName(parts["val"]), "transaction_id").count() == inside


def test_truth_starts_after_the_cutoff(x):
    a = labels.truth_pairs(x.t, "2001-07-15", "2001-07-22").agg(F.sum("copies")).first()[0]
    assert a == x.t.filter("t_dat > '2001-07-15' and t_dat <= '2001-07-22'").count()


def test_literal_training_sequences_have_no_target(x):
    assert sequences.training_sequences(x.e, 3, 1, literal=True).filter("size(target_articles) > 0").count() == 0
    cut = sequences.training_sequences(x.e, 3, 2)
    assert cut.filter("size(input_sequence) <> 3 or size(target_articles) <> 2").count() == 0 and cut.count() > 0


def test_negatives_are_exact(x):
    sampling = PairSampling(negative_ratio=3.0)
    found = pairs.training_pairs(
        x.e, encoding.encode_customers(x.customers), encoding.encode_articles(x.articles), sampling
    )
    counts = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
    assert counts[0] == 3 * counts[1]
    assert found.select("customer_id", "article_id").distinct().count() == sum(counts.values())
    bought = pairs.distinct_pairs(x.e)
    assert found.filter("label = 0").join(bought, ["customer_id", "article_id"], "left_semi").count() == 0


def test_a_customer_who_bought_nearly_everything_gets_what_is_left(spark):
    articles = spark.range(10).select(F.col("id").alias("article_id"))
    bought = spark.range(8).select(F.lit("a").alias("customer_id"), F.col("id").alias("article_id"), F.lit(1).alias("label"))
    everything = spark.range(10).select(F.lit("b").alias("customer_id"), F.col("id").alias("article_id"), F.lit(1).alias("label"))
    both = bought.unionByName(everything)
    left = pairs.negatives(both, both, articles, 2.0)
    assert sorted(tuple(r) for r in left.collect()) == [("a", 8), ("a", 9)]


def test_sample_does_not_depend_on_partitions(x):
    keys = ["customer_id", "article_id"]
    bought = pairs.distinct_pairs(x.t)
    a = {tuple(r) for r in pairs.capped_sample(bought, keys, 1000).collect()}
    b = {tuple(r) for r in pairs.capped_sample(bought.repartition(13), keys, 1000).collect()}
    assert a == b and 850 < len(a) < 1150
    assert pairs.capped_sample(bought, keys, 10**9).count() == bought.count()


def test_candidates_are_distinct(x):
    found = _candidates(x)
    assert found.distinct().count() == found.count() > 0


def test_standardize(x):
    coded = pairs.training_pairs(x.e, encoding.encode_customers(x.customers), encoding.encode_articles(x.articles))
    scaled = pairs.standardize(coded, coded)
    for r in profile.feature_stats(scaled, encoding.FEATURES).collect():
        assert abs(r["mean"]) < 1e-9 and (abs(r["std"] - 1) < 0.01 or r["std"] == 0)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "v double")
    out = {r["bin"]: r["n"] for r in profile.feature_histogram(df, "v", 10).collect()}
    assert sum(out.values()) == 3 and out[0] == 1 and out[5] == 1 and out[9] == 1
    constant = profile.feature_histogram(df.filter("v = 5"), "v", 4).collect()
    assert sum(r["n"] for r in constant) == 1 and constant[0]["bin_start"] == 4.5


def test_age_rules_variants(spark):
    segments = spark.createDataFrame([("a", "18-24"), ("b", "Unknown"), ("c", None)], "customer_id string, age_group string")
    ranked = spark.createDataFrame([("18-24", 9, 3, 1), ("18-24", 4, 2, 2)], "age_group string, article_id long, segment_purchases long, rank int")
    popular = spark.createDataFrame([(1, 7), (2, 8)], "rank int, article_id long")

    def lists_of(**options):
        return {r["customer_id"]: r["predicted_articles"] for r in recommend.age_rules_predict(segments, ranked, **options).collect()}

    assert lists_of() == {"a": [9, 4]}
    assert lists_of(keep_empty=True) == {"a": [9, 4], "b": [], "c": []}
    assert lists_of(fallback=popular) == {"a": [9, 4], "b": [7, 8], "c": [7, 8]}


def test_open_end_keeps_later_purchases(x):
    closed = recommend.recent(x.e, "2024-01-08", 7).agg(F.max("t_dat")).first()[0]
    opened = recommend.recent(x.e, "2024-01-08", 7, open_end=True).agg(F.max("t_dat")).first()[0]
    assert closed <= dt.date(2024, 1, 8) < opened


def test_filters(spark):
    df = spark.createDataFrame([("a%b", None), ("ab", "x"), ("axb", "y")], "s string, c string")
    assert df.filter(filters.contains_text("a%b", "s")).count() == 1
    assert df.filter(filters.contains_text("a%b", "s", wildcards=True)).count() == 3
    assert df.filter(filters.contains_text("", "s")).count() == 3
    assert df.filter(filters.contains_text("x", "s", "c")).count() == 2
    assert df.filter(filters.equals_unless_all({"c": "ALL"})).count() == 3


def test_pages_cover_everything_once(x):
    sales = gold.article_sales(x.t)
    seen = []
    for page in range(1, 6):
        rows, counts = dashboard.product_explorer(x.articles, sales, page=page, page_size=50)
        seen += [r["article_id"] for r in rows.collect()]
    total = counts.first()
    assert total["total_count"] == 200 and total["total_pages"] == 4 and sorted(seen) == list(range(200))


def test_bestseller_limit_is_checked(x):
    with pytest.raises(ValueError):
        dashboard.bestsellers(x.articles, x.articles, limit=101)


def test_enrichment_of_one_customer_is_newest_first(spark, x):
    rows = [("c", "1 2", "old", "2024-01-01 00:00:00"), ("c", "[3, zz]", "new", "2024-02-01 00:00:00"), ("d", "1", "old", "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "customer_id string, predicted_articles string, model_name string, ts string")
    df = df.select("customer_id", "predicted_articles", "model_name", F.lit("1").alias("model_version"), F.lit("Champion").alias("model_alias"), F.col("ts").cast("timestamp").alias("prediction_timestamp"), F.lit("b").alias("batch_id"))
    for limit in (None, 0):
        out = dashboard.prediction_enrichment(df, x.articles, "c", max_bytes=limit).collect()
        assert [(r["model_name"], r["position"], r["article_id"]) for r in out] == [("new", 0, "3"), ("new", 1, "zz"), ("old", 0, "1"), ("old", 1, "2")]
        assert out[1]["name"] == "Unknown Item (zz)" and out[1]["category"] == "Unknown"
        assert out[1]["image_path"] == "/volume/images/000/0000000000.jpg"


def test_feature_job_equals_the_separate_features(spark, x):
    tables = {"transactions": x.t, "customers": x.customers, "articles": x.articles}
    built = feature_job.build_features(tables, T_CUTS.train, scratch_path(spark, "feature-job"))
    alone = features.article_feature_set(x.t_train, x.articles, T_CUTS.train)
    few = ["article_id", "popularity_30d", "unique_customers_lifetime", "days_since_last_sale"]
    assert {tuple(r) for r in built["article_features"].select(few).collect()} == {tuple(r) for r in alone.select(few).collect()}
    alone = features.customer_feature_set(x.t_train, x.customers, T_CUTS.train)
    few = ["customer_id", "purchases_30d", "unique_items_lifetime", "rfm_score"]
    assert {tuple(r) for r in built["customer_features"].select(few).collect()} == {tuple(r) for r in alone.select(few).collect()}
