"""Physical plans: no product joins, no Python in the data path, no single-task windows, pruned scans."""

import re

import pytest

import __spark_entry__ as entry
from basketflow.operators import features, gold, recommend, sequences
from basketflow.registry.common import E_CUTS, T_CUTS
from tests.conftest import SMALL

HEAVY = [
    "average_precision_at_k",
    "batch_scoring",
    "category_insights",
    "customer_feature_set",
    "deployment_evaluation",
    "distinct_pairs",
    "ensemble_blend",
    "eval_report",
    "ground_truth_labels",
    "join_cross_pairs",
    "pad_encode_sequences",
    "prediction_enrichment",
    "product_explorer",
    "rfm_scores",
    "standardize",
    "temporal_split",
    "top_categories",
    "training_pairs",
    "transaction_lookup",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", HEAVY)
def test_no_product_join_and_no_python(spark, key):
    plan = plan_of(entry.queries()[key](spark, SMALL))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"):
        assert word not in plan


def test_the_blend_joins_once(spark):
    plan = plan_of(entry.queries()["ensemble_blend"](spark, SMALL))
    # The lists of age groups and of last articles are looked up; only their customers are joined.
    assert plan.split("Initial Plan")[0].count("customer_id") and len(re.findall(r"Join \[customer_id", plan.split("Initial Plan")[0])) == 1


def windows_on_one_task(plan):
    return re.search(r"Window .*\n(.*Sort.*\n)?.*Exchange SinglePartition", plan)


@pytest.mark.parametrize("key", ["rfm_scores", "article_vocabulary", "customer_sequences", "top_categories", "next_item_recommend"])
def test_no_window_on_one_task(spark, key):
    assert not windows_on_one_task(plan_of(entry.queries()[key](spark, SMALL)))


def test_distinct_counts_do_not_multiply_rows(x):
    for df in (gold.time_series_daily(x.t), features.customer_windows(x.t, T_CUTS.train), gold.article_sales(x.t)):
        assert "Expand" not in plan_of(df)


def test_rank_limits_apply_before_the_shuffle(x):
    for df in (
        sequences.customer_sequences(x.e),
        recommend.segment_top_n(x.e, x.segments, E_CUTS.train),
        features.top_categories(x.t, x.articles),
    ):
        plan = plan_of(df)
        assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_top_lists_do_not_sort_everything(x):
    assert "TakeOrderedAndProject" in plan_of(recommend.popular_items(x.t, reference="2001-07-01"))


def test_scans_read_only_what_they_need(x):
    plan = plan_of(gold.distinct_per(x.t.withColumn("date", x.t["t_dat"]), "date", "article_id", "n"))
    lines = [line for line in plan.splitlines() if "ReadSchema" in line and "l_partkey" in line]
    assert lines and all("l_extendedprice" not in line for line in lines)
    recent = plan_of(recommend.popular_items(x.e, reference="2024-01-08"))
    assert "PushedFilters" in recent and "EqualTo(event_type,purchase)" in recent
