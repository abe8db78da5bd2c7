"""The ways taken beyond the broadcast limit and for hot keys give the same rows."""

from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketflow.operators import evaluate, labels, recommend, sequences
from basketflow.operators.skew import hot_keys, lookup_join, small_enough, with_pieces
from basketflow.session import materialize


def rows_of(df):
    return Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a tenth without a key, some keys without a match."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 400).cast("string")))
    )
    return spark.range(6000).select(key.alias("k"), F.col("id").alias("n"))


@pytest.fixture(scope="module")
def lookup(spark):
    named = spark.range(0, 300, 2).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    return named.unionByName(spark.createDataFrame([("hot", -1)], "k string, v long"))


def test_hot_keys(skewed):
    hot = {r["_hot_k"]: (r["_n"], r["_parts"]) for r in hot_keys(skewed, ["k"], 300).collect()}
    assert hot == {"hot": (2000, 7), None: (400, 2)}
    assert hot_keys(skewed.filter("k <> 'hot'"), ["k"], 300).isEmpty()
    assert hot_keys(skewed, ["k"]).isEmpty()


@pytest.mark.parametrize("limit", [40, 10**6])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_beyond_the_broadcast_limit(skewed, lookup, how, limit):
    expected = skewed.join(lookup, "k", how)
    salted = lookup_join(skewed, lookup, "k", how, spread=["n"], max_bytes=0, limit=limit)
    assert ("_salt" in salted._jdf.queryExecution().optimizedPlan().toString()) == (limit == 40)
    assert rows_of(salted) == rows_of(expected)


def test_hot_rows_are_dealt_out(spark, skewed, lookup):
    """Rows per task of the join: the 2,000 rows of the hot key do not meet in one."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)

        def largest(joined):
            return joined.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]

        assert largest(skewed.join(lookup, "k")) > 2000
        assert largest(lookup_join(skewed, lookup, "k", spread=["n"], limit=40)) < 1000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_lookup_is_broadcast_only_if_known_to_be_small(skewed, lookup):
    assert not small_enough(lookup)  # rows that came from the driver have no known size
    written = materialize(lookup, "lookup")
    assert small_enough(written) and not small_enough(written, 0)
    plan = lookup_join(skewed, written, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def pieces_of(cut):
    """First and last order key and size of each piece of the hot group, in piece order."""
    key = F.struct("d", "o")
    bounds = cut.filter("g = 'hot'").groupBy("_day", "_slot").agg(
        F.min(key).alias("lo"), F.max(key).alias("hi"), F.count("*").alias("n")
    )
    return bounds.orderBy("_day", "_slot").collect()


@pytest.mark.parametrize(("days", "expected"), [(100, 100), (1, 9), (3, 9)])
def test_pieces_follow_the_order(spark, days, expected):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 900).cast("string"))).alias("g"),
        (F.pmod(F.xxhash64("id"), F.lit(days))).alias("d"),
        F.pmod(F.col("id") * 7919, F.lit(5000)).alias("o"),
    )
    cut, hot = with_pieces(df, "g", "d", "o", limit=200)
    found = pieces_of(cut)
    assert [r["g"] for r in hot.collect()] == ["hot"] and len(found) == expected and cut.count() == 5000
    assert max(r["n"] for r in found) < 350
    assert all(a["hi"] < b["lo"] for a, b in zip(found, found[1:], strict=False))
    assert cut.filter("g <> 'hot' and (_slot <> 0 or _day is not null)").count() == 0
    whole, nothing = with_pieces(df, "g", "d", "o")
    assert nothing is None and whole.filter("_slot <> 0 or _day is not null").count() == 0


@pytest.fixture(scope="module")
def busy(spark):
    """Purchases with one customer and one article that each hold about a third of the rows."""
    return spark.range(4000).select(
        F.expr("date_add(date'2024-01-01', cast(id % 29 as int))").alias("t_dat"),
        F.when(F.col("id") % 3 == 0, "bot").otherwise(F.concat(F.lit("c"), (F.pmod(F.xxhash64("id"), F.lit(200))).cast("string"))).alias("customer_id"),
        F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) == 0, 5).otherwise(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(80))).cast("long").alias("article_id"),
        F.lit(1.0).alias("price"),
        F.col("id").alias("transaction_id"),
    )


@pytest.mark.parametrize("limit", [30, 400, 10**6])
@pytest.mark.parametrize("days", [29, 1, 3])
def test_next_pairs_with_a_hot_customer(busy, days, limit):
    few = busy.withColumn("t_dat", F.expr(f"date_add(date'2024-01-01', cast(transaction_id % {days} as int))"))
    order = Window.partitionBy("customer_id").orderBy("t_dat", "transaction_id")
    expected = few.select("article_id", F.lead("article_id").over(order).alias("next_article")).filter("next_article is not null")
    assert rows_of(recommend.next_pairs(few, limit=limit)) == rows_of(expected)


def test_next_items_beyond_the_broadcast_limit(busy):
    followers = recommend.transitions(busy)
    small = recommend.next_item_recommend(busy, followers)
    large = recommend.next_item_recommend(busy, followers, max_bytes=0)
    text = F.concat_ws(" ", "predicted_articles")
    assert rows_of(small.select("customer_id", text.alias("l"))) == rows_of(large.select("customer_id", text.alias("l")))


def test_labels_have_one_row_per_customer(busy):
    found = labels.ground_truth_labels(labels.truth_pairs(busy, "2023-12-31", "2024-01-31"))
    whole = busy.groupBy("customer_id").agg(F.sort_array(F.collect_list("article_id")).alias("l"), F.count("*").alias("n"))
    rows = {r["customer_id"]: (r["actual_articles"], r["num_purchases"]) for r in found.collect()}
    assert rows == {r["customer_id"]: (r["l"], r["n"]) for r in whole.collect()}


@pytest.mark.parametrize("limit", [30, 10**6])
def test_next_pairs_without_a_customer(busy, limit):
    """Half of the sales are anonymous: the largest key of all, and no history."""
    some = busy.withColumn("customer_id", F.when(F.col("transaction_id") % 2 == 0, F.col("customer_id")))
    order = Window.partitionBy("customer_id").orderBy("t_dat", "transaction_id")
    known = some.filter("customer_id is not null")
    expected = known.select("article_id", F.lead("article_id").over(order).alias("next_article")).filter("next_article is not null")
    assert rows_of(recommend.next_pairs(some, limit=limit)) == rows_of(expected)
    assert recommend.next_item_recommend(some, recommend.transitions(some)).filter("customer_id is null").count() == 0


@pytest.mark.parametrize("limit", [30, 10**6])
def test_pieces_of_a_missing_group(busy, limit):
    some = busy.withColumn("customer_id", F.when(F.col("transaction_id") % 2 == 0, F.col("customer_id")))
    cut, _ = with_pieces(some, "customer_id", "t_dat", "transaction_id", limit)
    assert cut.count() == some.count()
    if limit == 30:
        assert cut.filter("customer_id is null").groupBy("_day", "_slot").count().filter("count > 75").count() == 0


def test_other_models_do_not_change_with_the_limits(spark, busy):
    customers = busy.select("customer_id").distinct().withColumn("age_group", F.when(F.length("customer_id") > 2, "55+").otherwise("18-24"))
    ranked = recommend.segment_top_n(busy, customers, "2024-01-29", 30)
    text = F.concat_ws(" ", "predicted_articles").alias("l")
    small, large = (recommend.age_rules_predict(customers, ranked, max_bytes=b).select("customer_id", text) for b in (None, 0))
    assert rows_of(small) == rows_of(large)


def test_segments_beyond_the_broadcast_limit(spark, busy):
    names = F.concat(F.lit("c"), F.col("id").cast("string"))
    customers = spark.range(200).select(names.alias("customer_id"), F.when(F.col("id") % 2 == 0, "18-24").otherwise("55+").alias("age_group"))
    customers = customers.unionByName(spark.createDataFrame([("bot", "18-24")], customers.schema))
    a = recommend.segment_top_n(busy, customers, "2024-01-29", 30)
    b = recommend.segment_top_n(busy, customers, "2024-01-29", 30, max_bytes=0)
    assert rows_of(a) == rows_of(b) and a.count() == 24


def test_sequences_of_a_hot_customer(busy):
    bot = sequences.customer_sequences(busy).filter("customer_id = 'bot'").first()
    rows = busy.filter("customer_id = 'bot'").orderBy("t_dat", "transaction_id").collect()
    assert bot["sequence"] == [r["article_id"] for r in rows[-10:]] and bot["sequence_length"] == len(rows)


def test_encoding_beyond_the_broadcast_limit(busy):
    vocabulary = sequences.article_vocabulary(busy.filter("article_id <> 7"))
    found = sequences.customer_sequences(busy)
    a = sequences.pad_encode_sequences(found, vocabulary)
    b = sequences.pad_encode_sequences(found, vocabulary, max_bytes=0)
    text = F.concat_ws(" ", F.col("encoded").cast("array<string>"))
    assert rows_of(a.select("customer_id", text.alias("e"))) == rows_of(b.select("customer_id", text.alias("e")))


def test_decode_inverts_encode(busy):
    vocabulary = sequences.article_vocabulary(busy.filter("article_id <> 7"))
    coded = sequences.encode(busy.select("transaction_id", "article_id"), vocabulary, ["transaction_id"])
    back = sequences.decode(coded.withColumnRenamed("article_id", "was"), vocabulary, ["transaction_id"])
    assert back.filter("was <> 7 and not (was <=> article_id)").count() == 0
    assert back.filter("was = 7 and article_id is not null").count() == 0


def test_map_of_a_hot_customer(busy):
    pairs = labels.truth_pairs(busy, "2023-12-31", "2024-01-31")
    customers = busy.select("customer_id").distinct()
    predicted = customers.select("customer_id", F.array(*[F.lit(i).cast("long") for i in (5, 1, 5, 2, 99, 3)]).alias("predicted_articles"))
    truth = {}
    for r in busy.collect():
        truth.setdefault(r["customer_id"], []).append(r["article_id"])
    from tests.test_lists import python_ap

    found = {r["customer_id"]: r["ap"] for r in evaluate.average_precision_at_k(predicted, pairs, 5).collect()}
    assert set(found) == set(truth)
    for c, ap in found.items():
        assert abs(ap - python_ap(truth[c], [5, 1, 5, 2, 99, 3], 5)) < 1e-12
