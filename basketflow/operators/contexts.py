"""Next articles from variable-order contexts: counts after the last purchases, backing off to shorter ones.

A context is the last n articles of a history, n from none to ten. It keeps how often it was followed,
by how many different articles, and its most frequent followers. A customer's articles are scored by the
contexts that their history ends in: the longest gives its followers their share, and passes the share
of a new follower (different followers / (purchases + different followers)) on to the next shorter one,
down to the empty context, which is popularity.

Histories are the encoded sequences of ``sequences.pad_encode_sequences``: vocabulary numbers, 0 for
padding and unknown articles, which no context reaches across.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.config import TOP_K
from basketflow.operators import sequences
from basketflow.operators.skew import lookup_join
from basketflow.session import materialize

MAX_ORDER = 10
# Digits at which scores are compared.
SCORE_DIGITS = 12


def context_key(order: Column, items: Column) -> Column:
    """64 bits for a context: its length and its articles."""
    return F.xxhash64(order.cast("int"), items)


def _ending_at(encoded: Column, end: Column, order: Column) -> Column:
    """The ``order`` numbers up to the position ``end`` (from 1)."""
    return F.slice(encoded, end - order + 1, order)


def _known(encoded: Column, end: Column, max_order: int) -> Column:
    """How many numbers up to ``end`` are articles without a gap, at most ``max_order``."""
    reversed_items = F.reverse(F.slice(encoded, F.greatest(end - max_order + 1, F.lit(1)), F.least(end, F.lit(max_order))))
    gap = F.array_position(reversed_items, F.lit(sequences.PADDING).cast("long"))
    return F.when(gap == 0, F.size(reversed_items)).otherwise(gap - 1).cast("int")


def _contexts(rows: DataFrame, end: Column, max_order: int) -> DataFrame:
    """Each row once per context that ends at ``end``, with ``order`` and ``context``."""
    longest = F.when(end > 0, _known(F.col("encoded"), end, max_order)).otherwise(0)
    orders = rows.withColumn("order", F.explode(F.sequence(F.lit(0), longest)))
    items = F.when(F.col("order") > 0, _ending_at(F.col("encoded"), end, F.col("order")))
    return orders.withColumn("context", context_key(F.col("order"), F.coalesce(items, F.array().cast("array<long>"))))


def fit_contexts(encoded: DataFrame, max_order: int = MAX_ORDER, top_n: int = TOP_K) -> DataFrame:
    """(context, order, times, kinds, followers) from rows with ``encoded``.

    Every article of a sequence is an example of what follows the articles before it. ``times`` and
    ``kinds`` count all followers; the ``top_n`` most frequent are kept, ties by number. Counts are
    combined before the shuffle, and a context's followers are at most the vocabulary.
    """
    steps = encoded.select("encoded", F.posexplode("encoded").alias("before", "follower"))
    steps = steps.filter(F.col("follower") != sequences.PADDING)
    # A position counted from 0 is the number of items before it.
    placed = _contexts(steps, F.col("before"), max_order)
    counts = placed.groupBy("context", "order", "follower").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "context-counts")
    sums = counts.groupBy("context", "order").agg(F.sum("n").alias("times"), F.count(F.lit(1)).alias("kinds"))
    order = Window.partitionBy("context").orderBy(F.col("n").desc(), "follower")
    best = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_n)
    kept = F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "n", "follower"))), lambda f: F.struct(f["n"].alias("n"), f["follower"].alias("follower"))
    )
    return sums.join(best.groupBy("context").agg(kept.alias("followers")), "context")


def _scores(levels: Column) -> Column:
    """Scored followers of all levels, longest context first."""
    start = F.struct(F.lit(1.0).alias("share"), F.array().cast("array<struct<score:double,follower:bigint>>").alias("found"))

    def add(state: Column, level: Column) -> Column:
        whole = (level["times"] + level["kinds"]).cast("double")
        scored = F.transform(
            level["followers"],
            lambda f: F.struct((state["share"] * f["n"] / whole).alias("score"), f["follower"].alias("follower")),
        )
        return F.struct(
            (state["share"] * level["kinds"] / whole).alias("share"), F.concat(state["found"], scored).alias("found")
        )

    return F.aggregate(levels, start, add)["found"]


def _best(scored: Column, top_k: int) -> Column:
    """The ``top_k`` followers by summed score, ties by number."""
    different = F.array_distinct(F.transform(scored, lambda s: s["follower"]))

    def total(follower: Column) -> Column:
        own = F.filter(scored, lambda s: s["follower"] == follower)
        return F.round(F.aggregate(own, F.lit(0.0), lambda acc, s: acc + s["score"]), SCORE_DIGITS)

    ranked = F.array_sort(F.transform(different, lambda f: F.struct((-total(f)).alias("minus"), f.alias("follower"))))
    return F.transform(F.slice(ranked, 1, top_k), lambda s: s["follower"])


def predict_contexts(
    encoded: DataFrame, fitted: DataFrame, max_order: int = MAX_ORDER, top_k: int = TOP_K, max_bytes: int | None = None
) -> DataFrame:
    """(customer_id, follower_numbers): the best next articles of each customer, as vocabulary numbers.

    The empty context is one row for everybody and joins nothing. An article that ends a large share
    of the histories is a hot key of the join and is dealt out.
    """
    rows = encoded.select("customer_id", "encoded")
    placed = _contexts(rows, F.size("encoded"), max_order).filter(F.col("order") > 0).select("customer_id", "context")
    model = fitted.select("context", F.struct("order", "times", "kinds", "followers").alias("level"))
    found = lookup_join(
        placed, model.filter("level.order > 0"), "context", "inner", spread=["customer_id"], max_bytes=max_bytes
    )
    # At most max_order levels each.
    levels = found.groupBy("customer_id").agg(F.collect_list("level").alias("levels"))
    kind = levels.schema["levels"].dataType
    last = _empty_context(fitted).cast(kind)
    joined = rows.select("customer_id").join(levels, "customer_id", "left")
    longest_first = F.reverse(F.array_sort(F.coalesce("levels", F.array().cast(kind))))
    scored = joined.select("customer_id", _scores(F.concat(longest_first, last)).alias("scored"))
    return scored.select("customer_id", _best(F.col("scored"), top_k).alias("follower_numbers"))


def _empty_context(fitted: DataFrame) -> Column:
    """The one level of the empty context as a literal, or no level if nothing was learned."""
    row = fitted.filter(F.col("order") == 0).first()
    if row is None:
        return F.array()
    followers = F.array(*[F.struct(F.lit(f["n"]).alias("n"), F.lit(f["follower"]).alias("follower")) for f in row["followers"]])
    values = [F.lit(row[c]).alias(c) for c in ("order", "times", "kinds")]
    return F.array(F.struct(*values, followers.alias("followers")))


def histories(transactions: DataFrame, vocabulary: DataFrame, length: int = MAX_ORDER, min_length: int = 1) -> DataFrame:
    """(customer_id, encoded) of each customer with at least ``min_length`` purchases; others have none."""
    known = transactions.filter(F.col("customer_id").isNotNull())
    return sequences.pad_encode_sequences(sequences.customer_sequences(known, length, min_length), vocabulary, length)


def fit(transactions: DataFrame, max_order: int = MAX_ORDER, top_n: int = TOP_K) -> dict[str, DataFrame]:
    """The tables of the model: contexts, and the vocabulary their numbers belong to."""
    vocabulary = materialize(sequences.article_vocabulary(transactions), "vocabulary")
    examples = histories(transactions, vocabulary, max_order + 1, 2)
    return {"contexts": materialize(fit_contexts(examples, max_order, top_n), "contexts"), "vocabulary": vocabulary}


def sequence_recommend(
    transactions: DataFrame, fitted: dict[str, DataFrame], max_order: int = MAX_ORDER, top_k: int = TOP_K
) -> DataFrame:
    """(customer_id, predicted_articles) for every customer with a purchase."""
    rows = histories(transactions, fitted["vocabulary"], max_order)
    numbers = predict_contexts(rows, fitted["contexts"], max_order, top_k)
    items = numbers.select("customer_id", F.posexplode("follower_numbers").alias("at", "article_index"))
    named = sequences.decode(items, fitted["vocabulary"], ["customer_id", "at"])
    in_order = F.array_sort(F.collect_list(F.struct("at", "article_id")))
    return named.groupBy("customer_id").agg(F.transform(in_order, lambda s: s["article_id"]).alias("predicted_articles"))
