"""Time-based splits and the purchases to predict."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.config import Cutoffs
from basketflow.functions.dates import PURCHASE_DAY, as_date, in_months
from basketflow.operators.filters import between_dates


def temporal_split(transactions: DataFrame, cutoffs: Cutoffs) -> dict[str, DataFrame]:
    """train up to the first date, val between the first two, test up to the third (it contains both)."""
    day = F.col("t_dat")
    train, val, test = (as_date(d) for d in (cutoffs.train, cutoffs.val, cutoffs.test))
    return {
        "train": between_dates(transactions, PURCHASE_DAY, end=train),
        "val": between_dates(transactions, PURCHASE_DAY, train, val).filter(day > train),
        "test": between_dates(transactions, PURCHASE_DAY, end=test),
    }


def split_summary(transactions: DataFrame, cutoffs: Cutoffs) -> DataFrame:
    """Rows, customers, articles and date range of each split that has rows.

    Membership becomes conditional counts per customer and per article, combined before the
    shuffle; the splits overlap, but no purchase is copied.
    """
    day = F.col("t_dat")
    train, val, test = (as_date(d) for d in (cutoffs.train, cutoffs.val, cutoffs.test))
    member_of = {"train": day <= train, "val": (day > train) & (day <= val), "test": day <= test}
    known = transactions.filter((day <= F.greatest(val, test)) & in_months(transactions, PURCHASE_DAY, end=F.greatest(val, test)))
    per_customer, totals, per_article, articles = [], [], [], []
    for split, member in member_of.items():
        n, first, last, bought = f"n_{split}", f"first_{split}", f"last_{split}", f"bought_{split}"
        per_customer += [
            F.count(F.when(member, 1)).alias(n),
            F.min(F.when(member, day)).alias(first),
            F.max(F.when(member, day)).alias(last),
        ]
        totals.append(
            F.struct(
                F.lit(split).alias("split"),
                F.sum(n).alias("num_transactions"),
                F.count(F.when(F.col(n) > 0, F.col("customer_id"))).alias("num_customers"),
                F.min(first).alias("first_date"),
                F.max(last).alias("last_date"),
            )
        )
        per_article.append(F.max(member).alias(bought))
        articles.append(
            F.struct(F.lit(split).alias("split"), F.count(F.when(F.col(bought), F.col("article_id"))).alias("num_articles"))
        )
    by_customer = known.groupBy("customer_id").agg(*per_customer).agg(F.array(*totals).alias("s"))
    by_article = known.groupBy("article_id").agg(*per_article).agg(F.array(*articles).alias("s"))
    return (
        by_customer.select(F.inline("s"))
        .join(F.broadcast(by_article.select(F.inline("s"))), "split")
        .filter("num_transactions > 0")
        .select("split", "num_transactions", "num_customers", "num_articles", "first_date", "last_date")
    )


def truth_pairs(transactions: DataFrame, after: dt.date | str, until: dt.date | str) -> DataFrame:
    """Purchases in ``(after, until]`` as (customer_id, article_id, copies).

    The written form of the truth, and the one evaluation works on: a customer with very many
    purchases stays spread over articles.
    """
    window = between_dates(transactions, PURCHASE_DAY, after, until).filter(F.col(PURCHASE_DAY) > as_date(after))
    return window.groupBy("customer_id", "article_id").agg(F.count(F.lit(1)).alias("copies"))


def ground_truth_labels(pairs: DataFrame) -> DataFrame:
    """One row per customer: the purchased articles as a list, repeats kept, and their number.

    For readers that want lists. A row grows with the customer's purchases, so jobs keep the pairs.
    """
    bought = F.array_sort(F.collect_list(F.struct("article_id", F.col("copies").cast("int").alias("times"))))
    repeated = F.transform("bought", lambda b: F.array_repeat(b["article_id"], b["times"]))
    return (
        pairs.groupBy("customer_id")
        .agg(bought.alias("bought"), F.sum("copies").alias("num_purchases"))
        .select("customer_id", F.flatten(repeated).alias("actual_articles"), "num_purchases")
    )


def without_purchases(customers: DataFrame, buyers: DataFrame) -> DataFrame:
    """Customers that do not occur among the buyers; repeated buyers are combined before the shuffle."""
    return customers.select("customer_id").join(buyers.select("customer_id").distinct(), "customer_id", "left_anti")


def window_coverage(customers: DataFrame, buyers: DataFrame) -> DataFrame:
    """Customers in total, with and without purchases in a window, and the share in percent."""
    flagged = customers.select("customer_id").join(
        buyers.select("customer_id").distinct().withColumn("bought", F.lit(1)), "customer_id", "left"
    )
    total, bought = F.count(F.lit(1)), F.count("bought")
    return flagged.agg(
        total.alias("total_customers"),
        bought.alias("with_purchases"),
        (total - bought).alias("without_purchases"),
        F.when(total > 0, 100.0 * bought / total).alias("purchase_rate_pct"),
    )
