"""Exact distinct counts that can be added up: bitmaps of numbered values per day.

A value (customer, article) has a dense number. The state holds, per day and block of 32,768 numbers,
the bitmap of the values seen that day. The distinct values of any longer period are the bits of its
days' bitmaps put together: no purchase is read again, and a new day adds its own rows only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.operators.dashboard import Day, period_of
from basketflow.operators.filters import between_dates
from basketflow.operators.gold import ratio
from basketflow.operators.ordering import with_row_index
from basketflow.operators.skew import lookup_join
from basketflow.session import materialize

# What is counted, by the name of its count.
COUNTED = {"unique_customers": "customer_id", "unique_products": "article_id"}


def value_numbers(df: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(column, number): the distinct values numbered from 1, as a written table.

    With ``known`` its numbers stay, and values it lacks get the numbers after its last: bitmaps
    made before remain right.
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    if known is None:
        return materialize(with_row_index(values, [F.col(column)], "number"), "numbers")
    last = known.agg(F.max("number")).first()[0] or 0
    fresh = with_row_index(values.join(known, column, "left_anti"), [F.col(column)], "number", last + 1)
    return materialize(known.unionByName(fresh), "numbers")


def bitmaps(pairs: DataFrame, by: list[str], column: str, numbers: DataFrame) -> DataFrame:
    """(by…, block, bits): the bitmaps of the numbers of ``column`` per group.

    Rows shrink to distinct pairs first, so a hot group is spread over its values and a hot value
    over its groups.
    """
    seen = pairs.select(*by, column).filter(F.col(column).isNotNull()).distinct()
    coded = lookup_join(seen, numbers, column, spread=by)
    block = F.bitmap_bucket_number("number").alias("block")
    return coded.groupBy(*by, block).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def distinct_in(state: DataFrame, by: list[str], name: str) -> DataFrame:
    """(by…, name): exact distinct counts of the groups ``by``, whatever finer groups ``state`` has."""
    together = state.groupBy(*by, "block").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return together.groupBy(*by).agg(F.sum("n").alias(name))


def daily_state(transactions: DataFrame, numbers: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What longer periods are made of: ``sums`` per day, and the bitmaps of each count in ``numbers``.

    Rows of a day that come later need their day built anew; days don't touch each other, so the
    states of different days are simply put together.
    """
    dated = transactions.withColumn("date", F.col("t_dat"))
    sums = dated.groupBy("date").agg(
        F.count(F.lit(1)).alias("num_transactions"), F.sum("price").alias("revenue"), F.count("price").alias("priced")
    )
    state = {"sums": materialize(sums, "daily-sums")}
    for name, table in numbers.items():
        state[name] = materialize(bitmaps(dated, ["date"], COUNTED[name], table), f"daily-{name}")
    return state


def merged(states: list[dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """The state of several sets of days."""
    return {name: reduce(DataFrame.unionByName, [s[name] for s in states]) for name in states[0]}


def time_series(
    state: dict[str, DataFrame], granularity: str = "daily", start: Day = None, end: Day = None
) -> DataFrame:
    """Exact figures per day, week or month from the daily state, as ``dashboard.time_series_exact`` has them from purchases."""
    period: Column = period_of(granularity).alias("period")
    sums = between_dates(state["sums"], "date", start, end).groupBy(period).agg(
        F.min("date").alias("date"),
        F.sum("num_transactions").alias("num_transactions"),
        F.sum("revenue").alias("total_revenue"),
        ratio(F.sum("revenue"), F.sum("priced")).alias("avg_transaction_value"),
    )
    for name in COUNTED:
        days = between_dates(state[name], "date", start, end)
        counts = distinct_in(days.withColumn("period", period_of(granularity)), ["period"], name)
        sums = sums.join(counts, "period", "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
    columns = ["date", "num_transactions", "total_revenue", *COUNTED, "avg_transaction_value"]
    return sums.select(*columns).orderBy("date")
