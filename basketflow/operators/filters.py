"""Row selection: dates, optional equalities, text search, pages."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.functions.bands import UNKNOWN
from basketflow.functions.dates import as_date, in_months
from basketflow.operators.selection import Order, before, between_values, few_keys, in_order, keys_at, sorting
from basketflow.operators.skew import lookup_join
from basketflow.session import materialize

ALL = "ALL"
# Rows up to the end of a page that is taken in one pass, and values of a leading column that are counted.
SHALLOW = 20_000
LEADING_VALUES = 100_000


def between_dates(
    df: DataFrame, column: str, start: dt.date | str | Column | None = None, end: dt.date | str | Column | None = None
) -> DataFrame:
    """Both ends inclusive; a missing end is open. Purchases by month are read in the months between only."""
    if start is not None:
        df = df.filter((F.col(column) >= as_date(start)) & in_months(df, column, start=start))
    if end is not None:
        df = df.filter((F.col(column) <= as_date(end)) & in_months(df, column, end=end))
    return df


def equals_unless_all(choices: dict[str, str | None]) -> Column:
    """Conjunction of equalities; a choice of ``ALL`` (or none) does not restrict."""
    chosen = [F.col(c) == F.lit(v) for c, v in choices.items() if v not in (None, ALL)]
    return reduce(lambda a, b: a & b, chosen, F.lit(True))


def contains_text(search: str | None, *columns: str, wildcards: bool = False) -> Column:
    """Any column contains ``search``; ``wildcards`` lets ``%`` and ``_`` in it match as in LIKE."""
    if not search:
        return F.lit(True)
    tests = [F.col(c).like(f"%{search}%") if wildcards else F.col(c).contains(search) for c in columns]
    return reduce(lambda a, b: a | b, tests)


def known_segment(df: DataFrame, column: str = "age_group") -> DataFrame:
    return df.filter(F.col(column).isNotNull() & (F.col(column) != UNKNOWN))


def rows_with_ids(df: DataFrame, ids: DataFrame, key: str, max_bytes: int | None = None) -> DataFrame:
    """Rows whose key is among ``ids``."""
    return lookup_join(df, ids.select(key).distinct(), key, "left_semi", max_bytes=max_bytes)


def page_of(
    df: DataFrame, order: Order, page: int, page_size: int, keys: DataFrame | None = None, shallow: int = 0
) -> DataFrame:
    """One page; ``order`` must end in a unique key, or pages may overlap.

    The first page, and others that end within ``shallow`` rows, are taken in one pass, in which tasks
    keep the rows up to the page's end. Deeper ones begin at a known key, found without sorting the table: rows are counted per value
    of the leading column, and only inside the value that holds the page's first row its place is
    selected. ``keys`` may give the same rows for that, as far as ``order`` needs them, at a lower price.
    """
    place = (page - 1) * page_size
    if place == 0 or place + page_size <= shallow:
        return df.orderBy(*sorting(order)).offset(place).limit(page_size)
    first, leading = _key_at(df if keys is None else keys, order, place, page_size)
    rows = df.filter(F.lit(False)) if first is None else df.filter(leading & ~before(order, first))
    return rows.orderBy(*sorting(order)).limit(page_size)


def _key_at(keys: DataFrame, order: Order, place: int, page_size: int) -> tuple[tuple | None, Column]:
    """The key at a place, and a condition on the leading column that the page's rows meet."""
    anything = F.lit(True)
    lead, descending = order[0]
    # One more than is wanted tells that there are too many; rows are combined before the shuffle.
    counts = keys.groupBy(lead.alias("value")).agg(F.count(F.lit(1)).alias("n")).limit(LEADING_VALUES + 1).collect()
    if len(counts) > LEADING_VALUES:
        return _selected(keys, order, place), anything
    counts.sort(key=lambda r: in_order(r["value"]), reverse=descending)
    at, inside, last = 0, None, None
    for row in counts:
        if inside is None and place < at + row["n"]:
            inside = (row["value"], place - at)
        if inside is not None:
            last = row["value"]
        at += row["n"]
        if at >= place + page_size:
            break
    if inside is None:
        return None, anything
    value, rest = inside
    found = _selected(keys.filter(lead.eqNullSafe(F.lit(value))), order[1:], rest)
    return (value, *found), between_values(lead, descending, value, last)


def _selected(keys: DataFrame, order: Order, place: int) -> tuple | None:
    """The key at a place: at once among few rows, else from a written table of the keys."""
    few = few_keys(keys, order)
    if few is not None:
        return few[place] if place < len(few) else None
    names = [f"_o{i}" for i in range(len(order))]
    written = materialize(keys.select(*[c.alias(n) for n, (c, _) in zip(names, order, strict=True)]), "page-keys")
    by = [(F.col(n), descending) for n, (_, descending) in zip(names, order, strict=True)]
    return keys_at(written, by, [place]).get(place)


def page_counts(df: DataFrame, page_size: int) -> DataFrame:
    """total_count and total_pages of a filtered list."""
    total = df.agg(F.count(F.lit(1)).alias("total_count"))
    return total.withColumn("total_pages", F.ceil(F.col("total_count") / page_size).cast("long"))


def purchase_history(transactions: DataFrame, customer_id: str) -> DataFrame:
    return (
        transactions.filter(F.col("customer_id") == customer_id)
        .select("t_dat", "article_id", "price", "transaction_id")
        .orderBy("t_dat", "transaction_id")
    )


def customer_ids(transactions: DataFrame) -> DataFrame:
    return transactions.select("customer_id").distinct()
