"""Calendar columns of purchase dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


PURCHASE_DAY, MONTH = "t_dat", "year_month"


def as_date(value: Column | dt.date | str) -> Column:
    """A date column from a column, a date or an ISO string."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("date")


def days_before(reference: Column | dt.date | str, day: Column) -> Column:
    """Days from ``day`` to ``reference``; negative for later days."""
    return F.datediff(as_date(reference), day)


def in_months(
    df: DataFrame, column: str, start: Column | dt.date | str | None = None, end: Column | dt.date | str | None = None
) -> Column:
    """The same bounds on ``year_month``, by which purchases are stored, so that other months aren't read.

    True where the table has no such column, or the date is not the purchase date.
    """
    out = F.lit(True)
    if column == PURCHASE_DAY and MONTH in df.columns:
        if start is not None:
            out = out & (F.col(MONTH) >= F.date_format(as_date(start), "yyyy-MM"))
        if end is not None:
            out = out & (F.col(MONTH) <= F.date_format(as_date(end), "yyyy-MM"))
    return out


def with_date_features(transactions: DataFrame, day: str = "t_dat") -> DataFrame:
    """year, month, day, dayofweek (1 = Sunday), ISO week and year_month."""
    d = F.col(day)
    return transactions.withColumns(
        {
            "year": F.year(d),
            "month": F.month(d),
            "day": F.dayofmonth(d),
            "dayofweek": F.dayofweek(d),
            "week": F.weekofyear(d),
            "year_month": F.date_format(d, "yyyy-MM"),
        }
    )


def season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Fall")
    )


def with_seasonality(transactions: DataFrame, day: str = "t_dat") -> DataFrame:
    d = F.col(day)
    return transactions.withColumns(
        {
            "month": F.month(d),
            "quarter": F.quarter(d),
            "dayofweek": F.dayofweek(d),
            "week": F.weekofyear(d),
            "season": season(F.month(d)),
            "is_weekend": F.dayofweek(d).isin(1, 7).cast("int"),
        }
    )
