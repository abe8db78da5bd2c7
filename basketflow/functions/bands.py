"""Age bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values: (upper edge, exclusive; label). ``None`` is open-ended.
AGE_GROUPS = [
    (18, "Under 18"),
    (25, "18-24"),
    (35, "25-34"),
    (45, "35-44"),
    (55, "45-54"),
    (None, "55+"),
]
AGE_BINS = [
    (20, "<20"),
    (30, "20-29"),
    (40, "30-39"),
    (50, "40-49"),
    (60, "50-59"),
    (None, "60+"),
]
EVALUATION_AGE_GROUPS = [
    (25, "18-24"),
    (35, "25-34"),
    (45, "35-44"),
    (55, "45-54"),
    (65, "55-64"),
    (None, "65+"),
]
UNKNOWN = "Unknown"


def band(value: Column, edges: list[tuple[int | None, str]]) -> Column:
    """Label of the right-open band that holds ``value``; null for a null value."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for upper, label in edges:
        inside = F.lit(True) if upper is None else value < upper
        out = out.when(inside, label)
    return out


def age_group(age: Column) -> Column:
    return F.coalesce(band(age, AGE_GROUPS), F.lit(UNKNOWN))


def age_bin(age: Column) -> Column:
    return F.coalesce(band(age, AGE_BINS), F.lit(UNKNOWN))


def age_group_eval(age: Column) -> Column:
    """Bands of the evaluation fallback; null below zero and for missing ages."""
    return F.when(age >= 0, band(age, EVALUATION_AGE_GROUPS))


def with_age_group(customers: DataFrame) -> DataFrame:
    return customers.withColumn("age_group", age_group(F.col("age")))
