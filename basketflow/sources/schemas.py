"""Declared schemas of the three retail tables and of the published lists."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


ARTICLES = _struct(
    article_id=T.LongType(),
    product_code=T.LongType(),
    prod_name=T.StringType(),
    product_type_no=T.IntegerType(),
    product_type_name=T.StringType(),
    product_group_name=T.StringType(),
    colour_group_code=T.IntegerType(),
    colour_group_name=T.StringType(),
    department_name=T.StringType(),
    index_group_name=T.StringType(),
    section_no=T.IntegerType(),
    section_name=T.StringType(),
    garment_group_no=T.IntegerType(),
    garment_group_name=T.StringType(),
    detail_desc=T.StringType(),
)
CUSTOMERS = _struct(
    customer_id=T.StringType(),
    age=T.IntegerType(),
    FN=T.DoubleType(),
    Active=T.DoubleType(),
    club_member_status=T.StringType(),
    fashion_news_frequency=T.StringType(),
)
TRANSACTIONS = _struct(
    t_dat=T.DateType(),
    customer_id=T.StringType(),
    article_id=T.LongType(),
    price=T.DoubleType(),
    sales_channel_id=T.IntegerType(),
)
PREDICTIONS = _struct(
    customer_id=T.StringType(),
    predicted_articles=T.ArrayType(T.LongType()),
    model_name=T.StringType(),
    model_version=T.StringType(),
    model_alias=T.StringType(),
    prediction_timestamp=T.TimestampType(),
    batch_id=T.StringType(),
)
CORRUPT = "_corrupt_record"
