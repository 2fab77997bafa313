"""Explicit schemas of the sources and derived tables (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CART_EVENTS = T.StructType(
    [
        T.StructField("event_dt", T.StringType()),  # YYYYMMDD
        T.StructField("userid", T.StringType()),
        T.StructField("correlation_id", T.StringType()),
        T.StructField("search_query", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("item_list_index", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("item_name", T.StringType()),
    ]
)

SEARCH_RESULTS = T.StructType(
    [
        T.StructField("SCL_CREATED_DATE", T.DateType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("correlation_id", T.StringType()),
        T.StructField("request_term", T.StringType()),
        T.StructField("response_item_number", T.StringType()),
        T.StructField("response_sku", T.StringType()),
        T.StructField("response_position", T.DoubleType()),
        T.StructField("response_name", T.StringType()),
    ]
)

USER_ITEM = T.StructType(
    [
        T.StructField("userid", T.StringType()),
        T.StructField("itemid", T.StringType()),
        T.StructField("rating", T.DoubleType()),
    ]
)

FACTORS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("features", T.ArrayType(T.DoubleType())),
    ]
)

RERANK_REQUESTS = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("userid", T.StringType()),
        T.StructField("products", T.ArrayType(T.StringType())),
    ]
)


def require_columns(df: DataFrame, columns, what: str = "input") -> DataFrame:
    """Fail fast (at plan time) when a required column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; has {df.columns}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema`` (column order and types)."""
    from pyspark.sql import functions as F

    require_columns(df, schema.fieldNames())
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
