"""Cleaning of the two event tables (F1-F10, A7): cart adds and impressions.

All predicates are plain Column expressions in one ``where`` so Catalyst pushes
the date and null checks into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Window
from ..functions import ITEM_SENTINEL, USER_SENTINEL, normalized_query, parse_day, valid_token, ws_trim
from ..schemas import require_columns


def _in_days(day: Column, start: Column, end: Column, window: Window) -> Column:
    return day == start if window.start == window.end else day.between(start, end)


def valid_cart_adds(events: DataFrame) -> DataFrame:
    """The cart events that the token rules keep, of any day: all columns, with ``fecha`` and the
    normalised ``search_query``."""
    require_columns(events, ["event_dt", "userid", "correlation_id", "search_query", "item_id", "item_list_index"])
    kept = events.where(
        valid_token("userid", (USER_SENTINEL,))
        & valid_token("item_id", (ITEM_SENTINEL,))
        & valid_token("correlation_id")
        & valid_token("search_query")
        & (F.length(ws_trim("search_query")) >= 3)
        & (F.col("item_list_index") >= 0)
    )
    return kept.withColumn("fecha", parse_day("event_dt")).withColumn("search_query", normalized_query("search_query"))


def clean_cart_adds(events: DataFrame, window: Window) -> DataFrame:
    """Cart adds of a day window.

    Output ``(fecha, search_query, userid, correlation_id, a2c_itemid, a2c_position)``,
    exact duplicates removed.
    """
    require_columns(events, ["event_dt"])
    in_window = _in_days(F.col("event_dt"), F.lit(window.start), F.lit(window.end), window)
    return valid_cart_adds(events.where(in_window)).select(
        "fecha",
        "search_query",
        "userid",
        "correlation_id",
        F.col("item_id").alias("a2c_itemid"),
        F.col("item_list_index").cast("double").alias("a2c_position"),
    ).dropDuplicates()


def valid_impressions(results: DataFrame) -> DataFrame:
    """The search results that the token rules keep, of any day: all columns, with the normalised
    ``search_query``. A NULL SKU is kept (it never equals an added item)."""
    require_columns(results, ["SCL_CREATED_DATE", "customer_id", "correlation_id", "request_term", "response_sku", "response_position"])
    kept = results.where(
        valid_token("customer_id", (USER_SENTINEL,))
        & valid_token("correlation_id")
        & (F.length(ws_trim("request_term")) >= 3)
    )
    return kept.withColumn("search_query", normalized_query("request_term"))


def clean_impressions(results: DataFrame, window: Window) -> DataFrame:
    """Shown results of a day window.

    Output ``(fecha, userid, correlation_id, imp_itemid, imp_position)`` with the
    position rebased to 0 (as double). Not deduplicated.
    """
    require_columns(results, ["SCL_CREATED_DATE"])
    start, end = F.to_date(F.lit(window.start_iso)), F.to_date(F.lit(window.end_iso))
    return valid_impressions(results.where(_in_days(F.col("SCL_CREATED_DATE"), start, end, window))).select(
        F.col("SCL_CREATED_DATE").alias("fecha"),
        F.col("customer_id").alias("userid"),
        "correlation_id",
        F.col("response_sku").alias("imp_itemid"),
        (F.col("response_position").cast("double") - F.lit(1.0)).alias("imp_position"),
    )
