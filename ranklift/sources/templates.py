"""SQL templates run by Spark SQL with bound named parameters.

The three query texts live in ``sql/`` and read views that ``register_views`` makes of the two
event tables, with the token rules of ``operators.cleaning`` and ``operators.affinity`` applied once;
the texts select days, share out and aggregate. Dates are validated and bound with
``spark.sql(text, args=...)``; nothing is spliced into the text. Day and token predicates
both reach the scan of the tables below the views.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import check_day
from ..operators.affinity import valid_purchases
from ..operators.cleaning import valid_cart_adds, valid_impressions

SQL_DIR = Path(__file__).with_name("sql")
TEMPLATES = ("affinity_matrix", "add2cart", "impressions")


def register_views(cart_events: DataFrame, search_results: DataFrame) -> None:
    """The views that the templates read, over the session's event tables."""
    valid_cart_adds(cart_events).createOrReplaceTempView("valid_cart_adds")
    valid_purchases(cart_events).createOrReplaceTempView("valid_purchases")
    shown = valid_impressions(search_results)
    shown.select(
        F.col("SCL_CREATED_DATE").alias("day"),
        F.col("customer_id").alias("userid"),
        "correlation_id",
        "search_query",
        F.col("response_sku").alias("itemid"),
        F.col("response_item_number").alias("item_number"),
        F.col("response_name").alias("item_name"),
        (F.col("response_position").cast("double") - F.lit(1.0)).alias("position"),
    ).createOrReplaceTempView("valid_impressions")


def template_text(name: str) -> str:
    if name not in TEMPLATES:
        raise ValueError(f"unknown template {name!r}; expected one of {TEMPLATES}")
    return (SQL_DIR / f"{name}.sql").read_text()


def run_template(spark: SparkSession, name: str, init_date: str, end_date: str | None = None) -> DataFrame:
    args = {"init_date": check_day(init_date, "init_date"), "end_date": check_day(end_date or init_date, "end_date")}
    return spark.sql(template_text(name), args=args)


def user_item_matrix(spark: SparkSession, init_date: str, end_date: str) -> DataFrame:
    """Rows are unique by their keys; those without a rating go."""
    return run_template(spark, "affinity_matrix", init_date, end_date).na.drop("any")


def add2cart(spark: SparkSession, init_date: str, end_date: str | None = None) -> DataFrame:
    df = run_template(spark, "add2cart", init_date, end_date)
    position = F.col("item_list_index").cast("double").alias("a2c_position")
    return df.select("fecha", "search_query", "userid", "correlation_id", F.col("item_id").alias("a2c_itemid"), position).dropDuplicates()


def impressions(spark: SparkSession, init_date: str, end_date: str | None = None) -> DataFrame:
    df = run_template(spark, "impressions", init_date, end_date)
    return df.select("fecha", "userid", "correlation_id", F.col("itemid").alias("imp_itemid"), F.col("position").alias("imp_position"))
