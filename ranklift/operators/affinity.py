"""Affinity matrix (A1-A5, J1, F11, F12): cart events -> ``(userid, itemid, rating)``.

rating(u, i) = 1 + sum over active days of  n(u,i,d) / n(u,d)  +  price(u,i,d) / price(u,d)

Plan shape at scale: every aggregate is a ``groupBy`` with map-side partial
aggregation, so a hot user or item is combined before it is shuffled. The
user-day totals are a window over the item-day rows, one scan in all: its
partition holds the distinct items of one user's day. ``day_totals='join'``
re-joins totals aggregated from a second scan instead, for sources where one
user-day (a shop's own account, say) holds more items than a task should sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Window
from ..functions import ITEM_SENTINEL, parse_day, safe_div, valid_token
from ..schemas import require_columns


def valid_purchases(events: DataFrame) -> DataFrame:
    """``(event_dt, userid, itemid, price)`` of the events with valid user and item tokens."""
    require_columns(events, ["event_dt", "userid", "item_id", "price"])
    kept = events.where(valid_token("userid") & valid_token("item_id", (ITEM_SENTINEL,)))
    return kept.select("event_dt", "userid", F.col("item_id").alias("itemid"), "price")


def filter_events(events: DataFrame, window: Window) -> DataFrame:
    """Rows of the affinity query: day window and valid user/item tokens."""
    return valid_purchases(events).where(F.col("event_dt").between(window.start, window.end))


def user_item_day(events: DataFrame, window: Window) -> DataFrame:
    """A1: ``(userid, itemid, event_day, interaccion, n_items, total_price)``."""
    return item_days(filter_events(events, window))


def item_days(rows: DataFrame) -> DataFrame:
    """A1 of valid purchases."""
    return rows.groupBy(
        "userid", "itemid", parse_day("event_dt").alias("event_day")
    ).agg(
        F.lit(1).alias("interaccion"),  # COUNT(*) > 0 always holds for a group
        F.count(F.lit(1)).alias("n_items"),
        F.sum("price").alias("total_price"),
    )


def user_day_totals(uid: DataFrame) -> DataFrame:
    """A2: ``(userid, event_day, n_total_items_per_day, n_total_price_per_day)``."""
    return uid.groupBy("userid", "event_day").agg(
        F.sum("n_items").alias("n_total_items_per_day"),
        F.sum("total_price").alias("n_total_price_per_day"),
    )


def user_day_totals_from_events(events: DataFrame, window: Window) -> DataFrame:
    """A2 straight from the events: the same sums (count of rows, sum of prices,
    NULL prices skipped) with one partial aggregate to (userid, day)."""
    rows = filter_events(events, window)
    return rows.groupBy("userid", parse_day("event_dt").alias("event_day")).agg(
        F.count(F.lit(1)).alias("n_total_items_per_day"),
        F.sum("price").alias("n_total_price_per_day"),
    )


def day_weights(uid: DataFrame, day_totals: str = "join", totals: DataFrame | None = None) -> DataFrame:
    """A3 + J1: item-day rows with their day totals and the two weights.

    ``totals`` may be given (e.g. ``user_day_totals_from_events``); by default
    they are re-aggregated from ``uid``.
    """
    if day_totals == "join":
        # Inner = left here: userid is token-checked and event_day comes from a
        # non-null in-window key, so every row finds its totals.
        t = totals if totals is not None else user_day_totals(uid)
        rows = uid.join(t, ["userid", "event_day"], "inner")
    elif day_totals == "window":
        w = W.partitionBy("userid", "event_day")
        rows = uid.withColumn("n_total_items_per_day", F.sum("n_items").over(w)).withColumn(
            "n_total_price_per_day", F.sum("total_price").over(w)
        )
    else:
        raise ValueError(f"unknown day_totals {day_totals!r}")
    return rows.select(
        "userid",
        "itemid",
        "interaccion",
        "n_items",
        "total_price",
        "n_total_items_per_day",
        "n_total_price_per_day",
        "event_day",
        safe_div(F.col("n_items"), F.col("n_total_items_per_day")).alias("weight_items"),
        safe_div(F.col("total_price"), F.col("n_total_price_per_day")).alias("weight_price"),
    )


def affinity_scores(weights: DataFrame) -> DataFrame:
    """A4: ``(userid, itemid, affinity_score)`` (NULL when every price weight is NULL)."""
    return (
        weights.where(F.col("interaccion") == 1)
        .groupBy("userid", "itemid")
        .agg((F.lit(1.0) + F.sum("weight_items") + F.sum("weight_price")).alias("affinity_score"))
    )


HEAVY_ROWS = 5_000_000


def heavy_users(events: DataFrame, window: Window, heavy_rows: int = HEAVY_ROWS) -> DataFrame | None:
    """``(userid)`` of the users with more than ``heavy_rows`` events in the window (None: there
    are none); fewer than events / ``heavy_rows`` of them. Counted map-side from one column."""
    counts = filter_events(events, window).groupBy("userid").agg(F.count(F.lit(1)).alias("_n"))
    heavy = counts.where(F.col("_n") > heavy_rows).select("userid").persist()
    if heavy.head(1):
        return heavy
    heavy.unpersist()
    return None


def affinity_matrix(events: DataFrame, window: Window, day_totals: str = "window", heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Flagship: cleaned user-item matrix ``(userid, itemid, rating)``.

    NULL ratings are dropped (F12); rows are unique per (userid, itemid) by
    construction, so the reference's exact dedup is a no-op and is not planned.

    ``day_totals="by_user"``: one exchange, by user, serves the item-days, the day totals and the
    scores; users beyond ``heavy_rows`` events take the other way, which deals a user's rows by item
    and day. ``"window"`` and ``"join"``: see the module.
    """
    if day_totals == "by_user":
        heavy = heavy_users(events, window, heavy_rows)
        rows = filter_events(events, window)
        if heavy is None:
            return _by_user(rows)
        few = F.broadcast(heavy)  # fewer than events / heavy_rows users
        dealt = affinity_matrix(events.join(few, "userid", "left_semi"), window, "window")
        return _by_user(rows.join(few, "userid", "left_anti")).unionByName(dealt)
    uid = user_item_day(events, window)
    totals = user_day_totals_from_events(events, window) if day_totals == "join" else None
    return _ratings(affinity_scores(day_weights(uid, day_totals, totals)))


def _by_user(rows: DataFrame) -> DataFrame:
    uid = item_days(rows.repartition("userid"))
    return _ratings(affinity_scores(day_weights(uid, "window")))


def _ratings(scores: DataFrame) -> DataFrame:
    return scores.where(F.col("affinity_score").isNotNull()).select(
        "userid", "itemid", F.col("affinity_score").alias("rating")
    )


def matrix_stats(matrix: DataFrame, window: Window) -> DataFrame:
    """A5: days, distinct users/items, cells, density % (2 dp, half-even)."""
    agg = matrix.agg(
        F.count_distinct("userid").alias("n_users"),
        F.count_distinct("itemid").alias("n_items"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    cells = F.col("n_users") * F.col("n_items")
    return agg.select(
        F.datediff(F.to_date(F.lit(window.end_iso)), F.to_date(F.lit(window.start_iso))).alias("n_days"),
        "n_users",
        "n_items",
        cells.alias("n_cells"),
        "n_rows",
        F.bround(F.try_divide(F.col("n_rows") * 100.0, cells), 2).alias("density_pct"),
    )
