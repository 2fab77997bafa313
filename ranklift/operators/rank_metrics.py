"""Offline rank metrics (J5, W1-W3, W6-W7, A11, A13, X1): NDCG@k, MAP@k, MAR@k.

Candidates are the distinct users and items of the test matrix that have factor
vectors (J5); every candidate item is scored for every candidate user by the
block scorer (``scoring.py``), which keeps only per-user top-k material.

* NDCG@k: gain = rating (0 when not rated), discount 1/log2(rank+1), score ties
  averaged (a tie group spanning ranks s..e contributes its mean gain times the
  discounts of s..min(e, k)); ideal DCG from the true ratings cut at k.
* MAP@k: relevant = the user's top-k by rating (ties: itemid asc); AP = sum of
  precision at each hit / number of hits (0 without hits).
* MAR@k: |top-k predicted intersect relevant| / |relevant|.

All three are averaged over candidate users. Per-user windows are bounded by
k x item blocks rows (``WindowGroupLimit`` trims before the shuffle).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scoring import score_top_levels


def discounts(k: int) -> list[float]:
    """1/log2(j+1) for j = 1..k."""
    return [1.0 / math.log2(j + 1) for j in range(1, k + 1)]


def cumulative_discounts(k: int) -> list[float]:
    """C[0..k]: C[j] = sum of the first j discounts."""
    out, acc = [0.0], 0.0
    for d in discounts(k):
        acc += d
        out.append(acc)
    return out


def _lit_array(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def known_pairs(matrix: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Rows whose user and item both have factor vectors."""
    return matrix.join(users.select(F.col("id").alias("userid")), "userid", "left_semi").join(
        items.select(F.col("id").alias("itemid")), "itemid", "left_semi"
    )


def known_pairs_report(matrix: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """J5 report: distinct users/items before, how many were unknown (and %), rows kept."""
    flagged = matrix.join(users.select(F.col("id").alias("userid"), F.lit(True).alias("_ku")), "userid", "left").join(
        items.select(F.col("id").alias("itemid"), F.lit(True).alias("_ki")), "itemid", "left"
    )
    ku, ki = F.col("_ku").isNotNull(), F.col("_ki").isNotNull()
    agg = flagged.agg(
        F.count_distinct("userid").alias("n_users"),
        F.count_distinct(F.when(~ku, F.col("userid"))).alias("n_users_removed"),
        F.count_distinct("itemid").alias("n_items"),
        F.count_distinct(F.when(~ki, F.col("itemid"))).alias("n_items_removed"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(ku & ki, 1).otherwise(0)).cast("bigint").alias("n_rows_kept"),
    )
    return agg.select(
        "*",
        F.round(F.col("n_users_removed") * 100.0 / F.col("n_users"), 2).alias("pct_users_removed"),
        F.round(F.col("n_items_removed") * 100.0 / F.col("n_items"), 2).alias("pct_items_removed"),
    )


def top_k_by(df: DataFrame, k: int, order: list[Column], rank_col: str = "rank", key: str = "userid") -> DataFrame:
    """``row_number() <= k`` per ``key`` (planned as a WindowGroupLimit)."""
    w = W.partitionBy(key).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def topk_relevant(known: DataFrame, k: int) -> DataFrame:
    """``(userid, rank, itemid, rating)`` by rating desc, itemid asc."""
    return top_k_by(known, k, [F.col("rating").desc(), F.col("itemid")]).select("userid", "rank", "itemid", "rating")


def topk_lists(ranked: DataFrame, value: str = "itemid") -> DataFrame:
    """Per user the ranked ids as one comma-separated string (no 0 padding)."""
    return ranked.groupBy("userid").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", value))), lambda s: s[value]), ","
        ).alias("items"),
    )


class Scored:
    """Scored candidates of one (test matrix, factors, metric, k)."""

    def __init__(self, known: DataFrame, users: DataFrame, items: DataFrame, k: int, metric: str, **block_opts):
        self.k = int(k)
        # Small and read by every branch (candidates, relevance, ideal DCG).
        self.known = known = known.persist()
        cand_users = users.select(F.col("id").alias("userid"), "features").join(
            known.select("userid").distinct(), "userid", "left_semi"
        )
        cand_items = items.select(F.col("id").alias("itemid"), "features").join(
            known.select("itemid").distinct(), "itemid", "left_semi"
        )
        self.users = cand_users
        self.items = cand_items
        # Every id of ``known`` has a vector, so one pass over it sizes both sides.
        sizes = known.agg(F.count_distinct("userid").alias("u"), F.count_distinct("itemid").alias("i")).first()
        block_opts.setdefault("n_users", int(sizes["u"]))
        block_opts.setdefault("n_items", int(sizes["i"]))
        # Read by both the item and the level merges: keep one scoring pass.
        behind: list[DataFrame] = []
        self.raw = score_top_levels(cand_users, cand_items, known, self.k, metric, cached=behind, **block_opts).persist()
        self._cached = [self.raw, *reversed(behind), known]

    def unpersist(self) -> None:
        """Drops the cached frames, once everything read from them is computed."""
        for df in self._cached:
            df.unpersist()

    def top_items(self) -> DataFrame:
        """``(userid, rank, itemid, score)`` best first (ties: itemid asc)."""
        rows = self.raw.where(F.col("itemid").isNotNull())
        return top_k_by(rows, self.k, [F.col("key").desc(), F.col("itemid")]).select("userid", "rank", "itemid", "score")

    def scan_report(self) -> DataFrame:
        """How many (user, item block) pairs were scored, of how many; the others were ruled out
        by the lengths of the vectors."""
        pairs = self.raw.where(F.col("userid").isNull())
        total, scored = F.coalesce(F.sum("gain"), F.lit(0.0)), F.coalesce(F.sum("cnt"), F.lit(0))
        return pairs.agg(total.cast("bigint").alias("n_pairs"), scored.cast("bigint").alias("n_scored"), (1 - F.try_divide(scored, total)).alias("share_skipped"))

    def levels(self) -> DataFrame:
        """Score levels starting within the top k: ``(userid, level_start, level_key, n_items, gain_sum)``."""
        rows = self.raw.where(F.col("userid").isNotNull() & F.col("itemid").isNull())
        merged = rows.groupBy("userid", "key").agg(F.sum("cnt").alias("n_items"), F.sum("gain").alias("gain_sum"))
        before = F.sum("n_items").over(
            W.partitionBy("userid").orderBy(F.col("key").desc()).rowsBetween(W.unboundedPreceding, -1)
        )
        out = merged.withColumn("level_start", F.coalesce(before, F.lit(0)) + 1).where(F.col("level_start") <= self.k)
        return out.select("userid", "level_start", F.col("key").alias("level_key"), "n_items", "gain_sum")

    def ndcg(self) -> DataFrame:
        """Per user ``(userid, dcg, idcg, ndcg)``."""
        k = self.k
        C = _lit_array(cumulative_discounts(k))
        lv = self.levels()
        end = F.least(F.col("level_start") + F.col("n_items") - 1, F.lit(k))
        contrib = (F.col("gain_sum") / F.col("n_items")) * (
            F.element_at(C, (end + 1).cast("int")) - F.element_at(C, F.col("level_start").cast("int"))
        )
        dcg = lv.groupBy("userid").agg(F.sum(contrib).alias("dcg"))
        D = _lit_array(discounts(k))
        ideal = top_k_by(self.known, k, [F.col("rating").desc(), F.col("itemid")])
        idcg = ideal.groupBy("userid").agg(F.sum(F.col("rating") * F.element_at(D, F.col("rank").cast("int"))).alias("idcg"))
        out = dcg.join(idcg, "userid", "left")
        return out.select(
            "userid",
            "dcg",
            F.coalesce(F.col("idcg"), F.lit(0.0)).alias("idcg"),
            F.coalesce(F.try_divide(F.col("dcg"), F.col("idcg")), F.lit(0.0)).alias("ndcg"),
        )

    def hits(self) -> DataFrame:
        """Per user ``(userid, n_relevant, ranks)``: how many relevant items, and the ranks of those
        among the predicted ones. One join of two frames of k rows a user, one aggregate."""
        rel = topk_relevant(self.known, self.k).select("userid", "itemid", F.lit(True).alias("_rel"))
        both = self.top_items().select("userid", "itemid", "rank").join(rel, ["userid", "itemid"], "full")
        found = F.when(F.col("_rel") & F.col("rank").isNotNull(), F.col("rank"))
        return both.groupBy("userid").agg(F.count("_rel").alias("n_relevant"), F.sort_array(F.collect_list(found)).alias("ranks"))

    def per_user(self) -> DataFrame:
        """Per user ``(userid, n_relevant, n_hits, ap, recall)``."""
        gains = F.transform("ranks", lambda r, j: (j + 1) / r)  # precision at each hit
        total = F.aggregate(gains, F.lit(0.0), lambda a, x: a + x)
        n = F.size("ranks").cast("bigint")
        return self.hits().select(
            "userid",
            "n_relevant",
            n.alias("n_hits"),
            F.coalesce(F.try_divide(total, n), F.lit(0.0)).alias("ap"),
            F.try_divide(n, F.col("n_relevant")).alias("recall"),
        )

    def average_precision(self) -> DataFrame:
        """Per user ``(userid, n_hits, ap)``."""
        return self.per_user().select("userid", "n_hits", "ap")

    def recall(self) -> DataFrame:
        """Per user ``(userid, n_relevant, n_hits, recall)``."""
        return self.per_user().select("userid", "n_relevant", "n_hits", "recall")

    def summary(self) -> DataFrame:
        """Macro means over candidate users."""
        per_user = self.ndcg().select("userid", "ndcg").join(self.per_user().select("userid", "ap", "recall"), "userid", "full")
        return per_user.agg(
            F.lit(self.k).alias("k"),
            F.count(F.lit(1)).alias("n_users"),
            F.avg(F.coalesce("ndcg", F.lit(0.0))).alias("ndcg_at_k"),
            F.avg(F.coalesce("ap", F.lit(0.0))).alias("map_at_k"),
            F.avg(F.coalesce("recall", F.lit(0.0))).alias("mar_at_k"),
        )
