"""Search-session replay.

Each sampled add is joined to the results shown in its search; the shown items
are re-ordered by the model; the j-th best predicted item takes the position of
the j-th shown slot. ``diff_pos = current_pos - predict_pos`` measures how far
the added item moved up.

A session group is numbered in one task up to ``HOT_ROWS`` rows and in ranges beyond. The
current x predicted self-join of the reference (m identical adds -> m^2 rows)
is computed on distinct positions with a pair weight instead of materialising
the m^2 rows; statistics use the weight (``percentile`` with a frequency).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import check_metric
from ..functions import constant_vector, score
from ..functions.vectors import rank_key
from .numbering import rank_by_range

SESSION = ["fecha", "userid", "correlation_id"]
GROUP = ["fecha", "userid", "correlation_id", "search_query", "a2c_itemid"]
QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)


def session_join(impressions: DataFrame, adds: DataFrame) -> DataFrame:
    """Shown results x sampled adds of the same search (many-to-many). Both sides are dealt by session: a stored
    sample looks small by its compressed files, but the driver is not to hold and broadcast its rows."""
    a = adds.select("fecha", "userid", "correlation_id", "search_query", "a2c_itemid", "a2c_position")
    return impressions.join(a.hint("merge"), SESSION, "inner")


def factor_rank(factors: DataFrame) -> int:
    row = factors.select(F.size("features").alias("n")).first()
    if row is None:
        raise ValueError("empty factor table")
    return int(row["n"])


def lookup_vectors(keys: DataFrame, key_col: str, factors: DataFrame, out_col: str, rank: int, cold_start: str = "minus_one", known_col: str | None = None) -> DataFrame:
    """Attach a factor vector; unknown ids get the cold-start vector.

    ``minus_one`` (reference): all -1.0; ``zero``: all 0.0; ``drop``: row removed.
    ``known_col`` names a column that says whether the id had a vector.
    """
    f = factors.select(F.col("id").alias(key_col), F.col("features").alias(out_col))
    if cold_start == "drop":
        found = keys.join(f, key_col, "inner")
        return found.withColumn(known_col, F.lit(True)) if known_col else found
    fill = -1.0 if cold_start == "minus_one" else 0.0
    joined = keys.join(f, key_col, "left")
    if known_col:
        joined = joined.withColumn(known_col, F.col(out_col).isNotNull())
    return joined.withColumn(out_col, F.coalesce(F.col(out_col), constant_vector(fill, rank)))


def _score_back(merged: DataFrame, scored: DataFrame, extra: list[str]) -> DataFrame:
    """Join per-pair scores back onto the merged rows (null-safe: a shown SKU may be NULL)."""
    s = scored.select(F.col("userid").alias("_su"), F.col("imp_itemid").alias("_si"), *extra)
    cond = merged["userid"].eqNullSafe(s["_su"]) & merged["imp_itemid"].eqNullSafe(s["_si"])
    return merged.join(s, cond, "inner").drop("_su", "_si")


BROADCAST_BYTES = 64 << 20


def _factors_fit_broadcast(user_factors: DataFrame, item_factors: DataFrame, rank: int, bound: int) -> bool:
    """Checked size of both factor tables (rows x rank x 8 bytes) against ``bound``."""
    return (user_factors.count() + item_factors.count()) * rank * 8 <= bound


def _attach_vectors(rows: DataFrame, users: DataFrame, items: DataFrame, rank: int, cold_start: str, small: bool) -> DataFrame:
    if small:
        users, items = F.broadcast(users), F.broadcast(items)
    with_u = lookup_vectors(rows, "userid", users, "_u", rank, cold_start)
    return lookup_vectors(with_u, "imp_itemid", items, "_i", rank, cold_start)


def predict_pairs(
    merged: DataFrame,
    user_factors: DataFrame,
    item_factors: DataFrame,
    metric: str,
    cold_start: str = "minus_one",
    rank: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Score every (user, shown item) row: dot product or euclidean distance.

    Factor tables under the checked ``broadcast_bytes`` are broadcast and the
    rows never move. Beyond it, each distinct (user, item) pair is scored once
    (a result list repeats once per add of its search) and only the scalar is
    joined back, so the vectors are shuffled with the pairs, not with every row.
    """
    check_metric(metric)
    rank = rank or factor_rank(item_factors)
    if _factors_fit_broadcast(user_factors, item_factors, rank, broadcast_bytes):
        rows = _attach_vectors(merged, user_factors, item_factors, rank, cold_start, True)
        return rows.withColumn("prediction", score(metric, "_u", "_i")).drop("_u", "_i")
    pairs = merged.select("userid", "imp_itemid").distinct()
    with_i = _attach_vectors(pairs, user_factors, item_factors, rank, cold_start, False)
    scored = with_i.select("userid", "imp_itemid", score(metric, "_u", "_i").alias("prediction"))
    return _score_back(merged, scored, ["prediction"])


def predict_pairs_all(
    merged: DataFrame,
    user_factors: DataFrame,
    item_factors: DataFrame,
    metrics=("dot_product", "euclidean_distance"),
    cold_start: str = "minus_one",
    rank: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Both scores from one vector lookup: one row per (merged row, metric)."""
    for m in metrics:
        check_metric(m)
    rank = rank or factor_rank(item_factors)
    scores = F.array(*[F.struct(F.lit(m).alias("metric"), score(m, "_u", "_i").alias("prediction")) for m in metrics])
    if _factors_fit_broadcast(user_factors, item_factors, rank, broadcast_bytes):
        rows = _attach_vectors(merged, user_factors, item_factors, rank, cold_start, True)
        back = rows.select(*merged.columns, scores.alias("_scores"))
    else:
        pairs = merged.select("userid", "imp_itemid").distinct()
        with_i = _attach_vectors(pairs, user_factors, item_factors, rank, cold_start, False)
        back = _score_back(merged, with_i.select("userid", "imp_itemid", scores.alias("_scores")), ["_scores"])
    return back.select(*merged.columns, F.explode("_scores").alias("_m")).select(
        *merged.columns, F.col("_m.metric").alias("metric"), F.col("_m.prediction").alias("prediction")
    )


def predict_models(
    merged: DataFrame, factors: DataFrame, ranks: dict[int, int], dictionary: DataFrame, metric: str, cold_start: str = "minus_one"
) -> DataFrame:
    """The scores of many models from one vector lookup: one row per (merged row, ``model``).

    ``factors``: ``(model, kind, idx, features)``, ids numbered by ``dictionary`` ``(kind, id,
    idx)``; ``ranks``: vector length of each model. Only the users and items of ``merged`` are
    looked up, each once, with its vectors of all models as one map (as many entries as models);
    each distinct (user, item) pair is scored once and the scores are joined back.
    """
    check_metric(metric)
    pairs = merged.select("userid", "imp_itemid").distinct()

    def vectors(kind: str, col: str, out: str) -> DataFrame:
        ids = dictionary.where(F.col("kind") == kind).select(F.col("id").alias(col), "idx").join(pairs.select(col).distinct(), col)
        own = factors.where(F.col("kind") == kind).select("model", "idx", F.col("features").alias("v")).join(ids, "idx")
        return own.groupBy(col).agg(F.map_from_entries(F.collect_list(F.struct("model", "v"))).alias(out))

    looked = pairs.join(vectors("u", "userid", "_u"), "userid", "left").join(vectors("i", "imp_itemid", "_i"), "imp_itemid", "left")
    fill = 0.0 if cold_start == "zero" else -1.0
    models = F.array(*(F.struct(F.lit(m).alias("model"), F.lit(r).alias("rank")) for m, r in sorted(ranks.items())))

    def one(m):
        # the vectors move as the fit gave them, floats, and are widened here
        u, i = (F.try_element_at(x, m["model"]).cast("array<double>") for x in ("_u", "_i"))
        if cold_start != "drop":
            cold = F.array_repeat(F.lit(fill), m["rank"])
            u, i = F.coalesce(u, cold), F.coalesce(i, cold)
        return F.struct(m["model"].alias("model"), score(metric, u, i).alias("prediction"))

    scored = looked.select("userid", "imp_itemid", F.transform(models, one).alias("_scores"))
    out = _score_back(merged, scored, ["_scores"]).select(*merged.columns, F.explode("_scores").alias("_m"))
    out = out.select(*merged.columns, F.col("_m.model").alias("model"), F.col("_m.prediction").alias("prediction"))
    return out.where("prediction is not null") if cold_start == "drop" else out


HOT_ROWS = 1_000_000


def large_groups(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The session groups with more than ``hot_rows`` rows (None: there are none). There are fewer
    than rows / ``hot_rows`` of them."""
    large = rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).drop("_n").persist()
    if large.head(1):
        return large
    large.unpersist()
    return None


def slot_assignment(
    predicted: DataFrame, metric: str | None, keys=(), sizes_from: DataFrame | None = None, hot_rows: int = HOT_ROWS, digits: int | None = 9
) -> DataFrame:
    """W4 + W5: predicted order of each group mapped onto its shown slots.

    Output ``(GROUP..., slot, predict_itemid, prediction, imp_position)``: the
    item ranked ``slot`` by the model and the position of the ``slot``-th shown
    result. Scores that agree in ``digits`` decimals (``None``: equal ones) are ties, which go by shown
    position, then item id; a missing score comes last.
    ``metric=None`` reads the metric per row from a ``metric`` column (then pass
    ``keys=("metric",)``).

    The rows move once, by group: each gives a record for its place in the predicted and one in the shown
    order, both are numbered, and a record takes the position of the one beside it. Groups
    beyond ``hot_rows`` rows are numbered in ranges over many tasks instead and joined by
    (group, slot). ``sizes_from``: frame with the rows of the groups to count, once for
    all ``keys`` (default: ``predicted``).
    """
    group = [*GROUP, *keys]
    if metric is None:
        key = F.when(F.col("metric") == "dot_product", F.col("prediction")).otherwise(-F.col("prediction"))
        key = key if digits is None else F.round(key, digits)
    else:
        key = rank_key(metric, F.col("prediction"), digits)
    rows = predicted.select(*group, "imp_itemid", "imp_position", "prediction", (-key).alias("_key"))
    large = large_groups(predicted if sizes_from is None else sizes_from, hot_rows)
    if large is None:
        return _slots_in_task(rows, group)
    ordinary = _slots_in_task(rows.join(large, GROUP, "left_anti"), group)
    return ordinary.unionByName(_slots_in_ranges(rows.join(large, GROUP, "left_semi"), group))


def _slots_in_task(rows: DataFrame, group: list[str]) -> DataFrame:
    record = lambda kind, key: F.struct(F.lit(kind).alias("_kind"), key.alias("_by"))
    both = F.array(record(0, F.col("_key")), record(1, F.lit(None).cast("double")))
    records = rows.repartition(*[F.col(c) for c in group]).select("*", F.inline(both)).drop("_key")
    order = [F.col("_by").asc_nulls_last(), "imp_position", "imp_itemid"]
    placed = records.withColumn("slot", F.row_number().over(W.partitionBy(*group, "_kind").orderBy(*order)))
    beside = F.lead("imp_position").over(W.partitionBy(*group).orderBy("slot", "_kind"))
    return placed.withColumn("_beside", beside).where("_kind = 0").select(
        *group, "slot", F.col("imp_itemid").alias("predict_itemid"), "prediction", F.col("_beside").alias("imp_position")
    )


def _slots_in_ranges(rows: DataFrame, group: list[str]) -> DataFrame:
    shown = [F.col("imp_position").asc(), F.col("imp_itemid").asc()]
    items = rank_by_range(rows, group, [F.col("_key").asc_nulls_last(), *shown], "slot")
    slots = rank_by_range(rows.select(*group, "imp_position", "imp_itemid"), group, shown, "slot")
    items = items.select(*group, F.col("slot").cast("int").alias("slot"), F.col("imp_itemid").alias("predict_itemid"), "prediction")
    return items.join(slots.select(*group, F.col("slot").cast("int").alias("slot"), "imp_position"), [*group, "slot"])


def position_shift(merged: DataFrame, slots: DataFrame, keys=()) -> DataFrame:
    """J3 (weighted): ``(GROUP..., current_pos, predict_pos, diff_pos, n_pairs)``.

    ``n_pairs`` = number of rows the reference's many-to-many merge emits for
    this (current, predicted) position pair. ``keys`` are extra grouping
    columns of ``slots`` (e.g. ``metric``).
    """
    cur = (
        merged.where(F.col("imp_itemid") == F.col("a2c_itemid"))
        .groupBy(*GROUP, F.col("imp_position").alias("current_pos"))
        .agg(F.count(F.lit(1)).alias("_nc"))
    )
    pre = (
        slots.where(F.col("predict_itemid") == F.col("a2c_itemid"))
        .groupBy(*GROUP, *keys, F.col("imp_position").alias("predict_pos"))
        .agg(F.count(F.lit(1)).alias("_np"))
    )
    return cur.join(pre, GROUP).select(
        *GROUP,
        *keys,
        "current_pos",
        "predict_pos",
        (F.col("current_pos") - F.col("predict_pos")).alias("diff_pos"),
        (F.col("_nc") * F.col("_np")).alias("n_pairs"),
    )


def _stats(mai_digits: int):
    n = F.sum("n_pairs")
    mean_diff = F.sum(F.col("diff_pos") * F.col("n_pairs")) / n
    mean_cur = F.sum(F.col("current_pos") * F.col("n_pairs")) / n
    mean_pre = F.sum(F.col("predict_pos") * F.col("n_pairs")) / n
    qs = F.percentile(F.col("diff_pos"), list(QUANTILES), F.col("n_pairs"))
    return [
        n.cast("bigint").alias("n"),
        mean_diff.alias("mean_diff"),
        qs.alias("_q"),
        mean_cur.alias("mean_current"),
        mean_pre.alias("mean_predict"),
    ], mai_digits


def _finish(df: DataFrame, mai_digits: int, keys: list[str]) -> DataFrame:
    names = ["q10", "q25", "q50", "q75", "q90"]
    return df.select(
        *keys,
        "n",
        "mean_diff",
        *[F.col("_q")[i].alias(nm) for i, nm in enumerate(names)],
        "mean_current",
        "mean_predict",
        F.bround(F.try_divide(F.col("mean_diff"), F.col("mean_current")), mai_digits).alias("mai"),
        F.bround(F.col("mean_diff"), 2).alias("manip"),
    )


def improvement_overall(shift: DataFrame, keys=()) -> DataFrame:
    """One row of statistics (per ``keys``); ``mai`` 3 dp, ``manip`` 2 dp (half-even)."""
    aggs, digits = _stats(3)
    agg = shift.groupBy(*keys).agg(*aggs) if keys else shift.agg(*aggs)
    return _finish(agg, digits, list(keys))


def improvement_by_query(shift: DataFrame) -> DataFrame:
    """The same per search query (``mai`` 2 dp), best first."""
    aggs, digits = _stats(2)
    out = _finish(shift.groupBy("search_query").agg(*aggs), digits, ["search_query"])
    return out.orderBy(F.col("mai").desc_nulls_last(), F.col("search_query"))
