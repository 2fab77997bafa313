"""M9: the whole run, cart events and search results in, named DataFrames out.

    matrices -> search -> train best -> rank metrics -> replay -> store

Every step writes its rows below the checkpoint folder and the next ones read them from there, so
that Spark can drop a step's shuffle files and cached blocks when it ends: the disk holds the
largest step's, not the sum of all. The statistics by query stay lazy.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RunConfig, Window
from ..operators import affinity, cleaning, rank_metrics, replay, sampling
from ..operators.factors import ALSParams, fit_als
from ..session import new_folder, release
from ..sources import sinks
from .search import ReplayScorer, search


def replay_prefix(cart_events: DataFrame, search_results: DataFrame, cfg: RunConfig, window: Window | None = None) -> DataFrame:
    """Model-independent part of the replay of ``window`` (default ``cfg.replay``): sample, top
    queries, session join."""
    window = window or cfg.replay
    adds = cleaning.clean_cart_adds(cart_events, window)
    imp = cleaning.clean_impressions(search_results, window)
    sampled = sampling.sample_per_query(adds, cfg.sample_size, cfg.sample_seed)
    top = sampling.top_queries(sampled, cfg.top_n_queries)
    return replay.session_join(imp, sampling.adds_of_top_queries(sampled, top))


def run_pipeline(
    cart_events: DataFrame,
    search_results: DataFrame,
    cfg: RunConfig | None = None,
    output_path: str | None = None,
    run_date: str | None = None,
    params: ALSParams | None = None,
) -> dict[str, DataFrame]:
    """All frames of a run, in tables below the checkpoint folder. ``params``: train with these and
    leave the search out (then there is no trial log)."""
    cfg = cfg or RunConfig()
    spark = cart_events.sparkSession
    folder = new_folder(spark, "run")

    def kept(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        schema = df.schema
        del df
        release(spark)
        return spark.read.schema(schema).parquet(f"{folder}/{name}")

    train = kept("train_matrix", affinity.affinity_matrix(cart_events, cfg.train))
    test = kept("test_matrix", affinity.affinity_matrix(cart_events, cfg.test))
    merged = kept("merged", replay_prefix(cart_events, search_results, cfg))
    trials, best = None, params
    if best is None:
        tuned_on = kept("tuned_on", replay_prefix(cart_events, search_results, cfg, cfg.validation)) if cfg.validation else merged
        trials, best = search(train, ReplayScorer(tuned_on, cfg.metric, cfg.cold_start), cfg.search)
        release(spark)
    fitted = fit_als(train, best)  # M8: one refit on the full training matrix
    users, items = (kept(name, df) for name, df in zip(("user_factors", "item_factors"), fitted))
    del fitted
    release(spark)

    scored = rank_metrics.Scored(rank_metrics.known_pairs(test, users, items), users, items, cfg.k, cfg.metric)
    ranked = kept("rank_metrics", scored.summary())
    scored.unpersist()
    del scored
    release(spark)
    pred = replay.predict_pairs(merged, users, items, cfg.metric, cfg.cold_start, best.rank)
    shift = kept("shift", replay.position_shift(merged, replay.slot_assignment(pred, cfg.metric, sizes_from=merged)))
    del pred
    out = {
        "train_matrix": train,
        "train_stats": kept("train_stats", affinity.matrix_stats(train, cfg.train)),
        "test_matrix": test,
        "test_stats": kept("test_stats", affinity.matrix_stats(test, cfg.test)),
        "known_report": kept("known_report", rank_metrics.known_pairs_report(test, users, items)),
        "user_factors": users,
        "item_factors": items,
        "rank_metrics": ranked,
        "improvement": kept("improvement", replay.improvement_overall(shift)),
        "improvement_by_query": replay.improvement_by_query(shift),
    }
    if trials is not None:
        out["trials"] = trials
    if output_path:
        day = run_date or date.today().strftime("%Y-%m-%d")
        sinks.write_factors(users, items, best.rank, f"{output_path}/latent_vectors", day)
        if trials is not None:
            sinks.write_trials(trials, f"{output_path}/trials/run_date={day}")
    return out


def report(out: dict[str, DataFrame]) -> DataFrame:
    """One row per figure of a run: ``(section, name, value)``; null figures stay."""
    parts = []
    for section in ("train_stats", "test_stats", "known_report", "rank_metrics", "improvement"):
        df = out[section]  # one row
        pairs = F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in df.columns))
        parts.append(df.select(F.lit(section).alias("section"), F.inline(pairs)))
    return reduce(DataFrame.unionByName, parts)
