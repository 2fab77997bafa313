"""Shared lazy inputs of the registered queries over one data directory."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import RunConfig
from ..operators import affinity, cleaning, replay, sampling
from ..session import ensure_checkpoint_dir, stored
from ..sources import fixtures, tables


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Presentation for engine-to-engine comparison: doubles rounded to ``digits``,
    integer columns widened to bigint."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(cols)


class Inputs:
    """Fixture sources and the shared intermediate DataFrames (all lazy)."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: RunConfig | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.cfg = cfg or RunConfig()

    # sources
    @cached_property
    def cart_events(self) -> DataFrame:
        return fixtures.cart_events(self.spark, self.sf_dir)

    @cached_property
    def search_results(self) -> DataFrame:
        return fixtures.search_results(self.spark, self.sf_dir)

    # the same without item names, which neither the matrices nor the replay read
    @cached_property
    def nameless_events(self) -> DataFrame:
        return fixtures.cart_events(self.spark, self.sf_dir, names=False)

    @cached_property
    def nameless_results(self) -> DataFrame:
        return fixtures.search_results(self.spark, self.sf_dir, names=False)

    def folder(self, name: str) -> str:
        """A new folder for a table, beside the checkpoints that all executors share."""
        ensure_checkpoint_dir(self.spark)
        return f"{self.spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"

    @cached_property
    def cart_table(self) -> str:
        """The cart events written as a table partitioned by month."""
        return tables.write_partitioned(self.cart_events, self.folder("cart_events"), "event_dt", "month")

    @cached_property
    def search_table(self) -> str:
        """The search results written as a table partitioned by month."""
        return tables.write_partitioned(self.search_results, self.folder("search_results"), "SCL_CREATED_DATE", "month")

    @cached_property
    def user_factors(self) -> DataFrame:
        return fixtures.user_factors(self.spark, self.sf_dir)

    @cached_property
    def item_factors(self) -> DataFrame:
        return fixtures.item_factors(self.spark, self.sf_dir)

    @cached_property
    def rerank_requests(self) -> DataFrame:
        # stored: the shuffles that build the requests are gone when their vectors move
        return stored(fixtures.rerank_requests(self.spark, self.sf_dir, self.user_factors, self.item_factors), "requests")

    @cached_property
    def whole_requests(self) -> DataFrame:
        return stored(fixtures.rerank_requests(self.spark, self.sf_dir), "whole_requests")

    @cached_property
    def rank(self) -> int:
        return replay.factor_rank(self.item_factors)

    # matrices
    @cached_property
    def train_matrix(self) -> DataFrame:
        return affinity.affinity_matrix(self.nameless_events, self.cfg.train)

    @cached_property
    def test_matrix(self) -> DataFrame:
        return affinity.affinity_matrix(self.nameless_events, self.cfg.test)

    # replay inputs
    @cached_property
    def cart_adds(self) -> DataFrame:
        return cleaning.clean_cart_adds(self.nameless_events, self.cfg.replay)

    @cached_property
    def impressions(self) -> DataFrame:
        return cleaning.clean_impressions(self.nameless_results, self.cfg.replay)

    @cached_property
    def sampled(self) -> DataFrame:
        # The sample reads the adds for its counts, numbers and draws, the replay the sample twice: unstored, the
        # driver plans the join of lines and orders a dozen times over.
        adds = stored(self.cart_adds, "adds")
        return stored(sampling.sample_per_query(adds, self.cfg.sample_size, self.cfg.sample_seed), "sampled")

    @cached_property
    def top(self) -> DataFrame:
        return sampling.top_queries(self.sampled, self.cfg.top_n_queries)

    @cached_property
    def merged(self) -> DataFrame:
        # Read by both sides of the position shift (current and predicted).
        adds = sampling.adds_of_top_queries(self.sampled, self.top)
        return replay.session_join(self.impressions, adds).persist()
