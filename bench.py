"""Bench: headline queries on $BENCH_SF_DIR, local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion through the ``noop`` sink (full execution, no
collect); one warm-up pass, then the median of ``$BENCH_REPS`` timed runs from an
empty cache, fixture sources included. ``operator_sec`` is one more run with the fixture
sources cached beforehand, so that the operators' own cost shows. ``control_sec`` is a
fixed computation that no code here changes, timed before and after: runs on other machines or
under other load compare by it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.chdir(ROOT)

HEADLINE = [
    "affinity_matrix",
    "topk_relevant",
    "score_candidates",
    "rank_metrics",
    "replay_improvement",
    "rerank_dot",
    "als_factors",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")

    from ranklift.plans.registry import QUERIES
    from ranklift.session import local_session

    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
    spark = local_session(cores=cpus, shuffle_partitions=parts, app="ranklift-bench")
    input_rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("lineitem", "orders", "part", "customer", "embeddings")}
    from ranklift.sources import fixtures

    def control() -> float:
        t0 = time.perf_counter()
        spark.range(0, 40_000_000, 1, int(cpus)).selectExpr("sum(hash(id, id * 31) & 1023)").collect()
        return time.perf_counter() - t0

    def cache_inputs() -> None:
        for source in (fixtures.cart_events, fixtures.search_results, fixtures.user_factors, fixtures.item_factors):
            source(spark, sf_dir).persist().count()

    control()
    controls = [control()]
    times: dict[str, float] = {}
    own: dict[str, float] = {}
    for name in names:
        fn = QUERIES[name]

        def once() -> float:
            spark.catalog.clearCache()  # no cached intermediate survives from a previous run
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        once()  # warm-up: JIT, file listing, Python workers
        times[name] = round(statistics.median(once() for _ in range(reps)), 3)
        spark.catalog.clearCache()
        cache_inputs()
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        own[name] = round(time.perf_counter() - t0, 3)
    controls.append(control())
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "total_headline_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "operator_sec": own,
                "control_sec": [round(c, 3) for c in controls],
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
                "shuffle_partitions": parts,
                "input_rows": input_rows,
                "spark": spark.version,
                "reps": reps,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
