"""The corpus pipeline on whole small tables, stage by stage, and the queries' SQL."""

import os
import sys

import pytest
from conftest import SF_SMALL

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


def test_stages(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(4).cache()
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in c.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL).cache()
        assert out.columns == docs.columns, name
        left = [r.doc_id for r in out.select("doc_id").collect()]
        assert len(left) == len(set(left)) and set(left) <= ids
        assert name != "line_dedup" or set(left) == ids  # every document stays
        ids, docs = set(left), out
    pieces = c.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert {r.doc_id for r in pieces} == ids
    good = {r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1").collect()}
    assert good & ids


@pytest.mark.parametrize("name", ["op3_adaptive_quality", "op5_temporal_url_lists", "op7_line_dedup", "op8_ngram_jaccard", "op9_benchmark_decontamination", "op10_chat_prefix_target", "op11_merkle_manifest"])
def test_query_matches_sql(spark, name):
    import duckdb
    from compare import compare

    from ranklift.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    s, d = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert s == d
