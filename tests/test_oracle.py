"""Every registered query against its DuckDB oracle on the full sf0.001 tables."""

import pytest
from compare import compare, duck
from conftest import SF_SMALL

from ranklift.plans.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s, d = compare(df, con, ORACLES[name])
    assert len(s) == len(d)
    assert s == d


def test_every_query_has_oracle_or_is_a_model_fit():
    assert set(QUERIES) - set(ORACLES) == {"hyper_search", "run_report"}


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["userid", "itemid", "rating"]
    assert df.count() > 0
    assert set(e.queries()) >= set(QUERIES)
