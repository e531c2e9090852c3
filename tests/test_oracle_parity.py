"""Every SQL-expressible key equals its DuckDB twin (rows, names, values)."""

import pytest

from tidecast.plans.registry import QUERIES, oracle
from tidecast.plans.verify import compare, duckdb_conn

ORACLE = oracle()
SQL_KEYS = [k for k in QUERIES if k in ORACLE]


@pytest.fixture(scope="module")
def con(sf_small):
    return duckdb_conn(sf_small)


@pytest.mark.parametrize("key", SQL_KEYS)
def test_query_matches_oracle(spark, sf_small, con, key):
    res = compare(QUERIES[key](spark, sf_small), ORACLE[key], con)
    assert res["match"], res


def test_every_key_has_oracle_or_is_model():
    model_keys = {"geo_clusters", "crossfit_gbt", "bagged_fit", "ens_stack", "score_stack", "feature_importance",
                  "target_encode_cluster", "backtest_gbt", "first_stage"}
    assert set(QUERIES) - set(ORACLE) == model_keys
