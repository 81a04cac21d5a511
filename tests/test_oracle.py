"""Every registered query against its DuckDB oracle at sf0.01 (what the driver checks)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF01
from tools.oracle_check import compare, duck
from warband.registry import oracle_queries, spark_queries

ORACLE = oracle_queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle_or_is_listed():
    assert set(spark_queries()) - set(ORACLE) == {"unknown_clusters_default"}
    assert set(spark_queries()) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    r = compare(E.queries()[key](spark, SF01), con, ORACLE[key])
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_9g"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["civilization", "civilization_category", "map_type", "strategy", "match_id",
                          "player_id", "elo", "activity", "action_rank", "win"]
