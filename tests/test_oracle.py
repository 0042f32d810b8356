"""Every registered query against its DuckDB oracle on the smallest driver scale."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from matchlake import catalog
from oracle_compare import duck, same

ORACLE = catalog.ORACLE
NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    ok, why = same(df, con, ORACLE[name])
    assert ok, f"{name}: {why}"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["match_api_id", "home_team_goal", "away_team_goal", "season",
                          "result", "name"]
    assert df.count() > 0
