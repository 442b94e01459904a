"""Every registered query equals its SQL oracle (DuckDB) on the small fixture."""

import pytest

import __spark_entry__ as E
from headway.plans.catalog import QUERIES
from headway.plans.oracle import ORACLE
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare

NAMES = sorted(QUERIES)         # the training-data queries have tests of their own


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res.startswith("OK") or res.startswith("rows-only"), res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["route_id", "day_of_week", "hour_of_day", "avg_delay", "max_delay",
                          "observations"]
