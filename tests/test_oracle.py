"""All registered queries of the trip models against their DuckDB oracle SQL on the smallest tables."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
import oracle_compare as OC
from tripflow.plans import checks, oracle, queries


@pytest.fixture(scope="module")
def con():
    return OC.duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(queries.registry()))
def test_query_matches_oracle(spark, con, name):
    r = OC.compare(spark, SF_SMALL, name, con)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["match"], r


def test_total_check_is_the_same_on_both_sides():
    assert tuple(checks.TOTAL_COMPONENTS) == oracle.TOTAL_COMPONENTS
    assert f"{checks.TOTAL_TOLERANCE:.2f}" == oracle.TOTAL_TOLERANCE == "5.00"
