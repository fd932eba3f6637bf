"""Every registered query against its SQL equivalent."""

from __future__ import annotations

import os

import pytest
from compare import differences, duck

from catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    with duck(SF_DIR) as opened:
        yield opened


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_sql(spark, connection, key):
    df = QUERIES[key](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert unwanted not in plan
    assert differences(df, connection, ORACLES[key]) == []
