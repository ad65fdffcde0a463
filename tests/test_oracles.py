"""Every registered query against its SQL oracle on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from headway.plans import queries as registered
from tests import oracle

SF = "/root/testdata/sf0.001"
OWN = registered.queries()
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in OWN}
ROWS_ONLY = {"approx_vehicles", "gbt_predictions", "gbt_scores"}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_an_oracle_or_cannot_have_one():
    assert set(OWN) - set(ORACLES) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, con, name):
    names, rows = oracle.from_spark(OWN[name](spark, SF))
    expected_names, expected = oracle.from_duckdb(con, ORACLES[name])
    assert names == expected_names
    assert rows == expected


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    assert OWN[name](spark, SF).count() > 0


def test_entry(spark):
    assert contract.entry(spark).columns == ["n", "mae_schedule", "mae_persistence"]
    assert contract.entry(spark).first()["n"] > 0
