"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare, connection

SLOW = {"autofit_report", "autofit_regression", "leaderboard_classification", "leaderboard_regression"}


@pytest.fixture(scope="module")
def con(sf):
    return connection(sf)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SLOW])
def test_query(spark, sf, con, name):
    outcome, _ = compare(spark, con, sf, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert outcome.startswith(("ok", "rows")) and not outcome.endswith(" 0"), outcome


def test_registry(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 6
