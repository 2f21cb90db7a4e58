"""Every registered query against its SQL."""

import __spark_entry__ as contract
import pytest
from oracle import difference

from tidegauge.plans.registry import QUERIES


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_agrees_with_sql(spark, sf, db, name):
    df = contract.queries()[name](spark, sf)
    assert difference(df, db, contract.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
