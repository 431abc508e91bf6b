"""Every query against its SQL, on the smallest data (set FOOTFALL_SF_DIR for more)."""

import os

import pytest

import __spark_entry__ as entry_point
import compare
from footfall import catalog, oracles

SF = os.environ.get("FOOTFALL_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.QUERIES, oracles.SQL
# Iterative training and files written and read back: no SQL says the same.
WITHOUT_SQL = {"feature_vector", "gbt_auc", "feature_importance", "importance_refit", "pattern_refit", "retention_scores"}


@pytest.fixture(scope="module")
def con():
    return compare.oracle(SF)


def test_every_query_has_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF), con, SQL[name]) == []


def test_entry(spark):
    table = entry_point.entry(spark)
    assert table.count() == 15
    assert len(table.columns) == 205 + 2
