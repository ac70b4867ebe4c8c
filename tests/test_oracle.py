"""Every registered query against its SQL, and at least some rows elsewhere."""

import pytest

from almanack.registry import ORACLES, QUERIES
from tests.compare import compare, duck

# periods of the smallest tables have no outlier
MAY_BE_EMPTY = {"pca_outliers"}


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, folder, con, name):
    assert compare(QUERIES[name](spark, folder), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_returns_rows(spark, folder, name):
    rows = QUERIES[name](spark, folder).toArrow().num_rows
    assert rows > 0 or name in MAY_BE_EMPTY


def test_driver_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["series", "date", "value"]
