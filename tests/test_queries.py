"""Every registered query: equal to its SQL, or non-empty where it has none."""

import pytest
from compare import connect, differences
from conftest import SF_DIR

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    if name in oracle_sql():
        assert differences(df, oracle_sql()[name], duck) == []
    else:
        assert df.count() > 0
