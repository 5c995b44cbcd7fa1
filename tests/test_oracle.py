"""Every registered query against its SQL on DuckDB."""

import pytest

from checks.compare import differences
from checks.oracle import oracle_sql
from checks.registry import queries

SMALL = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_equal(spark, name):
    found, rows, _ = differences(spark, SMALL, queries()[name], oracle_sql()[name])
    assert not found, found
    assert rows > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
