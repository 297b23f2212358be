"""Every registered query against its SQL."""

import re

import compare
import pytest
from conftest import SF

from postroad.plans.catalog import QUERIES
from postroad.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    columns, rows = compare.found(QUERIES[name](spark, SF))
    expected_columns, expected_rows = compare.expected(con, ORACLES[name])
    assert columns == expected_columns
    assert sum(rows.values()) > 0
    assert rows == expected_rows


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    names = set(entry.queries())
    assert set(QUERIES) <= names
    # Whatever else is registered belongs to the optional subpackage.
    assert all(re.fullmatch(r"op\d+_\w+|pipeline", n) for n in names - set(QUERIES))
