"""Every registered query against DuckDB on the same tables: names, types and values."""

import pytest

import __spark_entry__
import registered
from tests.oracle import connect, duck_rows, duck_types, spark_rows, spark_types

QUERIES = registered.QUERIES
ORACLES = registered.ORACLES


@pytest.fixture(scope="module")
def con(request):
    from tests.conftest import SF_DIR

    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["axis", "key", "n"]


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    assert spark_types(df) == duck_types(con, ORACLES[name])
    assert spark_rows(df) == duck_rows(con, ORACLES[name])
