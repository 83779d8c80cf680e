import os

import pytest

import oracle
from registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_oracle(spark, con, name):
    assert oracle.compare(spark, con, QUERIES[name], SF_DIR) is None


def test_every_query_has_an_oracle():
    assert [n for n, q in QUERIES.items() if not q.oracle] == []


def test_entry(spark):
    """The text operators add queries, of which some have no SQL."""
    import __spark_entry__ as e
    assert QUERIES.keys() <= e.oracle_sql().keys() <= e.queries().keys()
    assert e.entry(spark).count() > 0
