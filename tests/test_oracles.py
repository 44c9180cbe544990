"""Every registered query against its check SQL on the same tables."""

import os

import pytest
from compare import database, difference

import __spark_entry__ as entry

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

# Queries without a row in the smallest tables.
EMPTY_HERE = {"exists_semi", "worklist_stock"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_query_has_check_sql():
    own = {name for name, fn in QUERIES.items() if not getattr(fn, "text_operator", False)}
    assert own <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    found = difference(QUERIES[name](spark, FOLDER), con, ORACLES[name])
    assert found == "" or (found == "no rows" and name in EMPTY_HERE)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
