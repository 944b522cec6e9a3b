"""Every registered query against DuckDB on the given tables, values included."""

import os

import pytest

from compare import connect, difference

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

if not os.path.isdir(SF_DIR):
    pytest.skip("no test data", allow_module_level=True)

import __spark_entry__ as entry  # noqa: E402

from workload.checks import check_queries  # noqa: E402
from workload.queries import registered  # noqa: E402

QUERIES, CHECKS = registered(), check_queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry.queries())
    assert set(CHECKS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_check(spark, con, name):
    found = QUERIES[name](spark, SF_DIR)
    assert difference(found, con, CHECKS[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns[-1] == "eom_rate_usd"
