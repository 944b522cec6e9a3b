"""The way large tables go: no side is broadcast but those of a few rows by their nature."""

import os

import pytest

from compare import connect, difference

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

if not os.path.isdir(SF_DIR):
    pytest.skip("no test data", allow_module_level=True)

import __spark_entry__ as entry  # noqa: E402


@pytest.mark.parametrize(
    "name",
    [
        "expected_schedule_admin",
        "payment_statistics",
        "orphan_by_month",
        "paid_vs_expected_periods",
        "repayment_behaviour",
        "three_system_profile",
        "reconcile_at_month_end",
    ],
)
def test_same_rows_without_broadcast(spark, name):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = entry.queries()[name](spark, SF_DIR)
        assert difference(found, connect(SF_DIR), entry.oracle_sql()[name]) is None
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "_salt" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
