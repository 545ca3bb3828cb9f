"""Plan shape of every registered query: no cartesian products or nested
loop joins (no cross joins anywhere), and scans read only needed columns."""

import pytest

import __spark_entry__ as entry
from conftest import SF001

# Queries whose result is assembled on the driver from bounded aggregates.
LOCAL_RESULTS = {"eval_auc", "pref_regression", "pref_regression_by_segment", "pref_regression_rank"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - LOCAL_RESULTS))
def test_no_cross_join(spark, name):
    plan = _plan(entry.queries()[name](spark, SF001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_lineitem_scan_is_pruned(spark):
    plan = _plan(entry.queries()["pref_shares"](spark, SF001))
    scans = [line for line in plan.splitlines() if "lineitem" in line and "FileScan" in line]
    assert scans and all("l_quantity" not in s and "l_comment" not in s for s in scans)


def test_shares_read_every_transaction(spark):
    plan = _plan(entry.queries()["pref_shares"](spark, SF001))
    orders = [line for line in plan.splitlines() if "orders" in line and "FileScan" in line]
    assert orders and not any("Than" in s and "o_orderdate" in s for s in orders)
