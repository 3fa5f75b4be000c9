"""Plan shape checks: no cartesian products, no single-partition windows,
partial aggregation before shuffles on the hot aggregations."""

import pytest

import __spark_entry__ as ent

SF = "/root/testdata/sf0.001"
CHECKED = ["latest_row_per_key", "membership_fold", "group_lookup", "rule_outcome", "snapshot_merge",
           "user_refs", "resolve_cascade", "pseudonym_html", "keyword_freq", "sample_positions"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECKED)
def test_no_cartesian(spark, name):
    plan = _plan(ent.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_latest_uses_partial_aggregation(spark):
    plan = _plan(ent.queries()["latest_row_per_key"](spark, SF))
    assert "Window" not in plan
    assert plan.count("Aggregate") >= 2  # partial + final around the exchange
