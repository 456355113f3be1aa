"""Physical-plan guards for every registered query: no nested-loop or
cartesian join, no row-at-a-time or Arrow Python evaluation, and the
parquet scans read only the columns they need. Eager passes inside the queries
are inspected too."""

import re

import pytest

import __spark_entry__ as E

from conftest import SF01

BAD = re.compile(r"(BroadcastNestedLoopJoin|CartesianProduct|BatchEvalPython|ArrowEvalPython)")


@pytest.fixture
def passes(spark, monkeypatch):
    """Plans of the eager passes that a query runs while it is built: counts,
    collects and checkpoints."""
    kind, plans = type(spark.range(0)), []
    for name in ("collect", "count", "checkpoint", "isEmpty", "toArrow"):
        def watched(self, *a, _f=getattr(kind, name), **k):
            plans.append(self._jdf.queryExecution().executedPlan().toString())
            return _f(self, *a, **k)
        monkeypatch.setattr(kind, name, watched)
    return plans


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_plan_has_no_scale_hazard(spark, name, passes):
    df = E.queries()[name](spark, SF01)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for p in (plan, *passes):
        assert not BAD.findall(p), p


def test_scan_is_pruned_and_filtered(spark):
    from tablewright.operators.clean import above
    from tablewright.sources.files import load_table
    df = above(load_table(spark, SF01, "lineitem"), "l_quantity", 40).select("l_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,40" in plan
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_quantity:double>", plan)


def test_fact_table_is_never_the_broadcast_side(spark):
    """In the flagship plan the lineitem scan streams through the joins; no
    BroadcastExchange sits between it and its join."""
    df = E.queries()["state_stats_by_name"](spark, SF01)
    lines = df._jdf.queryExecution().executedPlan().treeString().split("\n")
    depth = [len(ln) - len(ln.lstrip(" :+-")) for ln in lines]
    scans = [i for i, ln in enumerate(lines) if "FileScan parquet" in ln and "lineitem" in ln]
    assert scans
    for i in scans:
        d = depth[i]
        for j in range(i - 1, -1, -1):           # walk up to the nearest join
            if depth[j] < d:
                if "Join" in lines[j]:
                    break
                assert "BroadcastExchange" not in lines[j], "\n".join(lines)
                d = depth[j]
