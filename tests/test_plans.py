"""Plan audit: no registered query plans a cross product."""

from ludora.plans.catalog import QUERIES

from .conftest import SF_SMALL


def test_no_cartesian_products(spark):
    bad = []
    for name, (fn, _) in QUERIES.items():
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        bad += [(name, p) for p in ("CartesianProduct", "BroadcastNestedLoopJoin") if p in plan]
    assert not bad


def test_filters_and_columns_reach_the_scan(spark):
    from ludora.plans import base
    plan = base.interactions(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(l_orderkey)" in plan        # pushed into the scan
    assert "l_quantity" not in plan and "l_extendedprice" not in plan          # pruned: not needed by the view
    assert "WindowGroupLimit" in plan             # dedup keeps one row per id before the shuffle
