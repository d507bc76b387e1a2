"""Plan-shape checks: no Python evaluation nodes, no nested-loop joins in the
class-P patterns, and column pruning / filter pushdown into the scans."""

import pytest

from fanpulse.plans.registry import BUILDERS, _load_extensions
from fanpulse.sources.io import read_layout_table, write_with_layout

_load_extensions()


@pytest.mark.parametrize("name", sorted(BUILDERS))
def test_no_python_udf_or_cartesian(tables, name):
    df = BUILDERS[name](tables)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_projection_and_filter_reach_the_scan(spark, tables, tmp_path):
    names = ("dim_matches", "fact_match_events")
    write_with_layout({n: tables[n] for n in names}, str(tmp_path))
    df = BUILDERS["mart_football_team_match"]({n: read_layout_table(spark, str(tmp_path), n) for n in names})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(period), LessThanOrEqual(period,4)" in plan
    assert "ReadSchema: struct<" in plan and "x:double" not in plan   # unused columns pruned


@pytest.mark.parametrize("name", ["report_executive_daily", "mart_sports_engagement", "report_sports_engagement",
                                  "mart_sessions", "mart_product_daily"])
def test_no_expand_for_multiple_distinct_counts(tables, name):
    plan = BUILDERS[name](tables)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan, name
