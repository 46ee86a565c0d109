"""The physical plans stay free of nested-loop joins, cross products and Python."""

import pytest

from spotgrid import catalog
from spotgrid.sources.tables import BoundTables

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog.queries()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_nested_loops_or_python(spark, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan


def test_filters_and_columns_reach_the_scan(spark):
    from spotgrid.operators.inventory import cumulative_delivery
    import datetime as dt

    plan = physical(cumulative_delivery(BoundTables(spark, SF_DIR), dt.date(1998, 6, 17)))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("l_extendedprice" not in line and "l_comment" not in line for line in scans)
    assert any("LessThanOrEqual(l_linenumber,4)" in line for line in scans)


def test_week_grid_unfolds_after_the_joins(spark):
    """The wide quarterly rows are not shuffled once per week: the week explode sits above every join."""
    plan = physical(QUERIES["quarterly_projects"](spark, SF_DIR)).splitlines()
    explode = next(i for i, line in enumerate(plan) if "Generate explode(weeks" in line)
    first_join = next(i for i, line in enumerate(plan) if "Join" in line)
    assert explode < first_join
