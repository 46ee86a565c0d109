"""What the grids shuffle: rows are dealt once, by keys that later joins, sums and windows share."""

import re

import pytest

from spotgrid import catalog
from spotgrid.operators import editable, grids
from spotgrid.sources.tables import BoundTables

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog.queries()


def lines(frame):
    return frame._jdf.queryExecution().executedPlan().toString().splitlines()


def exchanges(frame):
    return [line for line in lines(frame) if "Exchange hashpartitioning" in line]


def below(plan, i):
    """The lines of the subtree whose top is line ``i``."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    rest = plan[i + 1:]
    return rest[:next((k for k, line in enumerate(rest) if depth(line) <= depth(plan[i])), len(rest))]


def test_popup_cells_are_not_shuffled(spark):
    assert not [line for line in exchanges(QUERIES["project_popup_grid"](spark, SF_DIR)) if "broadcast_date" in line]


@pytest.mark.parametrize(("name", "keys"), [("daily_projects", r"map_plan_id"), ("weekly_projects", r"map_plan_id#\d+L, project_id#\d+L, \d+\)")])
def test_report_rows_are_not_shuffled_for_their_label(spark, name, keys):
    found = exchanges(QUERIES[name](spark, SF_DIR))
    assert found and not [line for line in found if re.search(rf"hashpartitioning\({keys}", line)]


def test_spots_meet_the_goals_once_per_key(spark):
    """Spots don't shuffle by goal to look up what all spots of a key share."""
    spots = spark.createDataFrame([(1, 2, 3, 4, 10), (1, 2, 3, 4, 20), (1, 2, 3, None, 30), (1, 5, 3, 6, 40)], "plan_id long, project_id long, media_outlet_id int, campaign_goal_id long, units int")
    versions = spark.createDataFrame([(1, 3, 7)], "plan_id long, media_outlet_id int, plan_version_id long")
    goals = spark.createDataFrame([(4, 3, "a"), (4, 3, "b"), (6, 9, "c")], "campaign_goal_id long, media_outlet_id int, audience string")
    projects = spark.createDataFrame([(1, 7, 2, "x"), (1, 8, 2, "y"), (1, 7, 5, "z")], "plan_id long, plan_version_id long, project_id long, name string")
    rows = grids.of_goals(spots, versions, ["plan_id", "media_outlet_id"], goals, projects)
    assert sorted((r.project_id, r.campaign_goal_id, r.audience, r.name) for r in rows.collect()) == [(2, 4, "a", "x"), (2, 4, "b", "x")]


def test_packed_weeks_come_after_the_label(spark):
    plan = lines(QUERIES["quarterly_projects_grp"](spark, SF_DIR))
    windows = [i for i, line in enumerate(plan) if " Window " in line and "max(" in line]
    assert windows and not [line for i in windows for line in below(plan, i) if "map_from_entries" in line]


@pytest.mark.parametrize("name", ["plan_grid_for_edit", "plan_grid_for_edit_default_demo"])
def test_editable_cells_are_dealt_by_their_row(spark, name):
    assert not [line for line in exchanges(QUERIES[name](spark, SF_DIR)) if "units" in line]


@pytest.mark.parametrize("grid", [editable.episodes_saved, editable.episodes_optimised, grids.quarterly_episodes])
def test_episode_grids_sum_no_launch_spots(spark, grid):
    t = BoundTables(spark, SF_DIR)
    t = t.replace(schedule=t.schedule.where("plan_id is not null"), schedule_episode=t.schedule_episode)
    summed = []
    derived = type(t).derived
    try:
        type(t).derived = lambda self, name, *rest: summed.append(name) or derived(self, name, *rest)
        grid(t)
    finally:
        type(t).derived = derived
    assert "schedule_episode_days" in summed and "schedule_days" not in summed
