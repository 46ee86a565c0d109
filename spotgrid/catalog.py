"""Every operator as a named query over all plans, for checks and benchmarks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotgrid.operators import (
    choices,
    daily,
    details,
    distribute,
    editable,
    grids,
    ingest,
    inventory,
    popup,
    prepare,
    reach,
    save,
    validate,
)
from spotgrid.plans import calendar, context
from spotgrid.sources.shared import new_table_path
from spotgrid.sources.tables import BoundTables

AS_OF = dt.date(1998, 6, 17)
NOON = dt.datetime(1998, 6, 17, 12)
LAST_MEASURED = dt.date(1998, 5, 13)
UNITS, GRP = 1, 2

CALENDAR = {
    "periods": lambda t: calendar.periods(t.cal_period, "Q"),
    "quarter_weeks": lambda t: calendar.quarter_weeks(t.cal_period),
    "week_number": lambda t: calendar.week_number(calendar.quarter_weeks(t.cal_period)),
    "adjacent_quarter": lambda t: calendar.adjacent_quarter(t.cal_period, 1),
    "next_quarter_by_date": lambda t: calendar.next_quarter_by_date(t.cal_period),
    "quarter_window": lambda t: calendar.quarter_window(t.cal_period, AS_OF),
}

CONTEXT = {
    "plan_context": lambda t: context.plan_context(t.plan, t.cal_period),
    "latest_completed_version": lambda t: context.latest_completed_version(
        t.model_exec, ("plan_id", "media_outlet_id", "model_type_id")),
    "latest_version": lambda t: context.latest_version(t.plan_version),
    "past_plan": lambda t: context.past_plan(t.plan, t.cal_period),
    "future_plan": lambda t: context.future_plan(t.plan, t.cal_period),
    "default_demo": lambda t: context.default_demo(t.outlet_demo),
    "last_opt_label": lambda t: context.last_opt_label(
        t.plan_project.select(F.col("plan_id").alias("map_plan_id"), "plan_id", "project_id"),
        t.plan_project, t.plan_project_episode, t.model_exec),
    "carry_over_projects": lambda t: context.carry_over_projects(t.schedule, t.schedule_episode, t.plan, t.cal_period),
    "current_projects": lambda t: context.current_projects(
        t.plan_project, t.plan_project_episode, context.latest_completed_version(t.model_exec)),
}

INVENTORY = {
    "quarterly_capacity": lambda t: inventory.quarterly_capacity(t, UNITS),
    "quarterly_capacity_grp": lambda t: inventory.quarterly_capacity(t, GRP),
    "quarterly_future_units": lambda t: inventory.quarterly_future_units(t, UNITS),
    "weekly_day_capacity": lambda t: inventory.weekly_day_capacity(t, UNITS),
    "weekly_day_capacity_grp": lambda t: inventory.weekly_day_capacity(t, GRP),
    "weekly_future_units": lambda t: inventory.weekly_future_units(t, UNITS),
    "weekly_episode_future_units": lambda t: inventory.weekly_episode_future_units(t, GRP),
    "daily_daypart_capacity": lambda t: inventory.daily_daypart_capacity(t, UNITS),
    "daily_future_by_daypart": lambda t: inventory.daily_future_by_daypart(t, GRP),
    "daily_episode_future": lambda t: inventory.daily_episode_future(t, UNITS),
    "cumulative_delivery": lambda t: inventory.cumulative_delivery(t, AS_OF, UNITS),
    "inventory_capacity": lambda t: inventory.inventory_capacity(t, UNITS),
    "utilized_inventory": lambda t: inventory.utilized_inventory(t, GRP),
    "future_quarter_spots": lambda t: inventory.future_quarter_spots(t, UNITS),
}

GRIDS = {
    "quarterly_projects": lambda t: grids.quarterly_projects(t, UNITS),
    "quarterly_projects_grp": lambda t: grids.quarterly_projects(t, GRP),
    "quarterly_episodes": lambda t: grids.quarterly_episodes(t, UNITS),
    "weekly_projects": lambda t: grids.weekly_projects(t, UNITS),
    "weekly_episode_units": lambda t: grids.weekly_episode_units(t, GRP),
}

DAILY = {
    "daily_primary": lambda t: daily.daily_primary(t, UNITS),
    "daily_projects": lambda t: daily.daily_projects(t, UNITS),
    "daily_episodes": lambda t: daily.daily_episodes(t, GRP),
    "project_popup_grid": popup.project_popup_grid,
    "daypart_order": popup.daypart_order,
}

COUNTED = ("plan", "campaign_goal", "campaign_goal_episode", "schedule", "schedule_episode", "plan_project", "plan_project_episode",
           "plan_project_spots", "plan_project_spots_episode", "plan_project_spots_episode_map", "plan_version", "model_exec")

DETAILS = {
    "plan_header": details.plan_header,
    "episode_rules_json": details.episode_rules_json,
    "saved_episode_rules_json": details.saved_episode_rules_json,
    "multi_net_flag": details.multi_net_flag,
    "episode_details": details.episode_details,
    "episode_timebands": details.episode_timebands,
    "episode_timeband_days": details.episode_timeband_days,
    "episode_header": details.episode_header,
    "blackouts": details.blackouts,
    "recurring_exclusions": details.recurring_exclusions,
    "clock_offsets": details.clock_offsets,
    "exec_report": details.exec_report,
    "table_row_counts": lambda t: details.table_row_counts({name: getattr(t, name) for name in COUNTED}),
}

EDITABLE = {
    "plan_grid_for_edit": lambda t: editable.plan_grid_for_edit(t, NOON, UNITS),
    "plan_grid_for_edit_default_demo": lambda t: editable.plan_grid_for_edit(t, NOON, GRP, network_target="default"),
    "episodes_optimised": lambda t: editable.episodes_optimised(t, UNITS),
    "episodes_saved": lambda t: editable.episodes_saved(t, UNITS),
}

CHOICES = {
    "user_networks": choices.user_networks,
    "cluster_networks": lambda t: choices.cluster_networks(t, media_outlet_id=3),
    "frequencies": choices.frequencies,
    "demo_types": choices.demo_types,
    "episodic_phases": choices.episodic_phases,
    "segment_selection": choices.segment_selection,
    "network_config_errors": choices.network_config_errors,
    "project_eligibility": lambda t: choices.project_eligibility(t, project_type=1),
    "project_eligibility_events": lambda t: choices.project_eligibility(t, project_type=2),
    "project_eligibility_from_network": lambda t: choices.project_eligibility(t, project_type=1, views=t.network_view),
}


def _overlap(t):
    return distribute.week_overlap(reach.reach_estimates(t, AS_OF), t.cal_period)


REACH = {
    "flight_profile": lambda t: reach.flight_profile(t, AS_OF),
    "select_guide": lambda t: reach.select_guide(reach.flight_profile(t, AS_OF), t),
    "guide_limits": reach.guide_limits,
    "reach_guide": reach.build_reach_guide,
    "reach_brackets": lambda t: reach.reach_brackets(t, AS_OF),
    "reach_estimates": lambda t: reach.reach_estimates(t, AS_OF),
    "week_overlap": _overlap,
    "distribute_proportional": lambda t: distribute.week_labels(distribute.distribute_proportional(_overlap(t))),
    "distribute_carry": lambda t: distribute.week_labels(distribute.distribute_carry(_overlap(t))),
}

def _stored_sums(t, schedule):
    path = new_table_path(t.spark, "day_sums")
    t.day_sums(path)[schedule].write()
    return path


def _schedule_day_sums(t):
    return t.day_sums(_stored_sums(t, "schedule"))["schedule"].rows()


SAVE = {
    "schedule_day_sums": _schedule_day_sums,
    "episode_day_sums_after_save": lambda t: save.refresh_episode_sums(t, _stored_sums(t, "schedule_episode")),
    "resolve_plan": save.resolve_plan,
    "decide_version": save.decide_version,
    "saved_plans": lambda t: save.saved_plans(t, NOON),
    "saved_versions": lambda t: save.saved_versions(t, NOON),
    "carry_forward_results": lambda t: save.carry_forward_results(save.staged_projects(t, NOON), t),
    "freeze_optimize_flag": lambda t: save.freeze_optimize_flag(save.staged_projects(t, NOON), NOON),
    "upsert_plan_projects": lambda t: save.upsert_plan_projects(t, NOON),
    "upsert_spots": save.upsert_spots,
    "propagate_targets": save.propagate_targets,
    "removed_projects": save.removed_projects,
    "removed_episode_projects": save.removed_episode_projects,
    "cascade_schedule_episode": lambda t: save.cascade_remove(t)["schedule_episode"],
    "cascade_project_reach": lambda t: save.cascade_remove(t)["project_reach"],
    "cascade_project_reach_episode": lambda t: save.cascade_remove(t)["project_reach_episode"],
    "cascade_campaign_goal": lambda t: save.cascade_remove(t)["campaign_goal"],
    "cascade_campaign_goal_episode": lambda t: save.cascade_remove(t)["campaign_goal_episode"],
    "audit_events": lambda t: save.audit_events(t, NOON),
    "store_episode_json": save.store_episode_json,
    "flatten_episode_json": lambda t: save.flatten_episode_json(t.episode_json),
    "episode_json_rejects": lambda t: save.episode_json_rejects(t.episode_json),
    "insert_episodes": lambda t: save.insert_episodes(t, NOON),
    "episode_spots": save.episode_spots,
    "upsert_episode_map": save.upsert_episode_map,
}

PREPARE = {
    "new_exec_requests": lambda t: prepare.new_exec_requests(t, NOON),
    "linked_versions": lambda t: prepare.linked_versions(t, NOON),
    "submitted_plans": lambda t: prepare.submitted_plans(t, NOON),
    "measurement_window_projects": lambda t: prepare.measurement_window_projects(t, LAST_MEASURED),
    "measurement_window_episodes": lambda t: prepare.measurement_window_episodes(t, LAST_MEASURED),
    "backfill_projects": prepare.backfill_projects,
    "backfill_episodes": prepare.backfill_episodes,
    "mark_in_progress": prepare.mark_in_progress,
    "expand_model_params": lambda t: prepare.expand_model_params(t, NOON),
    "expand_model_params_forced": lambda t: prepare.expand_model_params(t, NOON, forced={27: 20}),
    "project_week_caps": validate.project_week_caps,
    "daily_cap_check": validate.daily_cap_check,
    "daily_cap_check_episode": validate.daily_cap_check_episode,
    "explode_capacity_json": lambda t: ingest.explode_capacity_json(t, AS_OF),
    "capacity_json_rejects": ingest.capacity_json_rejects,
}

GROUPS = [CALENDAR, CONTEXT, INVENTORY, GRIDS, DAILY, DETAILS, EDITABLE, CHOICES, REACH, SAVE, PREPARE]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, sf_dir: build(BoundTables(spark, sf_dir))

    return {name: bind(build) for group in GROUPS for name, build in group.items()}
