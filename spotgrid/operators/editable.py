"""The editable map: plan rows with weekly spots from the schedule or from manual entries, and its episode grids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotgrid.functions.columns import UNITS, flight_weeks, measure, own_network_first
from spotgrid.functions.joins import match_left_null, match_right_null
from spotgrid.operators.grids import LONG_CLOCK, map_plans, run_versions
from spotgrid.operators.inventory import by_week
from spotgrid.plans.calendar import quarter_weeks, week_number
from spotgrid.plans.context import (
    LIVE_VERSION,
    default_demo,
    latest_version,
    on_map_periods,
    plan_context,
    with_last_opt_label,
)

# Status codes, and the time that stands for no colour change.
OPTIMISED_STATUS = (9, 10)
COMPLETE_PLAN, RUNNING_PLAN = 3, 2
NO_COLOUR_CHANGE = dt.datetime(1990, 1, 1)


def map_week_labels(t) -> DataFrame:
    """(map plan, week) with both labels, the quarter's end and whether the map is complete: a few dozen rows per plan, written once."""
    def build(t) -> DataFrame:
        weeks = week_number(quarter_weeks(t.cal_period)).drop("fiscal_qtr", "week_end", "week_no")
        ends = plan_context(t.plan, t.cal_period).select(F.col("plan_id").alias("map_plan_id"), "qtr_end")
        state = t.plan.select(F.col("plan_id").alias("map_plan_id"), (F.coalesce("plan_status_id", F.lit(0)) == COMPLETE_PLAN).alias("is_complete"))
        return map_plans(t).join(weeks, F.col("map_period_id") == F.col("period_id")).drop("period_id").join(
            state, "map_plan_id").join(ends, "map_plan_id", "left")

    return t.derived("map_weeks", ("plan", "cal_period"), build)


def newest_versions(t) -> DataFrame:
    return t.derived("newest_versions", ("plan_version",), lambda t: latest_version(t.plan_version))


def live(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("plan_version_id") == LIVE_VERSION)


def to_maps(rows: DataFrame, t) -> DataFrame:
    """Turn (plan_id, map_period_id) rows into rows of the map of that quarter, for the plan's outlet and type."""
    target = map_plans(t).select("map_plan_id", F.col("map_outlet_id").alias("media_outlet_id"),
                                 F.col("map_plan_type").alias("plan_type"), "map_period_id")
    owner = t.plan.select("plan_id", "media_outlet_id", "plan_type")
    return rows.join(owner, "plan_id").join(target, ["media_outlet_id", "plan_type", "map_period_id"]).drop(
        "media_outlet_id", "plan_type", "map_period_id")


def scheduled_goals(facts: DataFrame, goals: DataFrame, t, n_quarters: int, more: list[str]) -> DataFrame:
    """Goals of any plan version that have spots inside a map's window."""
    seen = on_map_periods(facts, t.cal_period, n_quarters, ["campaign_goal_id", *more])
    owners = goals.where(F.col("campaign_goal_id").isNotNull()).select("plan_id", "campaign_goal_id", *more).distinct()
    return to_maps(seen.join(owners, ["campaign_goal_id", *more]), t).select("map_plan_id", "campaign_goal_id").distinct()


#: What the rows and the weekly amounts of the editable grids are made of.
MEMBERS_OF = ("plan", "plan_version", "plan_project", "plan_project_episode", "model_exec", "schedule", "schedule_episode", "cal_period")
AMOUNTS_OF = (*MEMBERS_OF, "project", "plan_project_spots", "plan_project_spots_episode")


def weekly_live(t, schedule: str, output_type: int, keys: list[str]) -> DataFrame:
    """Live week sums, written once: the map's own plan and all other plans read them, in every report."""
    def build(t) -> DataFrame:
        facts = live(getattr(t.with_day_sums(schedules=[schedule]), schedule)).withColumn("units", measure(output_type))
        return by_week(facts, t.cal_period, ["units"], "plan_id", "media_outlet_id", *keys)

    return t.derived(f"{schedule}_live_weeks_{output_type}", (schedule, "cal_period"), build)


def other_plan_amounts(weekly: DataFrame, t, keys: list[str], label: str) -> DataFrame:
    """Weekly live spots of all other plans of the outlet, for projects of the map's type, with whether the project starts by the quarter's end."""
    typed = t.project.select("project_id", F.col("project_type").alias("plan_type"), F.col("start_date").alias("project_start"))
    maps = map_week_labels(t).select(
        "map_plan_id", F.col("map_outlet_id").alias("media_outlet_id"), F.col("map_plan_type").alias("plan_type"), "week_start", label, "is_complete", "qtr_end")
    rows = weekly.join(typed, "project_id").join(maps, ["media_outlet_id", "plan_type", "week_start"]).where(F.col("plan_id") != F.col("map_plan_id"))
    started = F.coalesce(F.col("project_start") <= F.col("qtr_end"), F.lit(False)).alias("started")
    return rows.groupBy("map_plan_id", "is_complete", started, *keys, "week_start", label).agg(F.sum("units").alias("units"))


def own_amounts(weekly: DataFrame, members: DataFrame, t, keys: list[str], label: str) -> DataFrame:
    """Weekly live spots of the map's own plan, for the given member rows."""
    weeks = map_week_labels(t).select(F.col("map_plan_id").alias("plan_id"), "week_start", label, "is_complete")
    return weekly.join(members, members.columns, "left_semi").join(weeks, ["plan_id", "week_start"]).groupBy(
        F.col("plan_id").alias("map_plan_id"), "is_complete", *keys, "week_start", label).agg(F.sum("units").alias("units"))


def manual_amounts(spots: DataFrame, t, keys: list[str], label: str, kind) -> DataFrame:
    """Weekly counts typed in for a plan version, as sums of type ``kind``; they carry no goal."""
    weeks = map_week_labels(t).select(F.col("map_plan_id").alias("plan_id"), F.col("week_start").alias("week_date"), label, "is_complete")
    return spots.join(weeks, ["plan_id", "week_date"]).select(
        F.col("plan_id").alias("map_plan_id"), "is_complete", *keys, F.lit(None).cast("bigint").alias("campaign_goal_id"),
        F.col("week_date").alias("week_start"), label, F.col("unit_count").cast(kind).alias("units"))


def status_checked(df: DataFrame, t) -> DataFrame:
    """Rows whose status is optimised; plans that were never checked pass whatever the status."""
    return df.join(t.plan.select("plan_id", "checked_yn"), "plan_id").where(
        F.col("status_cd").isin(*OPTIMISED_STATUS) | (F.col("checked_yn") == "N")).drop("checked_yn")


# --- episode grids -------------------------------------------------------------------

def episode_members(t) -> DataFrame:
    """Episodes on every map: the newest version's own, and other plans' episodes with spots in the map's two quarters."""
    cols = ["episode_id", "project_id", "campaign_goal_id", "plan_id", "episode_start_ts", "on_map_start", "on_map_end"]
    own = t.plan_project_episode.join(newest_versions(t), ["plan_id", "plan_version_id"], "left_semi").select(
        F.col("plan_id").alias("map_plan_id"), *cols)
    on_air = to_maps(on_map_periods(live(t.schedule_episode), t.cal_period, 2, ["plan_id", "project_id", "episode_id"]), t).where(
        F.col("plan_id") != F.col("map_plan_id"))
    goals = scheduled_goals(t.schedule_episode, t.plan_project_episode, t, 2, ["episode_id"])
    run = t.plan_project_episode.join(run_versions(t), ["plan_id", "plan_version_id"], "left_semi")
    other = (
        on_air.join(run.select(*cols), ["plan_id", "project_id", "episode_id"])
        .join(goals, ["map_plan_id", "campaign_goal_id"], "left_semi").select("map_plan_id", *cols).distinct()
    )
    return own.unionByName(other)


def episode_output(grid: DataFrame) -> DataFrame:
    return grid.select(
        "map_plan_id", "plan_id", "project_id", "episode_id", "campaign_goal_id",
        F.date_format("episode_start_ts", LONG_CLOCK).alias("episode_start_ts"),
        F.date_format("on_map_start", "MM/dd/yyyy").alias("start_ts_dis"), F.date_format("on_map_end", "MM/dd/yyyy").alias("end_ts_dis"),
        "week_start", F.col("episode_week_label").alias("week"), "units")


def episodes_optimised(t, output_type: int = UNITS) -> DataFrame:
    """Episode by week: optimised episodes from the schedule, the others from manual entries."""
    members = t.derived("episode_members", MEMBERS_OF, lambda t: episode_members(t.with_day_sums(schedules=["schedule_episode"])))
    amounts = t.derived(f"episode_amounts_{output_type}", AMOUNTS_OF, lambda t: episode_amounts(t, output_type))
    return episode_output(match_left_null(members, amounts, "campaign_goal_id", ["project_id", "episode_id"], ["map_plan_id"]))


def episode_amounts(t, output_type: int) -> DataFrame:
    """Weekly spots of every map's episodes: the own plan's optimised ones, other plans', and entries for those not optimised."""
    keys, label = ["project_id", "episode_id"], "episode_week_label"
    shown = ["map_plan_id", *keys, "campaign_goal_id", "week_start", label, "units"]
    newest = t.plan_project_episode.join(newest_versions(t), ["plan_id", "plan_version_id"], "left_semi")
    checked = status_checked(newest, t).select("plan_id", *keys).distinct()
    unchecked = newest.where(~F.col("status_cd").isin(*OPTIMISED_STATUS)).select("plan_id", "plan_version_id", *keys).distinct()
    weekly = weekly_live(t, "schedule_episode", output_type, [*keys, "campaign_goal_id"])
    own = own_amounts(weekly, checked, t, [*keys, "campaign_goal_id"], label)
    other = other_plan_amounts(weekly, t, [*keys, "campaign_goal_id"], label)
    # The versions are few and small, so entries of older ones go before the join by episode.
    typed_in = t.plan_project_spots_episode.join(newest_versions(t), ["plan_id", "plan_version_id"], "left_semi").join(
        unchecked, ["plan_id", "plan_version_id", *keys], "left_semi")
    manual = manual_amounts(typed_in, t, keys, label, own.schema["units"].dataType)
    return own.select(*shown).unionByName(other.select(*shown)).unionByName(manual.select(*shown)).distinct()


def episodes_saved(t, output_type: int = UNITS) -> DataFrame:
    """Episode by week from the saved entries of the newest version, and other plans' schedule."""
    keys, label = ["project_id", "episode_id"], "episode_week_label"
    shown = ["map_plan_id", *keys, F.col("campaign_goal_id").alias("amount_goal_id"), "week_start", label, "units"]
    saved = t.plan_project_spots_episode_map.join(newest_versions(t), ["plan_id", "plan_version_id"], "left_semi")
    other = other_plan_amounts(weekly_live(t, "schedule_episode", output_type, [*keys, "campaign_goal_id"]), t, [*keys, "campaign_goal_id"], label).where("started")
    manual = manual_amounts(saved, t, keys, label, other.schema["units"].dataType)
    amounts = other.select(*shown).unionByName(manual.select(*shown)).distinct()
    members = t.derived("episode_members", MEMBERS_OF, lambda t: episode_members(t.with_day_sums(schedules=["schedule_episode"])))
    return episode_output(members.join(amounts, ["map_plan_id", *keys], "left"))


# --- launch grid -----------------------------------------------------------------------

def edit_members(t) -> DataFrame:
    """(map plan, source plan, version, project) rows of the editable map."""
    keys = ["map_plan_id", "plan_id", "plan_version_id", "project_id"]
    current = t.plan_project.join(newest_versions(t), ["plan_id", "plan_version_id"], "left_semi").select(
        F.col("plan_id").alias("map_plan_id"), "plan_id", "plan_version_id", "project_id").withColumn("past_project", F.lit("N"))
    run = run_versions(t)
    run_projects = t.plan_project.join(run, ["plan_id", "plan_version_id"], "left_semi").select(
        "plan_id", "plan_version_id", "project_id", "campaign_goal_id")

    on_air = to_maps(on_map_periods(live(t.schedule), t.cal_period, 1, ["plan_id", "project_id"]), t).where(F.col("plan_id") != F.col("map_plan_id"))
    launch_goals = scheduled_goals(t.schedule, t.plan_project, t, 1, [])
    past_launch = on_air.join(run_projects, ["plan_id", "project_id"]).join(
        launch_goals, ["map_plan_id", "campaign_goal_id"], "left_semi").select(*keys)

    own_outlet = t.plan.select("plan_id", "media_outlet_id")
    scheduled = to_maps(
        on_map_periods(t.schedule, t.cal_period, 1, ["plan_id", "project_id", "media_outlet_id"])
        .join(own_outlet, ["plan_id", "media_outlet_id"], "left_semi").drop("media_outlet_id"), t).select("map_plan_id", "project_id").distinct()
    episode_goals = scheduled_goals(t.schedule_episode, t.plan_project_episode, t, 1, [])
    run_episodes = t.plan_project_episode.select("plan_id", "plan_version_id", "project_id", "campaign_goal_id").join(
        run_projects.drop("campaign_goal_id"), ["plan_id", "plan_version_id", "project_id"], "left_semi")
    past_episode = (
        episode_goals.join(run_episodes, "campaign_goal_id").where(F.col("plan_id") != F.col("map_plan_id"))
        .join(scheduled, ["map_plan_id", "project_id"], "left_anti").select(*keys).distinct()
    )
    return current.unionByName(past_launch.unionByName(past_episode).distinct().withColumn("past_project", F.lit("Y")))


def colour_flags(t, as_of: dt.datetime) -> DataFrame:
    """Whether a project's map colour changed after its plan rows were last updated; over episodes never show."""
    header = t.episode_header.where(F.col("active_yn") == "Y").select("project_id", "episode_end_date", "map_colour_updated_ts")
    newest = t.plan_project.join(newest_versions(t), ["plan_id", "plan_version_id"], "left_semi")
    changed = F.coalesce("map_colour_updated_ts", F.lit(NO_COLOUR_CHANGE)) > F.col("update_ts")
    over = F.coalesce(F.col("episode_end_date").cast("timestamp") < F.lit(as_of), F.lit(False))
    return newest.join(header, "project_id", "left").select(
        "plan_id", "project_id", "map_colour_updated_ts", F.when(over, "N").when(changed, "Y").otherwise("N").alias("flag"))


def weekly_amounts(t, output_type: int) -> DataFrame:
    """Weekly spots of every map. Those of complete plans carry their goal, those of other plans none, as these are matched by project alone."""
    keys, label = ["project_id"], "week_label"
    newest = t.plan_project.join(newest_versions(t), ["plan_id", "plan_version_id"], "left_semi")
    only_optimised = newest.where(F.col("status_cd").isin(*OPTIMISED_STATUS))
    # Rating points always come from optimised projects; spots of old quarters come from all of them.
    checked = status_checked(newest, t) if output_type == UNITS else only_optimised
    unchecked = newest.where(~F.col("status_cd").isin(*OPTIMISED_STATUS)).select(
        "plan_id", "plan_version_id", "project_id", F.lit(True).alias("is_unchecked")).distinct()

    weekly = weekly_live(t, "schedule", output_type, [*keys, "campaign_goal_id"])
    own = own_amounts(weekly, checked.select("plan_id", "project_id").distinct(), t, [*keys, "campaign_goal_id"], label).where("is_complete")
    other = other_plan_amounts(weekly, t, [*keys, "campaign_goal_id"], label).where("is_complete or started").drop("started")
    spots = t.plan_project_spots.join(newest_versions(t), ["plan_id", "plan_version_id"], "left_semi").join(
        unchecked, ["plan_id", "plan_version_id", "project_id"], "left")
    manual = manual_amounts(spots, t, [*keys, "is_unchecked"], label, own.schema["units"].dataType).where("not is_complete or is_unchecked").drop("is_unchecked")
    every = own.unionByName(other).unionByName(manual)
    return every.withColumn("campaign_goal_id", F.when(F.col("is_complete"), F.col("campaign_goal_id"))).drop("is_complete").distinct()


def plan_grid_for_edit(t, as_of: dt.datetime, output_type: int = UNITS, network_target: str = "project") -> DataFrame:
    """Editable map of every plan.

    ``network_target`` is the client variant: show the project's audience, or the outlet's ``default`` one.
    """
    goals = ["plan_id", "plan_version_id", "project_id"]
    slim = t.derived("edit_members", MEMBERS_OF, lambda t: edit_members(t.with_day_sums()).join(t.plan_project.select(*goals, "campaign_goal_id"), goals))
    members = with_last_opt_label(slim.drop("campaign_goal_id"), t.plan_project, t.plan_project_episode, t.model_exec)
    pp = t.plan_project.select(
        "plan_id", "plan_version_id", "project_id", "campaign_goal_id", "status_cd", "optimize_yn", "is_dirty", "display_seq", "priority",
        "episode_priority", "no_of_episode", "phase_type", "cluster_id", "segment_id", "demo_id", "frequency",
        F.col("target_reach_pct").alias("target_reach"), "target_grp", F.col("proj_reach_pct").alias("proj_reach_percent"), "proj_grp",
        "on_map_start", "on_map_end", "on_map_premiere", "on_map_start_ts", "on_map_end_ts", "guide_reach_pct", "guide_grp", "guide_spots",
        "segment_type_id", "segment_mask")
    maps = t.plan.select(
        F.col("plan_id").alias("map_plan_id"), F.col("media_outlet_id").alias("map_outlet_id"), F.col("name").alias("plan_name"),
        F.coalesce("plan_status_id", F.lit(0)).alias("plan_status_id"), F.col("comments").alias("status_comment"), F.col("update_ts").alias("plan_update_ts"))
    last_run = (
        t.model_exec.join(newest_versions(t), ["plan_id", "plan_version_id"], "left_semi")
        .groupBy(F.col("plan_id").alias("map_plan_id")).agg(F.max("exec_end_ts").alias("run_ts"))
    )
    demo = default_demo(t.outlet_demo.where(F.col("active_yn") == "Y")).join(t.demo, "demo_id").select(
        F.col("media_outlet_id").alias("map_outlet_id"), F.col("demo_id").alias("default_demo_id"), F.col("name").alias("default_demo_name"))
    parts = t.segment_component.groupBy(F.col("segment_id").alias("listed_segment_id")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("component_segment_id")), lambda c: c.cast("string")), ", ").alias("segment_selected"))
    goal_segment = t.campaign_goal.select("campaign_goal_id", F.col("segment_id").alias("goal_segment_id"))
    project = t.project.select(
        "project_id", F.col("name").alias("project_name"), "is_episodic", F.col("media_outlet_id").alias("project_outlet_id"),
        F.col("start_date").alias("project_start_date"), F.col("end_date").alias("project_end_date"), "premiere_date",
        F.col("target_frequency").alias("project_freq"), F.col("target_segment").alias("project_segment_id"),
        F.col("target_demo_id").alias("project_demo_id"), "campaign_type_id", "scatter_imps", "subevent_id", "user_comment")

    def named(table: DataFrame, key: str, new_key: str, name: str, new_name: str) -> DataFrame:
        return table.select(F.col(key).alias(new_key), F.col(name).alias(new_name))

    plan_status = F.col("plan_status_id")
    rows = (
        members.join(pp, ["plan_id", "plan_version_id", "project_id"]).join(maps, "map_plan_id").join(demo, "map_outlet_id")
        .join(colour_flags(t, as_of), ["plan_id", "project_id"], "left").join(last_run, "map_plan_id", "left")
        .join(project, "project_id", "left")
        .join(goal_segment, "campaign_goal_id", "left")
        .withColumn("listed_segment_id", F.when(plan_status == COMPLETE_PLAN, F.col("goal_segment_id")).otherwise(F.col("segment_id")))
        .join(parts, "listed_segment_id", "left")
        .withColumn("shown_status", F.when((F.col("past_project") == "N") & (F.col("optimize_yn") == "Y") & (plan_status == RUNNING_PLAN),
                                           F.lit(2)).otherwise(F.col("status_cd")))
        .join(named(t.plan_status, "plan_status_id", "shown_status", "name", "project_status"), "shown_status", "left")
        .join(named(t.plan_status, "plan_status_id", "plan_status_id", "name", "plan_status"), "plan_status_id", "left")
        .join(named(t.phase, "phase_type", "phase_type", "description", "ph_description"), "phase_type", "left")
        .join(named(t.demo, "demo_id", "demo_id", "name", "demo"), "demo_id", "left")
        .join(named(t.demo, "demo_id", "project_demo_id", "name", "project_demo"), "project_demo_id", "left")
        .join(named(t.segment, "segment_id", "segment_id", "segment_name", "segment_name"), "segment_id", "left")
        .join(named(t.segment, "segment_id", "project_segment_id", "segment_name", "project_segment"), "project_segment_id", "left")
        .join(named(t.subevent, "subevent_id", "subevent_id", "subevent_name", "subevent_name"), "subevent_id", "left")
        .join(named(t.media_outlet, "media_outlet_id", "project_outlet_id", "short_name", "network_name"), "project_outlet_id", "left")
        .join(named(t.plan, "plan_id", "plan_id", "name", "msg_plan_name"), "plan_id", "left")
        .join(named(t.campaign_type, "campaign_type_id", "campaign_type_id", "name", "campaign_type"), "campaign_type_id", "left")
        .join(t.cluster, "cluster_id", "left")
        .withColumns({
            "no_of_weeks": flight_weeks(F.col("on_map_start"), F.col("on_map_end")),
            "project_weeks": flight_weeks(F.col("project_start_date"), F.col("project_end_date")),
            "colour_check_flag": F.when(F.col("past_project") == "Y", "N").otherwise(F.coalesce("flag", F.lit("N"))),
            "exec_end_ts": F.coalesce("run_ts", "plan_update_ts"),
            "network_display_seq": own_network_first(F.col("project_outlet_id"), F.col("map_outlet_id")),
            "network_target_demo_id": F.col("demo_id" if network_target == "project" else "default_demo_id"),
            "network_target_demo_name": F.col("demo" if network_target == "project" else "default_demo_name"),
        })
        .select(
            "map_plan_id", "plan_id", "project_id", "past_project", "campaign_goal_id", "display_seq", "project_name", "phase_type", "ph_description",
            "is_episodic", "project_outlet_id", "network_name", "status_cd", "project_status", "proj_reach_percent", "proj_grp", "project_start_date",
            "project_end_date", "on_map_start", "on_map_end", "on_map_premiere", "premiere_date", "no_of_weeks", "project_weeks", "project_freq",
            "project_segment", "project_demo", "campaign_type", "demo_id", "demo", "segment_id", "segment_selected", "segment_name", "plan_name",
            "msg_plan_name", "plan_status_id", "plan_status", "status_comment", "frequency", "target_reach", "target_grp", "episode_priority",
            "no_of_episode", "colour_check_flag", "priority", "scatter_imps", "subevent_name", "exec_end_ts", "is_dirty", "user_comment",
            "last_opt_version_ts", "network_target_demo_id", "network_target_demo_name", "network_display_seq", "cluster_id", "cluster_name",
            "guide_reach_pct", "guide_grp", "guide_spots", "segment_type_id", "segment_mask", "project_segment_id", "project_demo_id", "campaign_type_id",
            "map_colour_updated_ts", "on_map_start_ts", "on_map_end_ts")
    )
    # Weeks are matched on slim keys; the wide rows join once, at the end.
    by_row, weeks = ["map_plan_id", "plan_id", "project_id"], ["week_start", "week_label", "units"]
    amounts = t.derived(f"edit_amounts_{output_type}", AMOUNTS_OF, lambda t: weekly_amounts(t, output_type))
    cells = match_right_null(slim.select(*by_row, "campaign_goal_id"), amounts, "campaign_goal_id", "project_id", ["map_plan_id"], by_row).select(*by_row, *weeks).distinct()
    return rows.join(cells, by_row).withColumnRenamed("week_label", "week")
