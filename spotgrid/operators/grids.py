"""Plan maps by quarter and by week: one row per project and week or day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotgrid.functions.columns import UNITS, measure, own_network_first
from spotgrid.functions.joins import day_map
from spotgrid.operators.inventory import by_week
from spotgrid.plans.calendar import quarter_weeks
from spotgrid.plans.context import (
    IN_PROGRESS_STATUS,
    LIVE_VERSION,
    REPORT_COLUMNS,
    carry_over_projects,
    current_projects,
    dealt,
    last_opt_label,
    latest_completed_version,
    latest_model_version,
    latest_version,
    project_info,
    star_enrich,
    with_last_opt_label,
)
from spotgrid.sources.shared import stage

GOAL_KEYS = ["plan_id", "project_id", "media_outlet_id", "campaign_goal_id"]
LONG_CLOCK = "MM/dd/yyyy hh:mm:ss a"


def map_plans(t) -> DataFrame:
    return t.plan.select(F.col("plan_id").alias("map_plan_id"), F.col("media_outlet_id").alias("map_outlet_id"),
                         F.col("plan_type").alias("map_plan_type"), F.col("period_id").alias("map_period_id"))


def completed_or_first_version(t) -> DataFrame:
    """Latest completed version of every plan, 0 if none: a row per plan, written once, so its size is known."""
    def build(t) -> DataFrame:
        done = latest_completed_version(t.model_exec)
        return t.plan.select("plan_id", "media_outlet_id").join(done, "plan_id", "left").withColumn(
            "plan_version_id", F.coalesce("plan_version_id", F.lit(0).cast("bigint")))

    return t.derived("completed_versions", ("plan", "model_exec"), build)


def run_versions(t) -> DataFrame:
    """``latest_model_version`` of these tables, written once."""
    return t.derived("run_versions", ("plan", "model_exec"), lambda t: latest_model_version(t.plan, t.model_exec))


def of_goals(spots: DataFrame, versions: DataFrame, on: list[str], goals: DataFrame, projects: DataFrame) -> DataFrame:
    """What is shown with the spots of each plan, project, outlet and goal; many spots share it, so these keys look it up, not the spots."""
    keys = spots.select(*GOAL_KEYS).distinct()
    return keys.join(versions, on).join(goals, ["campaign_goal_id", "media_outlet_id"]).join(
        projects.join(versions.select("plan_id", "plan_version_id").distinct(), ["plan_id", "plan_version_id"], "left_semi"),
        ["plan_id", "plan_version_id", "project_id"])


def live_rows(facts: DataFrame) -> DataFrame:
    return facts.where((F.col("plan_version_id") == LIVE_VERSION) & (F.col("active_yn") == "Y"))


def labelled(rows: DataFrame, t) -> DataFrame:
    """Rows with their optimisation label. One project has at most a row per map day here, so a window serves."""
    return with_last_opt_label(rows, t.plan_project, t.plan_project_episode, t.model_exec)


def labelled_by_join(rows: DataFrame, t, name: str) -> DataFrame:
    """Rows with their optimisation label, for reports whose rows per project have no bound.

    The rows are written once; the labels come from their distinct keys, so no project meets in one task.
    """
    written = stage(t.spark, rows, name)
    labels = last_opt_label(written, t.plan_project, t.plan_project_episode, t.model_exec)
    return written.join(labels, ["map_plan_id", "project_id"], "left")


def finish(labelled: DataFrame, t, keep: list[str]) -> DataFrame:
    """Dimension names and the report's columns for labelled rows holding a map plan."""
    named = star_enrich(labelled, t).withColumn(
        "network_display_seq", own_network_first(F.col("project_outlet_id"), F.col("map_outlet_id")))
    return named.select(*keep, *REPORT_COLUMNS, "last_opt_version_ts")


def quarterly_members(t) -> DataFrame:
    """(map plan, source plan, version, project) of every map whose plan has a completed run."""
    done = latest_completed_version(t.model_exec)
    current = (
        current_projects(t.plan_project, t.plan_project_episode, done)
        .select(F.col("plan_id").alias("map_plan_id"), "plan_id", "plan_version_id", "project_id").distinct()
        .withColumn("past_project", F.lit("N"))
    )
    carry = (
        carry_over_projects(t.schedule, t.schedule_episode, t.plan, t.cal_period)
        .join(done.select(F.col("plan_id").alias("map_plan_id")), "map_plan_id", "left_semi")
        .join(run_versions(t), "plan_id")
    )
    with_episode = t.plan_project_episode.select("plan_id", "plan_version_id", "project_id").distinct()
    past = carry.where(F.col("phase_dur_type") == "PAST LAUNCH").unionByName(
        carry.where(F.col("phase_dur_type") == "PAST EP").join(with_episode, ["plan_id", "plan_version_id", "project_id"], "left_semi")
    ).drop("phase_dur_type").withColumn("past_project", F.lit("Y"))
    return current.unionByName(past)


def quarterly_projects(t, output_type: int = UNITS) -> DataFrame:
    """Project by week grid of every map over two quarters.

    Weekly sums are packed per goal (a few dozen weeks at most) and the weeks unfold last,
    so the wide project rows are never shuffled once per week.
    """
    t = t.with_day_sums(own_plans=True)
    weekly = by_week(live_rows(t.schedule), t.cal_period, ["planned_units", "planned_grp"], "plan_id", "campaign_goal_id")
    packed = weekly.groupBy("plan_id", "campaign_goal_id").agg(
        F.map_from_entries(F.collect_list(F.struct("week_start", F.struct("planned_units", "planned_grp")))).alias("by_week"))
    weeks = quarter_weeks(t.cal_period).groupBy(F.col("period_id").alias("map_period_id")).agg(
        F.sort_array(F.collect_list("week_start")).alias("weeks"))
    rows = (
        quarterly_members(t).join(project_info(t.plan_project), ["plan_id", "plan_version_id", "project_id"])
        .join(map_plans(t), "map_plan_id")
        .join(t.project.select("project_id", F.col("project_type").alias("map_plan_type")), ["project_id", "map_plan_type"], "left_semi")
    )
    # The packed weeks come after the label, which shuffles the rows.
    shown = labelled(rows.join(weeks.select("map_period_id"), "map_period_id", "left_semi"), t).join(packed, ["plan_id", "campaign_goal_id"], "left")
    grid = finish(shown.join(weeks, "map_period_id"), t,
                  ["map_plan_id", "plan_id", "project_id", "demo_id", "past_project", "by_week", "weeks"])
    cell = F.try_element_at("by_week", "week_start_date")
    return (
        grid.withColumn("week_start_date", F.explode("weeks"))
        .withColumn("cell", cell)
        .withColumn("planned_units", measure(output_type, "cell.planned_units", "cell.planned_grp"))
        .withColumn("proj_grp", F.col("cell.planned_grp"))
        .drop("by_week", "weeks", "cell")
    )


def episode_rows(t, period_type: str, output_type: int) -> DataFrame:
    """Live episode spots by calendar slice and plan, matched to the map of the slice's quarter."""
    t = t.with_day_sums(own_plans=True, schedules=["schedule_episode"])
    live = t.schedule_episode.where(F.col("plan_version_id") == LIVE_VERSION)
    slices = day_map(t.cal_period, period_type).select("day", "fiscal_qtr", F.col("period_start").alias("slice_start"))
    quarters = t.cal_period.where(F.col("period_type") == "Q").select(F.col("name").alias("fiscal_qtr"), F.col("period_id").alias("map_period_id"))
    summed = live.join(slices, F.col("start_date") == F.col("day")).groupBy(
        "plan_id", "media_outlet_id", "project_id", "episode_id", "slice_start", "fiscal_qtr"
    ).agg(F.sum(measure(output_type)).alias("planned_units"))
    typed = t.plan.select("plan_id", F.col("plan_type").alias("map_plan_type"))
    versions = typed.select("plan_id").join(
        latest_version(t.plan_version).withColumnRenamed("plan_version_id", "own_version"), "plan_id", "left"
    ).join(run_versions(t).withColumnRenamed("plan_version_id", "run_version"), "plan_id", "left")
    starts = t.plan_project_episode.select("plan_id", "plan_version_id", "project_id", "episode_id",
                                           F.date_format("episode_start_ts", LONG_CLOCK).alias("episode_start_ts"))
    return (
        summed.join(quarters, "fiscal_qtr").join(typed, "plan_id")
        .withColumnRenamed("media_outlet_id", "map_outlet_id")
        .join(map_plans(t), ["map_outlet_id", "map_plan_type", "map_period_id"])
        .join(versions, "plan_id")
        .withColumn("plan_version_id", F.when(F.col("map_plan_id") == F.col("plan_id"), F.col("own_version"))
                    .otherwise(F.coalesce("run_version", F.lit(0))))
        .join(starts, ["plan_id", "plan_version_id", "project_id", "episode_id"])
        .select("map_plan_id", "plan_id", "project_id", "episode_id", "slice_start", "planned_units", "episode_start_ts")
    )


def quarterly_episodes(t, output_type: int = UNITS) -> DataFrame:
    return episode_rows(t, "W", output_type).withColumnRenamed("slice_start", "week_date")


def weekly_episode_units(t, output_type: int = UNITS) -> DataFrame:
    return episode_rows(t, "D", output_type).withColumnRenamed("slice_start", "week_date")


def weekly_projects(t, output_type: int = UNITS) -> DataFrame:
    """Projects of every map and week: own launch spots, own episode-only projects, and earlier plans' projects."""
    t = t.with_day_sums(own_plans=True)
    week_of = day_map(t.cal_period, "W").select(F.col("day").alias("start_date"), F.col("period_start").alias("week_start"))
    info = project_info(t.plan_project)
    planned = info.where(F.col("status_cd") != IN_PROGRESS_STATUS)
    version = completed_or_first_version(t)
    goal = t.campaign_goal.select("campaign_goal_id", "media_outlet_id", "demo_id", "segment_id", "frequency",
                                  F.col("start_date").alias("proj_start_date"), F.col("end_date").alias("proj_end_date"))
    sums = [F.sum(measure(output_type)).alias("units"), F.sum("planned_grp").alias("proj_grp")]

    active = t.schedule.where(F.col("active_yn") == "Y")
    daily = dealt(active.select(*GOAL_KEYS, "start_date", "end_date", "planned_units", "planned_grp")).groupBy(
        *GOAL_KEYS, "start_date", "end_date").agg(*sums).join(week_of, "start_date")
    from_pp = ["demo_id", "segment_id", "frequency", "proj_start_date", "proj_end_date", "campaign_goal_id"]
    own_launch = (
        daily.join(dealt(of_goals(active, version, ["plan_id", "media_outlet_id"], goal, planned.drop(*from_pp))), GOAL_KEYS)
        .withColumns({"map_plan_id": F.col("plan_id"), "past_project": F.lit("N")})
    )

    launched = dealt(t.schedule.join(week_of, "start_date").select("plan_id", "project_id", "week_start").distinct())
    episodes = (
        dealt(t.schedule_episode.where(F.col("active_yn") == "Y").select("plan_id", "project_id", "media_outlet_id", "start_date", "end_date")).groupBy("plan_id", "project_id", "media_outlet_id", "start_date")
        .agg(F.min("end_date").alias("end_date")).join(week_of, "start_date")
        .groupBy("plan_id", "project_id", "media_outlet_id", "week_start")
        .agg(F.min("start_date").alias("start_date"), F.min("end_date").alias("end_date"))
    )
    zero_of = {f.name: F.lit(0).cast(f.dataType) for f in daily.schema if f.name in ("units", "proj_grp")}
    own_episode = (
        episodes.join(launched, ["plan_id", "project_id", "week_start"], "left_anti")
        .join(version, ["plan_id", "media_outlet_id"])
        .join(dealt(planned.join(version, ["plan_id", "plan_version_id"], "left_semi")), ["plan_id", "plan_version_id", "project_id"])
        .withColumns({"map_plan_id": F.col("plan_id"), "past_project": F.lit("N"), **zero_of})
    )

    # Dealt by plan and goal once, for the sums and for the join with earlier plans' projects.
    goal_spots = live_rows(t.schedule).select("plan_id", "campaign_goal_id", "start_date", "end_date", "planned_units", "planned_grp")
    goal_days = goal_spots.repartition("plan_id", "campaign_goal_id").groupBy(
        "plan_id", "campaign_goal_id", "start_date", "end_date").agg(*sums).join(week_of, "start_date")
    run = run_versions(t)
    past = (
        carry_over_projects(t.schedule, t.schedule_episode, t.plan, t.cal_period, n_quarters=2, window="week_start")
        .join(run, "plan_id")
        .join(info.join(run, ["plan_id", "plan_version_id"], "left_semi"), ["plan_id", "plan_version_id", "project_id"])
        .join(t.project.select("project_id", "project_type"), "project_id")
        .join(t.plan.select("plan_id", "plan_type"), "plan_id").where(F.col("project_type") == F.col("plan_type"))
        .repartition("plan_id", "campaign_goal_id").join(goal_days, ["plan_id", "campaign_goal_id", "week_start"], "left")
        .withColumn("past_project", F.lit("Y"))
    )

    keep = ["map_plan_id", "plan_id", "project_id", "week_start", "start_date", "end_date", "units", "proj_grp", "past_project"]
    slim = [*keep, "status_cd", "demo_id", "segment_id", "frequency", "cluster_id", "phase_type", "priority", "no_of_episode",
            "target_grp", "project_display_seq", "target_reach", "proj_reach_percent", "proj_planned_grp", "episode_priority",
            "premiere_date", "proj_start_date", "proj_end_date", "no_of_weeks"]
    # The branches cannot meet: episode-only rows exclude launch weeks, and earlier plans are marked.
    rows = own_launch.select(*slim).unionByName(own_episode.select(*slim)).unionByName(dealt(past.select(*slim)))
    return finish(labelled(rows.join(map_plans(t), "map_plan_id"), t), t, keep)
