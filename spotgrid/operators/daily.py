"""Plan maps of one day: projects and episodes by daypart, for every day at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotgrid.functions.columns import UNITS, flight_weeks, measure, own_network_first
from spotgrid.operators.grids import GOAL_KEYS, LONG_CLOCK, completed_or_first_version, finish, labelled, labelled_by_join, map_plans, of_goals, run_versions
from spotgrid.plans.calendar import map_days
from spotgrid.plans.context import (
    IN_PROGRESS_STATUS,
    REPORT_COLUMNS,
    dealt,
    default_demo,
    latest_model_version,
    latest_version,
    plan_context,
    project_info,
    star_enrich,
)

# Fixed value: people per impression unit.
IMPRESSION_BASE = 100000


def dayparts(t) -> DataFrame:
    return t.daypart.where(F.col("active_yn") == "Y").select("daypart_id", "media_outlet_id", F.col("name").alias("daypart"))


def on_later_maps(rows: DataFrame, t) -> DataFrame:
    """Repeat dated rows of a plan for the maps of later plans that show the day."""
    src = t.plan.select("plan_id", "plan_type", F.col("period_id").alias("src_period"))
    days = map_days(t.cal_period).select(F.col("day").alias("start_date"), F.col("period_id").alias("map_period_id"))
    target = t.plan.select(F.col("plan_id").alias("map_plan_id"), "media_outlet_id", "plan_type", F.col("period_id").alias("map_period_id"))
    return (
        rows.join(src, "plan_id").join(F.broadcast(days), "start_date").where(F.col("map_period_id") > F.col("src_period"))
        .join(target, ["media_outlet_id", "plan_type", "map_period_id"]).drop("src_period", "map_period_id")
    )


def goal_columns(goals: DataFrame, *more: str) -> DataFrame:
    return goals.select("campaign_goal_id", "media_outlet_id", *more, "demo_id", "segment_id", "frequency",
                        F.col("start_date").alias("proj_start_date"), F.col("end_date").alias("proj_end_date"))


def matching_type(t) -> DataFrame:
    return t.project.select("project_id", F.col("project_type").alias("plan_type"))


def daily_primary(t, output_type: int = UNITS) -> DataFrame:
    """Campaign by daypart for each day over all plans, with scatter impressions.

    Spot and point values are part of the grain, so a sum covers equal rows only.
    """
    daily = t.schedule.where(F.col("active_yn") == "Y").groupBy(
        "plan_id", "media_outlet_id", "campaign_goal_id", "daypart_id", F.col("start_date").alias("selected_date"), "planned_units", "planned_grp"
    ).agg(F.sum("planned_units").alias("sum_units"), F.sum("planned_grp").alias("proj_grp"))
    plans = t.plan.where(F.col("active_yn") == "Y").join(plan_context(t.plan, t.cal_period).select("plan_id", "map_end"), "plan_id").select(
        "plan_id", "media_outlet_id", F.col("name").alias("plan_name"), "create_ts", "map_end")
    version = t.plan.select("plan_id").join(latest_version(t.plan_version), "plan_id", "left").withColumn(
        "plan_version_id", F.coalesce("plan_version_id", F.lit(0)))
    campaign = t.campaign.select("campaign_id", "project_id", F.col("name").alias("campaign"))
    project = t.project.select(
        "project_id", F.col("name").alias("project_name"), "media_outlet_id", "premiere_date", "campaign_type_id",
        F.col("target_demo_id").alias("demo_id"), F.col("start_date").alias("p_start"), F.col("end_date").alias("p_end"))
    goal = goal_columns(t.campaign_goal, "campaign_id").drop("demo_id")
    pp = project_info(t.plan_project).drop("demo_id", "segment_id", "frequency", "campaign_goal_id", "proj_start_date", "proj_end_date", "premiere_date")
    audience = default_demo(t.outlet_demo).join(t.demo, "demo_id").select("media_outlet_id", "universe")
    rows = (
        daily.join(plans, ["plan_id", "media_outlet_id"]).where(F.col("selected_date") <= F.col("map_end"))
        .join(goal, ["campaign_goal_id", "media_outlet_id"]).join(campaign, "campaign_id")
        .join(project, ["project_id", "media_outlet_id"])
        .where(F.col("selected_date").between(F.col("p_start"), F.col("p_end")))
        .join(version, "plan_id").join(pp, ["plan_id", "plan_version_id", "project_id"])
        .join(audience, "media_outlet_id").withColumn("map_plan_id", F.col("plan_id"))
        .groupBy("map_plan_id", "plan_id", "media_outlet_id", "plan_name", "create_ts", "campaign_id", "campaign", "project_id", "project_name",
                 "campaign_type_id", "demo_id", "segment_id", "frequency", "daypart_id", "selected_date", "planned_units", "planned_grp",
                 "proj_start_date", "proj_end_date", "premiere_date", "universe", "status_cd", "priority", "target_reach", "target_grp",
                 "proj_reach_percent", "proj_planned_grp", "no_of_weeks", "cluster_id")
        .agg(F.sum("sum_units").alias("sum_units"), F.sum("proj_grp").alias("proj_grp"))
        .withColumn("planned", measure(output_type, "sum_units", "proj_grp"))
        .withColumn("scatter_imps", (F.col("proj_grp") * F.col("universe") / IMPRESSION_BASE).cast("decimal(28,4)"))
    )
    return (
        labelled_by_join(rows, t, "daily_primary").join(t.demo.select("demo_id", F.col("name").alias("demo")), "demo_id")
        .join(t.segment.select("segment_id", F.col("segment_name").alias("segment")), "segment_id")
        .join(t.campaign_type.select("campaign_type_id", F.col("name").alias("type"), F.col("display_seq").alias("campaign_display_seq")), "campaign_type_id")
        .join(dayparts(t).select("daypart_id", "daypart"), "daypart_id")
        .join(t.cluster, "cluster_id", "left")
        .select("plan_id", "plan_name", "create_ts", "campaign_id", "campaign", "project_id", "project_name", "type", "campaign_display_seq",
                "demo", "segment", "frequency", "daypart_id", "daypart", "selected_date", F.col("planned").alias("planned_units"), "proj_grp",
                "scatter_imps", "proj_start_date", "proj_end_date", "premiere_date", "status_cd", "priority", "target_reach", "target_grp",
                "proj_reach_percent", "proj_planned_grp", "no_of_weeks", "cluster_id", "cluster_name", "last_opt_version_ts")
    )


def daily_projects(t, output_type: int = UNITS) -> DataFrame:
    """Projects by daypart for each map day: own launch and episode-only rows, then earlier plans' rows."""
    info = project_info(t.plan_project)
    planned = info.where(F.col("status_cd") != IN_PROGRESS_STATUS)
    from_pp = ["demo_id", "segment_id", "frequency", "campaign_goal_id", "proj_start_date", "proj_end_date"]
    version, run = completed_or_first_version(t), run_versions(t)
    older = info.join(run, ["plan_id", "plan_version_id"], "left_semi")
    sums = [F.sum(measure(output_type)).alias("planned_units_sum"), F.sum("planned_grp").alias("proj_grp")]
    key = ["plan_id", "project_id", "media_outlet_id", "daypart_id", "start_date"]
    # Own launch rows keep the point value in their grain; everything else is asked of the kept day sums.
    spots, every_plan, t = t.schedule.where(F.col("active_yn") == "Y"), t.with_day_sums().schedule, t.with_day_sums(own_plans=True)
    launch = t.schedule.where(F.col("active_yn") == "Y")
    episode = t.schedule_episode.where(F.col("active_yn") == "Y")
    goal = goal_columns(t.campaign_goal)

    own_launch = (
        dealt(spots.select(*key, "campaign_goal_id", "planned_units", "planned_grp"))
        .groupBy(*key, "campaign_goal_id", "planned_grp").agg(*sums).drop("planned_grp").distinct()
        .join(dealt(of_goals(launch, version, ["plan_id", "media_outlet_id"], goal, planned.drop(*from_pp))), GOAL_KEYS)
        .withColumns({"map_plan_id": F.col("plan_id"), "past_project": F.lit("N")})
    )
    zero = {f.name: F.lit(0).cast(f.dataType) for f in own_launch.schema if f.name in ("planned_units_sum", "proj_grp")}
    own_episode = (
        dealt(episode.select(*key)).distinct()
        .join(dealt(launch.select("plan_id", "project_id", "daypart_id", "start_date")), ["plan_id", "project_id", "daypart_id", "start_date"], "left_anti")
        .join(version, ["plan_id", "media_outlet_id"])
        .join(dealt(planned.join(version, ["plan_id", "plan_version_id"], "left_semi")), ["plan_id", "plan_version_id", "project_id"])
        .withColumns({"map_plan_id": F.col("plan_id"), "past_project": F.lit("N"), **zero})
    )
    past_launch = (
        on_later_maps(dealt(launch.select(*key, "campaign_goal_id", "planned_units", "planned_grp")).groupBy(*key, "campaign_goal_id").agg(*sums), t)
        .join(dealt(matching_type(t)), ["project_id", "plan_type"], "left_semi")
        .join(dealt(of_goals(launch, run, ["plan_id"], goal, older.drop(*from_pp))), GOAL_KEYS)
        .withColumn("past_project", F.lit("Y"))
    )
    launch_days = dealt(every_plan.where(F.col("active_yn") == "Y").select("project_id", "media_outlet_id", "start_date", F.col("plan_id").alias("launch_plan_id"))).distinct()
    episode_status = t.plan_project_episode.join(run, ["plan_id", "plan_version_id"], "left_semi").select("plan_id", "plan_version_id", "project_id", "episode_id", F.col("status_cd").alias("episode_status"))
    e = on_later_maps(dealt(episode.select(*key, "episode_id", "campaign_goal_id")).distinct(), t).alias("e")
    hidden = (
        (F.col("e.project_id") == F.col("l.project_id")) & (F.col("e.media_outlet_id") == F.col("l.media_outlet_id"))
        & (F.col("e.start_date") == F.col("l.start_date")) & (F.col("e.map_plan_id") != F.col("l.launch_plan_id"))
    )
    past_episode = (
        e.join(launch_days.alias("l"), hidden, "left_anti")
        .join(dealt(matching_type(t)), ["project_id", "plan_type"], "left_semi")
        .join(dealt(of_goals(episode, run, ["plan_id"], goal_columns(t.campaign_goal_episode), older.drop(*from_pp).drop("status_cd"))), GOAL_KEYS)
        .join(dealt(episode_status), ["plan_id", "plan_version_id", "project_id", "episode_id"])
        .withColumnRenamed("episode_status", "status_cd")
    )
    keep = ["map_plan_id", "plan_id", "project_id", "daypart_id", "start_date", "past_project", "planned_units_sum", "proj_grp"]
    attributes = ["status_cd", "demo_id", "segment_id", "frequency", "cluster_id", "phase_type", "priority", "no_of_episode", "target_grp",
                  "project_display_seq", "target_reach", "proj_reach_percent", "proj_planned_grp", "episode_priority", "premiere_date", "no_of_weeks"]
    flight = ["proj_start_date", "proj_end_date"]
    past_episode = (
        past_episode.groupBy(*[c for c in keep if c not in zero and c != "past_project"], *attributes)
        .agg(F.min("proj_start_date").alias("proj_start_date"), F.max("proj_end_date").alias("proj_end_date"))
        .withColumns({"past_project": F.lit("Y"), **zero})
    )
    slim = [*keep, *attributes, *flight]
    rows = (
        own_launch.select(*slim).unionByName(own_episode.select(*slim))
        .unionByName(past_launch.select(*slim)).unionByName(past_episode.select(*slim))
        .join(map_plans(t), "map_plan_id")
        .join(dayparts(t).withColumnRenamed("media_outlet_id", "map_outlet_id"), ["daypart_id", "map_outlet_id"])
    )
    # All branches are dealt by project, so the label's window needs no shuffle of the wide rows; its groups spill.
    out = finish(labelled(rows, t), t, [*keep, "daypart"])
    return out.withColumnsRenamed({"planned_units_sum": "planned_units", "start_date": "selected_date"})


def daily_episodes(t, output_type: int = UNITS) -> DataFrame:
    """Episode by daypart detail for each map day, own plan and earlier plans."""
    key = ["plan_id", "project_id", "episode_id", "media_outlet_id", "daypart_id", "campaign_goal_id", "start_date"]
    daily = t.schedule_episode.where(F.col("active_yn") == "Y").groupBy(*key).agg(
        F.sum(measure(output_type)).alias("planned_units"), F.sum("planned_grp").alias("proj_grp"))
    any_run = t.model_exec.groupBy("plan_id").agg(F.max("plan_version_id").alias("plan_version_id"))
    own = (
        daily.join(t.plan.select("plan_id", "media_outlet_id"), ["plan_id", "media_outlet_id"], "left_semi").join(any_run, "plan_id")
        .withColumns({"map_plan_id": F.col("plan_id"), "past_project": F.lit("N")})
    )
    past = (
        on_later_maps(daily, t).join(matching_type(t), ["project_id", "plan_type"], "left_semi")
        .join(latest_model_version(t.plan, t.model_exec), "plan_id").withColumn("past_project", F.lit("Y"))
    )
    slim = [*key, "plan_version_id", "map_plan_id", "past_project", "planned_units", "proj_grp"]
    goal = goal_columns(t.campaign_goal_episode, "campaign_id", "episode_id")
    ppe = t.plan_project_episode.select(
        "plan_id", "plan_version_id", "project_id", "episode_id", "status_cd", "priority", "target_grp", "cluster_id",
        F.col("proj_reach_pct").alias("proj_reach_percent"), F.col("proj_grp").alias("proj_planned_grp"),
        flight_weeks(F.col("on_map_start"), F.col("on_map_end")).alias("no_of_weeks"),
        F.date_format("episode_start_ts", LONG_CLOCK).alias("episode_start_ts"), F.lit(None).cast("int").alias("phase_type"))
    rows = (
        own.select(*slim).unionByName(past.select(*slim))
        .join(goal, ["campaign_goal_id", "media_outlet_id", "episode_id"])
        .join(t.campaign.select("campaign_id", "project_id"), ["campaign_id", "project_id"], "left_semi")
        .join(ppe, ["plan_id", "plan_version_id", "project_id", "episode_id"])
        .join(dayparts(t), ["daypart_id", "media_outlet_id"])
    )
    named = star_enrich(rows.withColumnRenamed("media_outlet_id", "map_outlet_id"), t).join(
        t.project.select("project_id", "premiere_date"), "project_id")
    wanted = [c for c in REPORT_COLUMNS if c not in {"target_reach", "project_display_seq", "network_display_seq", "phase_type", "ph_desc",
                                                     "episode_priority", "no_of_episode"}]
    return named.select(
        "map_plan_id", "plan_id", "project_id", "episode_id", "campaign_id", "daypart_id", "daypart", F.col("start_date").alias("selected_date"),
        "past_project", "planned_units", "proj_grp", "episode_start_ts",
        own_network_first(F.col("project_outlet_id"), F.col("map_outlet_id")).alias("network_display_seq"), *wanted)
