"""Which plan, version, project and dimension rows a report works with - for all plans at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotgrid.functions.columns import flight_weeks, model_type
from spotgrid.plans.calendar import ids_are_dense, map_days, next_quarter_by_date, periods

COMPLETED = "C"
IN_PROGRESS_STATUS = 2
LIVE_VERSION = 0
LAUNCH_EPISODE = 1


def plan_context(plan: DataFrame, cal: DataFrame) -> DataFrame:
    """Every plan with its model type, its quarter and the end of the following quarter."""
    q = periods(cal, "Q").select("period_id", F.col("name").alias("qtr_name"),
                                 F.col("start_date").alias("qtr_start"), F.col("end_date").alias("qtr_end"))
    nxt = next_quarter_by_date(cal).select("period_id", "map_end")
    return (
        plan.select("plan_id", "media_outlet_id", "plan_type", "period_id", "plan_status_id")
        .join(q, "period_id").join(nxt, "period_id", "left")
        .withColumn("model_type_id", model_type(F.col("plan_type")))
        .select("plan_id", "media_outlet_id", "plan_type", "model_type_id", "period_id", "plan_status_id",
                "qtr_name", "qtr_start", "qtr_end", "map_end")
    )


def latest_completed_version(model_exec: DataFrame, keys: tuple[str, ...] = ("plan_id",)) -> DataFrame:
    return (
        model_exec.where(F.col("exec_status_cd") == COMPLETED)
        .groupBy(*keys).agg(F.max("plan_version_id").alias("plan_version_id"))
    )


def latest_model_version(plan: DataFrame, model_exec: DataFrame) -> DataFrame:
    """Latest completed version of each plan, counting only runs of the plan's own model type and outlet."""
    runs = latest_completed_version(model_exec, ("plan_id", "media_outlet_id", "model_type_id"))
    own = plan.select("plan_id", "media_outlet_id", model_type(F.col("plan_type")).alias("model_type_id"))
    return own.join(runs, ["plan_id", "media_outlet_id", "model_type_id"]).select("plan_id", "plan_version_id")


def latest_version(plan_version: DataFrame) -> DataFrame:
    return plan_version.groupBy("plan_id").agg(F.max("plan_version_id").alias("plan_version_id"))


def neighbour_plan(plan: DataFrame, cal: DataFrame, step: int, active_only: bool) -> DataFrame:
    """Plan of the same outlet and type ``step`` quarters on, by id; the calendar's ids must be dense."""
    other = plan.where(F.col("active_yn") == "Y") if active_only else plan
    other = other.select("media_outlet_id", "plan_type", (F.col("period_id") - step).alias("period_id"),
                         F.col("plan_id").alias("other_plan_id"))
    return (
        plan.where(ids_are_dense(cal)).select("plan_id", "media_outlet_id", "plan_type", "period_id")
        .join(other, ["media_outlet_id", "plan_type", "period_id"])
        .select("plan_id", "other_plan_id")
    )


def past_plan(plan: DataFrame, cal: DataFrame) -> DataFrame:
    return neighbour_plan(plan, cal, -1, active_only=True).withColumnRenamed("other_plan_id", "past_plan_id")


def future_plan(plan: DataFrame, cal: DataFrame) -> DataFrame:
    return neighbour_plan(plan, cal, 1, active_only=False).withColumnRenamed("other_plan_id", "future_plan_id")


def default_demo(outlet_demo: DataFrame) -> DataFrame:
    return (
        outlet_demo.where(F.col("default_yn") == "Y")
        .groupBy("media_outlet_id").agg(F.min("demo_id").alias("demo_id"))
    )


def optimised_runs(plan_project: DataFrame, episode: DataFrame, model_exec: DataFrame) -> DataFrame:
    """Newest completed optimisation per plan and project as a struct; an episode run (phase 2) beats a launch run."""
    runs = (
        model_exec.where(F.col("exec_status_cd") == COMPLETED)
        .groupBy("plan_id", "plan_version_id").agg(F.max("exec_end_ts").alias("exec_end_ts"))
    )

    def optimised(df: DataFrame, phase: int) -> DataFrame:
        wanted = df.where(F.col("optimize_yn") == "Y").select("plan_id", "plan_version_id", "project_id").distinct()
        return wanted.join(runs, ["plan_id", "plan_version_id"]).groupBy("plan_id", "project_id").agg(
            F.max("plan_version_id").alias("v"), F.max("exec_end_ts").alias("ts")
        ).withColumn("phase", F.lit(phase))

    return (
        optimised(plan_project, 1).unionByName(optimised(episode, 2))
        .groupBy("plan_id", "project_id").agg(F.max(F.struct("phase", "v", "ts")).alias("run"))
    )


def dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt by project: joins, sums and windows by the project and more columns then need no shuffle of their own."""
    return rows.repartition("project_id")


def with_last_opt_label(rows: DataFrame, plan_project: DataFrame, episode: DataFrame, model_exec: DataFrame) -> DataFrame:
    """Add the optimisation label to slim report rows holding (map_plan_id, plan_id, project_id).

    A project that reaches one map from several plans shows one label: the episode run if any, then the newest plan's.
    """
    best = optimised_runs(plan_project, episode, model_exec)
    candidate = F.when(F.col("run").isNotNull(), F.struct(
        F.col("run.phase").alias("phase"), F.col("plan_id").alias("plan_id"), F.col("run.v").alias("v"), F.col("run.ts").alias("ts")))
    per_project = Window.partitionBy("map_plan_id", "project_id")
    return (
        rows.join(dealt(best), ["plan_id", "project_id"], "left").withColumn("run", F.max(candidate).over(per_project))
        .withColumn("last_opt_version_ts", F.concat(
            F.lit("v"), F.col("run.v") + 1, F.lit(" "), F.date_format("run.ts", "MM/dd/yyyy hh:mm a")))
        .drop("run")
    )


def last_opt_label(members: DataFrame, plan_project: DataFrame, episode: DataFrame, model_exec: DataFrame) -> DataFrame:
    """One label per (map_plan_id, project_id) of ``members`` that was ever optimised."""
    slim = members.select("map_plan_id", "plan_id", "project_id").distinct()
    return (
        with_last_opt_label(slim, plan_project, episode, model_exec)
        .where(F.col("last_opt_version_ts").isNotNull())
        .select("map_plan_id", "project_id", "last_opt_version_ts").distinct()
    )


def on_map_periods(facts: DataFrame, cal: DataFrame, n_quarters: int, keys: list[str]) -> DataFrame:
    """Distinct keys of dated facts per map quarter that shows them.

    Only the calendar is joined to the facts; what shuffles is one row per key and quarter. The days are bounded by the
    calendar, which Spark's estimate of their size doesn't show.
    """
    days = map_days(cal, n_quarters).select(F.col("day").alias("start_date"), "week_start", F.col("period_id").alias("map_period_id"))
    return facts.join(F.broadcast(days), "start_date").select(*keys, "map_period_id").distinct()


def carry_over_rows(facts: DataFrame, plan: DataFrame, cal: DataFrame, n_quarters: int, window: str) -> DataFrame:
    """Live schedule rows that fall inside the map of a later plan, one row per (map plan, source row key).

    ``window`` is the column that bounds one report: ``map_plan_id`` (quarter), ``week_start`` or ``day``.
    """
    live = facts.where((F.col("plan_version_id") == LIVE_VERSION) & (F.col("active_yn") == "Y"))
    extra = [] if window == "map_plan_id" else [window]
    seen = on_map_periods(live, cal, n_quarters, ["plan_id", "project_id", *extra])
    src = plan.select("plan_id", "media_outlet_id", "plan_type", F.col("period_id").alias("src_period"))
    target = plan.select(F.col("plan_id").alias("map_plan_id"), "media_outlet_id", "plan_type", F.col("period_id").alias("map_period_id"))
    return (
        seen.join(src, "plan_id").where(F.col("map_period_id") > F.col("src_period"))
        .join(target, ["media_outlet_id", "plan_type", "map_period_id"])
        .select("map_plan_id", *extra, "plan_id", "project_id")
    )


def carry_over_projects(schedule: DataFrame, schedule_episode: DataFrame, plan: DataFrame, cal: DataFrame,
                        n_quarters: int = 1, window: str = "map_plan_id") -> DataFrame:
    """Projects of earlier plans still on air inside a map; launch rows hide episode rows of the same project."""
    keys = ["map_plan_id", "project_id"] + ([] if window == "map_plan_id" else [window])
    launch = carry_over_rows(schedule, plan, cal, n_quarters, window)
    episode = carry_over_rows(schedule_episode, plan, cal, n_quarters, window)
    episode_only = episode.join(launch.select(*keys).distinct(), keys, "left_anti")
    return launch.withColumn("phase_dur_type", F.lit("PAST LAUNCH")).unionByName(
        episode_only.withColumn("phase_dur_type", F.lit("PAST EP"))
    )


def current_projects(plan_project: DataFrame, episode: DataFrame, version: DataFrame) -> DataFrame:
    """Projects with a goal in the given version of each plan: launch first, else their episodes."""
    pp = plan_project.where(F.col("status_cd") != IN_PROGRESS_STATUS).join(version, ["plan_id", "plan_version_id"], "left_semi")
    keys = ["plan_id", "plan_version_id", "project_id"]
    launch = pp.where(F.col("campaign_goal_id") > 0).select(*keys)
    with_goal = episode.where(F.col("campaign_goal_id") > 0).select(*keys, "episode_id")
    episodes = (
        pp.select(*keys).join(launch, ["plan_id", "project_id"], "left_anti")
        .join(with_goal, keys)
    )
    return (
        launch.withColumns({"episode_id": F.lit(LAUNCH_EPISODE), "phase_dur_type": F.lit("CUR LAUNCH")})
        .unionByName(episodes.withColumn("phase_dur_type", F.lit("CUR EP")))
    )


def star_enrich(df: DataFrame, t, demo_col: str = "demo_id", segment_col: str = "segment_id") -> DataFrame:
    """Attach project, audience, segment, network, cluster, status, phase, campaign and event names.

    The joins carry no hints: the optimizer broadcasts each dimension whose size allows it.
    """
    project = t.project.select(
        "project_id", F.col("name").alias("project_name"), F.col("media_outlet_id").alias("project_outlet_id"),
        "project_type", "campaign_type_id", F.col("user_comment").alias("project_comment"), "scatter_imps",
        "event_type_id", "subevent_id",
    )
    demo = t.demo.select(F.col("demo_id").alias(demo_col), F.col("name").alias("demo"))
    segment = t.segment.select(F.col("segment_id").alias(segment_col), F.col("segment_name").alias("segment"))
    outlet = t.media_outlet.select(F.col("media_outlet_id").alias("project_outlet_id"), F.col("short_name").alias("media_outlet_name"))
    status = t.plan_status.select(F.col("plan_status_id").alias("status_cd"), F.col("name").alias("status"))
    phase = t.phase.select("phase_type", F.col("description").alias("ph_desc"))
    campaign = t.campaign_type.select("campaign_type_id", F.col("name").alias("type"), F.col("display_seq").alias("campaign_display_seq"))
    event = t.event_type.select("event_type_id", F.col("event_type_name").alias("event_name"))
    return (
        df.join(project, "project_id").join(demo, demo_col).join(segment, segment_col).join(outlet, "project_outlet_id")
        .join(status, "status_cd", "left").join(phase, "phase_type", "left").join(t.cluster, "cluster_id", "left")
        .join(campaign, "campaign_type_id", "left").join(event, "event_type_id", "left")
        .join(t.subevent.select("subevent_id", "subevent_name"), "subevent_id", "left")
    )


def project_info(plan_project: DataFrame) -> DataFrame:
    """The plan-project columns every report shows."""
    return plan_project.select(
        "plan_id", "plan_version_id", "project_id", "status_cd", "demo_id", "segment_id", "frequency", "campaign_goal_id",
        "cluster_id", "phase_type", "priority", "no_of_episode", "target_grp",
        F.col("display_seq").alias("project_display_seq"), F.col("target_reach_pct").alias("target_reach"),
        F.col("proj_reach_pct").alias("proj_reach_percent"), F.col("proj_grp").alias("proj_planned_grp"),
        F.nullif(F.col("episode_priority"), F.lit(0)).alias("episode_priority"),
        F.col("on_map_premiere").alias("premiere_date"),
        F.col("on_map_start").alias("proj_start_date"), F.col("on_map_end").alias("proj_end_date"),
        flight_weeks(F.col("on_map_start"), F.col("on_map_end")).alias("no_of_weeks"),
    )


REPORT_COLUMNS = [
    "project_name", "project_comment", "premiere_date", "proj_start_date", "proj_end_date", "demo", "type", "segment",
    "priority", "frequency", "target_reach", "target_grp", "proj_reach_percent", "proj_planned_grp", "status", "no_of_weeks",
    "campaign_display_seq", "project_display_seq", "network_display_seq", "scatter_imps", "project_outlet_id",
    "media_outlet_name", "cluster_id", "cluster_name", "event_type_id", "event_name", "subevent_id", "subevent_name",
    "phase_type", "ph_desc", "episode_priority", "no_of_episode",
]
