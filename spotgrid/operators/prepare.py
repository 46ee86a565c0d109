"""Prepare optimisation requests: run rows, measurement windows, known ids, status and parameters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotgrid.functions.columns import model_type
from spotgrid.functions.joins import assign_ids, snapshot_merge
from spotgrid.plans.context import IN_PROGRESS_STATUS, latest_version

# Codes, and the run parameters by optimisation type.
PENDING, SUBMITTED_CODE = "P", "S"
CHANGED_STATUS, CLUSTER_FLOOR = 11, 1
OPTIMISE_TYPE = 1
OPTIMISE_PARAMS = {1: 3, 2: 1, 12: 0}
DISTRIBUTE_PARAMS = {1: 2}
PARAM_MODEL_TYPE = 1


def new_exec_requests(t, as_of: dt.datetime) -> DataFrame:
    """One pending run per plan's newest version, numbered after the existing runs."""
    newest = latest_version(t.plan_version).join(
        t.plan.select("plan_id", "media_outlet_id", model_type(F.col("plan_type")).alias("model_type_id")), "plan_id")
    kinds = t.plan_version.select("plan_id", "plan_version_id", "optimization_type")
    return assign_ids(newest.join(kinds, ["plan_id", "plan_version_id"]), "model_exec_id", "plan_id", t.model_exec).select(
        "model_exec_id", "model_type_id", "media_outlet_id", "plan_id", "plan_version_id", "optimization_type",
        F.lit(PENDING).alias("exec_status_cd"), F.lit(as_of).alias("req_ts"))


def linked_versions(t, as_of: dt.datetime) -> DataFrame:
    """Version table with each newest version pointing at its new run."""
    runs = new_exec_requests(t, as_of).select("plan_id", "plan_version_id", F.col("model_exec_id").alias("new_exec"))
    rows = t.plan_version.join(runs, ["plan_id", "plan_version_id"]).withColumn("model_exec_id", F.col("new_exec")).drop("new_exec")
    return snapshot_merge(t.plan_version, rows, ["plan_id", "plan_version_id"])


def submitted_plans(t, as_of: dt.datetime) -> DataFrame:
    """Plan table with every requested plan in submitted state."""
    submitted = t.plan_status.where(F.col("code") == SUBMITTED_CODE).select(F.min("plan_status_id")).scalar()
    requested = t.plan_version.select("plan_id").distinct()
    rows = t.plan.join(requested, "plan_id", "left_semi").withColumns({"plan_status_id": submitted, "schedule_ts": F.lit(as_of)})
    return snapshot_merge(t.plan.withColumn("schedule_ts", F.lit(None).cast("timestamp")), rows, ["plan_id"])


def measurement_window(rows: DataFrame, versions: DataFrame, last_measured: dt.date, keys: list[str]) -> DataFrame:
    """Measurement dates of each plan's newest version.

    Flights already measured inherit the previous version's window; a changed cluster flight loses it.
    A missing end is the last measured date that falls on the flight end's weekday, a missing start
    lies a flight's length before the end.
    """
    newest = rows.join(versions, ["plan_id", "plan_version_id"], "left_semi")
    before = rows.select("plan_id", (F.col("plan_version_id") + 1).alias("plan_version_id"), *keys,
                         F.col("measured_start").alias("b_start"), F.col("measured_end").alias("b_end"),
                         F.col("on_map_start").alias("b_from"), F.col("on_map_end").alias("b_to"), F.lit(True).alias("had"))
    measured = F.lit(last_measured)
    inherits = F.coalesce("had", F.lit(False)) & (F.col("on_map_start") <= measured)
    moved = (F.col("cluster_id") > CLUSTER_FLOOR) & (F.col("status_cd") == CHANGED_STATUS) & ~(
        (F.col("on_map_start") == F.col("b_from")) & (F.col("on_map_end") == F.col("b_to")))
    moved = F.coalesce(moved, F.lit(False))
    start = F.when(inherits & moved, F.lit(None)).when(inherits, F.col("b_start")).otherwise(F.col("measured_start"))
    end = F.when(inherits & moved, F.lit(None)).when(inherits, F.col("b_end")).otherwise(F.col("measured_end"))
    same_weekday = F.date_sub(measured, F.pmod(F.weekday(measured) - F.weekday("on_map_end"), F.lit(7)))
    return (
        newest.join(before, ["plan_id", "plan_version_id", *keys], "left")
        .withColumn("new_start", start).withColumn("measured_end", F.coalesce(end, same_weekday))
        .withColumn("measured_start", F.coalesce("new_start", F.date_sub("measured_end", F.datediff("on_map_end", "on_map_start"))))
        .select("plan_id", "plan_version_id", *keys, "on_map_start", "on_map_end", "measured_start", "measured_end")
    )


def measurement_window_projects(t, last_measured: dt.date) -> DataFrame:
    return measurement_window(t.plan_project, latest_version(t.plan_version), last_measured, ["project_id"])


def measurement_window_episodes(t, last_measured: dt.date) -> DataFrame:
    return measurement_window(t.plan_project_episode, latest_version(t.plan_version), last_measured, ["project_id", "episode_id"])


def backfill_campaign_ids(rows: DataFrame, versions: DataFrame, keys: list[str]) -> DataFrame:
    """Rows not optimised and without a goal take the largest campaign and goal known for the project in the plan.

    The known ids are aggregated first, so a plan with many versions shuffles one row per project.
    """
    known = rows.groupBy("plan_id", *keys).agg(
        F.max(F.coalesce("campaign_id", F.lit(0))).alias("known_campaign"), F.max(F.coalesce("campaign_goal_id", F.lit(0))).alias("known_goal"))
    newest = versions.withColumn("is_newest", F.lit(True))
    open_row = F.coalesce("is_newest", F.lit(False)) & (F.col("optimize_yn") == "N") & F.col("campaign_goal_id").isNull()
    return (
        rows.join(newest, ["plan_id", "plan_version_id"], "left").join(known, ["plan_id", *keys])
        .withColumn("fill", open_row)
        .withColumns({
            "campaign_id": F.when(F.col("fill"), F.col("known_campaign")).otherwise(F.col("campaign_id")),
            "campaign_goal_id": F.when(F.col("fill"), F.col("known_goal")).otherwise(F.col("campaign_goal_id")),
        }).select(*rows.columns)
    )


def backfill_projects(t) -> DataFrame:
    return backfill_campaign_ids(t.plan_project, latest_version(t.plan_version), ["project_id"])


def backfill_episodes(t) -> DataFrame:
    return backfill_campaign_ids(t.plan_project_episode, latest_version(t.plan_version), ["project_id", "episode_id"])


def mark_in_progress(t) -> DataFrame:
    """Project table with status 'in progress' on newest-version projects that have anything to optimise."""
    newest, keys = latest_version(t.plan_version), ["plan_id", "plan_version_id", "project_id"]
    wanted = (
        t.plan_project.where(F.col("optimize_yn") == "Y").select(*keys)
        .unionByName(t.plan_project_episode.where(F.col("optimize_yn") == "Y").select(*keys)).distinct()
        .join(newest, ["plan_id", "plan_version_id"], "left_semi").withColumn("busy", F.lit(True))
    )
    return t.plan_project.join(wanted, keys, "left").withColumn(
        "status_cd", F.when(F.col("busy"), F.lit(IN_PROGRESS_STATUS)).otherwise(F.col("status_cd"))).select(*t.plan_project.columns)


def expand_model_params(t, as_of: dt.datetime, forced: dict[int, int] | None = None) -> DataFrame:
    """Parameters of every new run: fixed ones by optimisation type, then the outlet's defaults.

    ``forced`` is the client variant: default parameters that take another value on optimising runs.
    """
    forced = forced or {}
    runs = new_exec_requests(t, as_of).select("model_exec_id", "media_outlet_id", "optimization_type")
    optimising = F.coalesce("optimization_type", F.lit(0)) == OPTIMISE_TYPE

    def fixed(params: dict[int, int]):
        return F.array(*[F.struct(F.lit(k).alias("param_id"), F.lit(v).alias("param_value")) for k, v in params.items()])

    given = runs.select("model_exec_id", F.inline(F.when(optimising, fixed(OPTIMISE_PARAMS)).otherwise(fixed(DISTRIBUTE_PARAMS))))
    defaults = t.model_param.where(F.col("model_type_id") == PARAM_MODEL_TYPE).select("media_outlet_id", "param_id", "param_value")
    value = F.col("param_value")
    for param, v in forced.items():
        value = F.when(optimising & (F.col("param_id") == param), F.lit(v)).otherwise(value)
    taken = F.when(optimising, F.col("param_id").isin(*OPTIMISE_PARAMS)).otherwise(F.col("param_id").isin(*DISTRIBUTE_PARAMS))
    inherited = runs.join(defaults, "media_outlet_id").where(~taken).select("model_exec_id", "param_id", value.alias("param_value"))
    return given.unionByName(inherited)


def with_windows(rows: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the measurement dates of ``windows`` where it has the row."""
    key = ["plan_id", "plan_version_id", *keys]
    dates = windows.select(*key, F.col("measured_start").alias("w_start"), F.col("measured_end").alias("w_end"), F.lit(True).alias("measured"))
    return rows.join(dates, key, "left").withColumns({
        "measured_start": F.when(F.col("measured"), F.col("w_start")).otherwise(F.col("measured_start")),
        "measured_end": F.when(F.col("measured"), F.col("w_end")).otherwise(F.col("measured_end")),
    }).select(*rows.columns)


def prepare_requests(t, as_of: dt.datetime, last_measured: dt.date | None = None, forced: dict[int, int] | None = None) -> dict[str, DataFrame]:
    """Every table a round of optimisation requests changes, as its new snapshot, and the rows to append.

    Without ``last_measured`` the client variant sets no measurement dates.
    """
    projects, episodes = t.plan_project, t.plan_project_episode
    if last_measured is not None:
        projects = with_windows(projects, measurement_window_projects(t, last_measured), ["project_id"])
        episodes = with_windows(episodes, measurement_window_episodes(t, last_measured), ["project_id", "episode_id"])
    newest = latest_version(t.plan_version)
    projects = backfill_campaign_ids(projects, newest, ["project_id"])
    episodes = backfill_campaign_ids(episodes, newest, ["project_id", "episode_id"])
    return {
        "new_runs": new_exec_requests(t, as_of),
        "run_params": expand_model_params(t, as_of, forced),
        "plan_version": linked_versions(t, as_of),
        "plan": submitted_plans(t, as_of),
        "plan_project": mark_in_progress(t.replace(plan_project=projects, plan_project_episode=episodes)),
        "plan_project_episode": episodes,
    }
