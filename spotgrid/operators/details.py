"""Headers, run reports and episode set-up rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotgrid.functions.columns import clock12, offset_to_time, time_to_offset
from spotgrid.operators.grids import completed_or_first_version
from spotgrid.plans.calendar import periods
from spotgrid.plans.context import latest_version

# Run kinds, constraint kind, log status and their labels.
LOG_MODEL_TYPES = (2, 4)
TIMEBAND_CONSTRAINT = 4
RETIMING_STATUS = 15
BLACKOUT = "blackout"
DAY = 86400


def plan_header(t) -> DataFrame:
    """Plan, status, editors and newest lock of every outlet, quarter and type.

    Plans from before maps were checked (``checked_yn`` is N) show no values.
    """
    lock = t.plan_lock.groupBy("plan_id").agg(F.max(F.struct("lock_id", "flag", "lock_user", "lock_ts")).alias("lock"))
    editor = t.sec_user.select(F.col("user_id").alias("update_user"), "first_name", "last_name")
    locker = t.sec_user.select(F.col("user_id").alias("locked_by_id"),
                               F.concat("first_name", F.lit(" "), "last_name").alias("locked_by"))
    quarter = periods(t.cal_period, "Q").select("period_id", F.col("name").alias("qtr_name"))
    status = t.plan_status.select("plan_status_id", F.col("name").alias("plan_status"))
    rows = (
        t.plan.join(quarter, "period_id").join(status, "plan_status_id").join(lock, "plan_id", "left")
        .withColumn("locked_by_id", F.when(F.col("lock.flag") == "Y", F.col("lock.lock_user")))
        .join(editor, "update_user", "left").join(locker, "locked_by_id", "left")
    )
    shown = {
        "plan_id": F.col("plan_id"), "plan_name": F.col("name"), "period_id": F.col("period_id"), "plan_status_id": F.col("plan_status_id"),
        "plan_status": F.col("plan_status"), "create_ts": F.col("create_ts"), "update_ts": F.col("update_ts"), "update_user": F.col("update_user"),
        "first_name": F.coalesce("first_name", F.lit("0")), "last_name": F.coalesce("last_name", F.lit("0")), "status_comment": F.col("comments"),
        "locked_ts": F.when(F.col("lock.flag") == "Y", F.col("lock.lock_ts")), "locked_by": F.col("locked_by"), "locked_by_id": F.col("locked_by_id"),
    }
    current = F.col("checked_yn") == "Y"
    return rows.select("media_outlet_id", "qtr_name", "plan_type", *[F.when(current, c).alias(n) for n, c in shown.items()])


def episode_rules_json(t) -> DataFrame:
    """Episode rules of the version last run, 0 if none ran."""
    return t.episode_json.join(
        completed_or_first_version(t).select("plan_id", "plan_version_id"), ["plan_id", "plan_version_id"], "left_semi"
    ).select("plan_id", "project_id", "episode_dtl_json")


def saved_episode_rules_json(t) -> DataFrame:
    """Episode rules of the newest saved version, for projects that have episodes."""
    keys = ["plan_id", "plan_version_id", "project_id"]
    return (
        t.episode_json.join(latest_version(t.plan_version), ["plan_id", "plan_version_id"], "left_semi")
        .join(t.plan_project_episode.select(*keys), keys, "left_semi")
        .select("plan_id", "project_id", "episode_dtl_json").distinct()
    )


def multi_net_flag(t) -> DataFrame:
    """Classify every project of a JSON id list as planned on several networks or on one."""
    listed = t.project_list.select(
        "request_id", "media_outlet_id", F.explode(F.from_json("project_ids_json", "array<bigint>")).alias("project_id"))
    geo = t.geo_project.where(F.col("active_yn") == "Y").select("project_id", "media_outlet_id", "geo_plan_name", F.lit(True).alias("hit"))
    return listed.join(geo, ["project_id", "media_outlet_id"], "left").select(
        "request_id", "project_id", F.when(F.col("hit"), F.lit("multi")).otherwise(F.lit("single")).alias("planned_on"), "geo_plan_name"
    ).distinct()


def episode_details(t) -> DataFrame:
    return t.episode_detail.join(t.episode_edit, ["project_id", "episode_id"]).select(
        "project_id", "episode_id", "broadcast_date", clock12(F.col("air_offset")).alias("start_time"),
        clock12(F.col("air_offset") + F.col("duration")).alias("end_time"), "dow", "pl_start", "pl_end",
        (F.datediff("pl_end", "pl_start") + 1).alias("planning_days"), F.coalesce("tgt_spot", F.lit(0)).alias("tgt_spot"), "tgt_grp",
        "is_episode_changed_db", "is_episode_att_edited", "status")


def episode_timebands(t) -> DataFrame:
    constraint = t.episode_constraint.where(F.col("constraint_type_id") == TIMEBAND_CONSTRAINT).select(
        "project_id", "episode_id", "constraint_type_id", F.col("constraint_key").alias("constraint_id"))
    return constraint.join(t.episode_timeband, ["constraint_type_id", "constraint_id"]).select(
        "project_id", "episode_id", "constraint_id", offset_to_time(F.col("start_offset")).alias("start_time"),
        offset_to_time(F.col("end_offset")).alias("end_time"), "days_mask")


def episode_timeband_days(t) -> DataFrame:
    """Time bands by weekday (1 is Monday, the mask's lowest bit), in seconds of that day.

    Offsets pass 24 hours on the broadcast clock; such a band is cut at midnight and goes on on the next weekday.
    """
    constraint = t.episode_constraint.where(F.col("constraint_type_id") == TIMEBAND_CONSTRAINT).select(
        "project_id", "episode_id", "constraint_type_id", F.col("constraint_key").alias("constraint_id"))
    first, last = F.floor(F.col("start_offset") / DAY), F.floor((F.col("end_offset") - 1) / DAY)
    chosen = F.col("days_mask").bitwiseAND(F.expr("shiftleft(1, band_weekday - 1)").cast("int")) > 0
    days = (
        t.episode_timeband.where(F.col("end_offset") > F.col("start_offset"))
        .withColumn("band_weekday", F.explode(F.sequence(F.lit(1), F.lit(7)))).where(chosen)
        .withColumn("later", F.explode(F.sequence(first, last)))
    )
    start = F.greatest(F.col("start_offset") - F.col("later") * DAY, F.lit(0)).cast("int")
    end = F.least(F.col("end_offset") - F.col("later") * DAY, F.lit(DAY)).cast("int")
    bands = days.select("constraint_type_id", "constraint_id", "band_weekday", ((F.col("band_weekday") - 1 + F.col("later")) % 7 + 1).cast("int").alias("weekday"),
                        start.alias("start_second"), end.alias("end_second"))
    return constraint.join(bands, ["constraint_type_id", "constraint_id"]).select(
        "project_id", "episode_id", "constraint_id", "band_weekday", "weekday", "start_second", "end_second",
        offset_to_time(F.col("start_second")).alias("start_time"), offset_to_time(F.col("end_second")).alias("end_time"))


def episode_header(t) -> DataFrame:
    """Episode set-up of the projects that are still set up."""
    return t.episode_header.where(F.col("active_yn") == "Y").select(
        "project_id", "episode_start_date", "episode_end_date", clock12(F.col("start_offset")).alias("episode_start_time"),
        clock12(F.col("end_offset")).alias("episode_end_time"), "tgt_spots", "tgt_grp", "dow_mask")


def blackouts(t) -> DataFrame:
    """Date ranges in which a project must not air."""
    return t.blackout.where(F.col("kind") == BLACKOUT).select("project_id", "start_date", "end_date")


def recurring_exclusions(t) -> DataFrame:
    """Weekly hours in which a project must not air, as clock times."""
    return t.recurring_exclusion.where(F.col("active_yn") == "Y").select(
        "project_id", offset_to_time(F.col("start_offset")).alias("start_time"), offset_to_time(F.col("end_offset")).alias("end_time"), "days_mask")


def clock_offsets(t) -> DataFrame:
    """Goal windows as seconds since midnight, and back as clock text."""
    start, end = time_to_offset(F.col("start_time")), time_to_offset(F.col("end_time"))
    return t.campaign_goal.select(
        "campaign_goal_id", start.alias("start_offset"), end.alias("end_offset"), offset_to_time(start + end).alias("sum_time"))


def exec_report(t) -> DataFrame:
    """Who asked for which run: plan runs and log runs in one shape."""
    who = t.sec_user.select("user_id", F.col("user_name").alias("email"), F.concat("first_name", F.lit(" "), "last_name").alias("name"))
    network = t.media_outlet.select("media_outlet_id", F.col("short_name").alias("network_code"))
    runs = t.model_exec.select("model_exec_id", "plan_id", "plan_version_id", "model_type_id", F.col("exec_status_cd").alias("exec_status"),
                               "opt_process_key", "user_id")
    is_log = F.col("model_type_id").isin(*LOG_MODEL_TYPES)
    log = t.log_version.join(t.log, "log_id").select(
        F.col("log_version_id").alias("plan_version_id"), "media_outlet_id", "broadcast_date",
        F.when(F.col("status") == RETIMING_STATUS, F.lit("Re-Timing")).otherwise(F.lit("Optimization")).alias("plan_type"),
        F.col("sub_log_version_id").cast("string").alias("version_no"))
    quarter = periods(t.cal_period, "Q").select("period_id", F.col("fiscal_qtr").alias("quarter"))
    plan = t.plan.join(quarter, "period_id").select("plan_id", "media_outlet_id", F.col("name").alias("plan_name"), "quarter")
    kind = t.plan_version.select("plan_id", "plan_version_id", F.when(F.coalesce("optimization_type", F.lit(0)) == 0, F.lit("Optimize"))
                                 .otherwise(F.lit("Distribute")).alias("plan_type"))
    log_runs = runs.where(is_log).drop("plan_id").join(log, "plan_version_id")
    plan_runs = runs.where(~is_log).join(plan, "plan_id").join(kind, ["plan_id", "plan_version_id"]).drop("plan_id")
    return log_runs.unionByName(plan_runs, allowMissingColumns=True).join(who, "user_id").join(network, "media_outlet_id").select(
        "model_exec_id", "media_outlet_id", "network_code", "broadcast_date", "email", "name", "plan_name", "quarter", "plan_type",
        "model_type_id", "exec_status", "version_no", "opt_process_key")


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("table_name"), "cnt") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
