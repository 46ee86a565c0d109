"""Weekly cap checks: does a project or episode ask for more spots than its flight can air?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotgrid.functions.columns import monday_of

# Broadcast day edges in seconds, and the phase whose episode counts do not matter.
DAY_START, DAY_END, DAY, HOUR = 21600, 108000, 86400, 3600
LAUNCH_ONLY_PHASE = 1


def hourly_spots(t) -> DataFrame:
    return t.spots_per_hour.groupBy("media_outlet_id").agg(
        F.round(F.sum("spots"), 0).cast("decimal(18,0)").alias("daily_spots"), F.min("spots").alias("per_hour_spots"))


def weekly_cap() -> Column:
    """Spots a week can hold between the flight's edges, on the 30-hour broadcast clock."""
    week, start, end = F.col("week_date"), F.col("on_map_start"), F.col("on_map_end")
    opens, closes = F.col("start_offset"), F.col("end_offset")
    per_hour, daily = F.col("per_hour_spots"), F.col("daily_spots")
    length = F.datediff(end, start)
    week_end = F.date_add(week, 6)
    starts_here, ends_soon = week <= start, F.date_add(week, 1) >= end
    first_day, last_day = (DAY - opens) / HOUR * per_hour, closes / HOUR * per_hour
    edges = ((DAY - opens) + closes) / HOUR * per_hour
    cap = (
        F.when(starts_here & ends_soon,
               F.when(length == 0, (closes - opens) / HOUR * per_hour).when(length == 1, edges).otherwise(edges + (length + 1) * daily))
        .when(starts_here & (week_end >= end), edges + (length - 1) * daily)
        .when(starts_here & (week_end < end),
              F.when(length == 1, first_day).otherwise(first_day + F.datediff(week_end, start) * daily))
        .when((week > start) & (week_end < end), 7 * daily)
        .when((week > start) & (week_end >= end), F.when(length == 1, last_day).otherwise(last_day + F.datediff(end, week) * daily))
    )
    return cap.cast("decimal(18,2)")


def edge(day: Column, flight_day: Column, offset: Column, default: int) -> Column:
    return F.when(day == flight_day, offset).otherwise(F.lit(default))


def week_list(rows: DataFrame, *keys: str) -> DataFrame:
    """Weeks per project as one comma list; a flight has a few dozen weeks at most."""
    return rows.groupBy(*keys).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("week_date")), lambda d: d.cast("string")), ",").alias("weeks"))


def project_name(t) -> DataFrame:
    outlet = t.media_outlet.select("media_outlet_id", "short_name")
    return t.project.join(outlet, "media_outlet_id").select(
        "project_id", F.concat("name", F.lit(" ("), "short_name", F.lit(")")).alias("project_name"), F.col("start_date").alias("p_start"), "start_offset",
        F.col("end_date").alias("p_end"), "end_offset")


def project_week_caps(t) -> DataFrame:
    """Cap and count of every optimised project and week of every plan version."""
    keys = ["plan_id", "plan_version_id", "project_id"]
    flights = t.plan_project.where(F.col("optimize_yn") == "Y").select(*keys, "on_map_start", "on_map_end")
    outlet = t.plan.select("plan_id", "media_outlet_id").join(hourly_spots(t), "media_outlet_id").drop("media_outlet_id")
    return (
        t.plan_project_spots.join(t.plan_version.select("plan_id", "plan_version_id"), ["plan_id", "plan_version_id"], "left_semi")
        .join(flights, keys).where(F.col("week_date").between(monday_of(F.col("on_map_start")), F.col("on_map_end")))
        .join(outlet, "plan_id").join(project_name(t), "project_id")
        .withColumn("start_offset", edge(F.col("p_start"), F.col("on_map_start"), F.col("start_offset"), DAY_START))
        .withColumn("end_offset", edge(F.col("p_end"), F.col("on_map_end"), F.col("end_offset"), DAY_END))
        .withColumn("weekly_cap", weekly_cap())
        .select(*keys, "project_name", "week_date", "unit_count", "weekly_cap", F.coalesce(F.col("weekly_cap") < F.col("unit_count"), F.lit(False)).alias("violates"))
    )


def daily_cap_check(t, only_violations: bool = False) -> DataFrame:
    """Checked weeks of each project. All weeks are listed unless ``only_violations`` is set."""
    rows = project_week_caps(t)
    if only_violations:
        rows = rows.where("violates")
    return week_list(rows, "plan_id", "plan_version_id", "project_id", "project_name")


def episode_week_caps(t) -> DataFrame:
    """Cap and count of every optimised episode and week; launch-only projects have no count."""
    keys = ["plan_id", "plan_version_id", "project_id"]
    flights = t.plan_project_episode.where(F.col("optimize_yn") == "Y").select(*keys, "episode_id", "on_map_start", "on_map_end")
    detail = t.episode_detail.select("project_id", "episode_id", "pl_start", "pl_start_offset", "pl_end", "pl_end_offset")
    outlet = t.plan.select("plan_id", "media_outlet_id").join(hourly_spots(t), "media_outlet_id").drop("media_outlet_id")
    names = project_name(t).select("project_id", "project_name")
    return (
        t.plan_project_spots_episode_map.join(t.plan_version.select("plan_id", "plan_version_id"), ["plan_id", "plan_version_id"], "left_semi")
        .join(flights, [*keys, "episode_id"])
        .where(F.col("week_date").between(monday_of(F.col("on_map_start")), monday_of(F.col("on_map_end"))))
        .join(t.plan_project.select(*keys, "phase_type"), keys).join(outlet, "plan_id").join(names, "project_id")
        .join(detail, ["project_id", "episode_id"])
        .withColumn("unit_count", F.when(F.col("phase_type") != LAUNCH_ONLY_PHASE, F.col("unit_count")))
        .withColumn("start_offset", edge(F.col("pl_start"), F.col("on_map_start"), F.col("pl_start_offset"), DAY_START))
        .withColumn("end_offset", edge(F.col("pl_end"), F.col("on_map_end"), F.col("pl_end_offset"), DAY_END))
        .withColumn("weekly_cap", weekly_cap())
        .select(*keys, "episode_id", "project_name", "week_date", "unit_count", "weekly_cap", F.coalesce(F.col("weekly_cap") < F.col("unit_count"), F.lit(False)).alias("violates"))
    )


def daily_cap_check_episode(t) -> DataFrame:
    return week_list(episode_week_caps(t).where("violates"), "plan_id", "plan_version_id", "project_id", "episode_id", "project_name")
