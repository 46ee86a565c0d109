"""Capacity, use and next-quarter commitments by week, day and daypart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotgrid.functions.columns import UNITS, measure
from spotgrid.functions.joins import day_map
from spotgrid.plans.calendar import map_days, quarter_weeks
from spotgrid.plans.context import default_demo, future_plan

PRIMARY_PLAN_TYPE = 1


def spot_sums(facts: DataFrame, output_type: int, *keys: str) -> DataFrame:
    return facts.groupBy(*keys).agg(F.sum(measure(output_type)).alias("units"))


def both_phases(t, *cols: str) -> DataFrame:
    """Launch and episode spots in one frame."""
    return t.schedule.select(*cols).unionByName(t.schedule_episode.select(*cols))


def capacity_rows(t, output_type: int) -> DataFrame:
    """Capacity per outlet, plan type, day and daypart: spots, or the default audience's rating points."""
    cap = t.capacity.select("capacity_id", "plan_type", "media_outlet_id", "daypart_id", "start_date", "capacity_per_hour")
    if output_type == UNITS:
        return cap.withColumnRenamed("capacity_per_hour", "capacity").drop("capacity_id")
    rated = cap.drop("capacity_per_hour").join(default_demo(t.outlet_demo), "media_outlet_id")
    return (
        rated.join(t.capacity_grp.withColumnRenamed("grp_capacity", "capacity"), ["capacity_id", "demo_id"])
        .drop("capacity_id", "demo_id")
    )


def plan_weeks(plan: DataFrame, cal: DataFrame) -> DataFrame:
    return plan.select("plan_id", "media_outlet_id", "plan_type", "period_id").join(
        quarter_weeks(cal).drop("fiscal_qtr"), "period_id"
    )


def by_week(df: DataFrame, cal: DataFrame, values: list[str], *keys: str) -> DataFrame:
    """Sum a dated frame by calendar week.

    The day lookup is bounded by the calendar and is joined first, so the facts shuffle once, as week sums.
    """
    days = day_map(cal, "W").select(F.col("day").alias("start_date"), F.col("period_start").alias("week_start"))
    return df.join(days, "start_date").groupBy(*keys, "week_start").agg(*[F.sum(v).alias(v) for v in values])


def quarterly_capacity(t, output_type: int = UNITS) -> DataFrame:
    """Capacity of every week on the map of every primary plan; weeks without capacity stay, empty."""
    cap = capacity_rows(t, output_type).where(F.col("plan_type") == PRIMARY_PLAN_TYPE)
    weekly = by_week(cap, t.cal_period, ["capacity"], "media_outlet_id")
    grid = plan_weeks(t.plan.where(F.col("plan_type") == PRIMARY_PLAN_TYPE), t.cal_period)
    return grid.join(weekly, ["media_outlet_id", "week_start"], "left").select(
        "plan_id", "week_no", "week_start", "capacity"
    )


def weekly_use(t, output_type: int = UNITS, quarters_ahead: int = 0) -> DataFrame:
    """Launch and episode spots per map week, of the plan itself (0) or of the next quarter's plan (1), zero-filled."""
    facts = both_phases(t, "plan_id", "start_date", "planned_units", "planned_grp").withColumn("units", measure(output_type))
    weekly = by_week(facts, t.cal_period, ["units"], "plan_id").withColumnRenamed("plan_id", "source_plan_id")
    grid = plan_weeks(t.plan, t.cal_period)
    if quarters_ahead:
        source = future_plan(t.plan, t.cal_period).withColumnRenamed("future_plan_id", "source_plan_id")
        grid = grid.join(source, "plan_id", "left")
    else:
        grid = grid.withColumn("source_plan_id", F.col("plan_id"))
    zero = F.lit(0).cast(weekly.schema["units"].dataType)
    return grid.join(weekly, ["source_plan_id", "week_start"], "left").select(
        "plan_id", "week_no", "week_start", F.coalesce("units", zero).alias("units")
    )


def quarterly_future_units(t, output_type: int = UNITS) -> DataFrame:
    return weekly_use(t, output_type, quarters_ahead=1)


def inventory_capacity(t, output_type: int = UNITS) -> DataFrame:
    return quarterly_capacity(t, output_type)


def primary_plans(t):
    return t.replace(plan=t.plan.where(F.col("plan_type") == PRIMARY_PLAN_TYPE))


def utilized_inventory(t, output_type: int = UNITS) -> DataFrame:
    return weekly_use(primary_plans(t), output_type, quarters_ahead=0)


def future_quarter_spots(t, output_type: int = UNITS) -> DataFrame:
    return weekly_use(primary_plans(t), output_type, quarters_ahead=1)


def plan_days(plan: DataFrame, cal: DataFrame) -> DataFrame:
    return plan.select("plan_id", "media_outlet_id", "plan_type", "period_id").join(
        map_days(cal).select("period_id", "day"), "period_id"
    )


def weekly_day_capacity(t, output_type: int = UNITS) -> DataFrame:
    """Capacity of every day on the map, from the table of the plan's own type."""
    daily = (
        capacity_rows(t, output_type).groupBy("media_outlet_id", "plan_type", F.col("start_date").alias("day"))
        .agg(F.sum("capacity").alias("capacity"))
    )
    return plan_days(t.plan, t.cal_period).join(daily, ["media_outlet_id", "plan_type", "day"]).select("plan_id", "day", "capacity")


def _future_days(t, facts: DataFrame, output_type: int) -> DataFrame:
    daily = spot_sums(facts, output_type, "plan_id", "start_date").select(
        F.col("plan_id").alias("future_plan_id"), F.col("start_date").alias("day"), "units"
    )
    zero = F.lit(0).cast(daily.schema["units"].dataType)
    grid = plan_days(t.plan, t.cal_period).join(future_plan(t.plan, t.cal_period), "plan_id", "left")
    return grid.join(daily, ["future_plan_id", "day"], "left").select("plan_id", "day", F.coalesce("units", zero).alias("units"))


def weekly_future_units(t, output_type: int = UNITS) -> DataFrame:
    """Next-quarter plan's spots per map day, launch and episodes as separate rows."""
    return (
        _future_days(t, t.schedule, output_type).withColumn("phase", F.lit("launch"))
        .unionByName(_future_days(t, t.schedule_episode, output_type).withColumn("phase", F.lit("episode")))
    )


def weekly_episode_future_units(t, output_type: int = UNITS) -> DataFrame:
    return _future_days(t, t.schedule_episode, output_type)


def active_dayparts(t) -> DataFrame:
    return t.daypart.where(F.col("active_yn") == "Y").select("daypart_id", F.col("name").alias("daypart"))


def daily_daypart_capacity(t, output_type: int = UNITS) -> DataFrame:
    """Distinct capacity entries per map day and active daypart."""
    cap = capacity_rows(t, output_type).withColumnRenamed("start_date", "day").distinct()
    return (
        plan_days(t.plan, t.cal_period).join(cap, ["media_outlet_id", "plan_type", "day"])
        .join(active_dayparts(t), "daypart_id").select("plan_id", "day", "daypart_id", "daypart", "capacity")
    )


def _future_dayparts(t, facts: DataFrame, output_type: int) -> DataFrame:
    sums = spot_sums(facts, output_type, "plan_id", "start_date", "daypart_id").withColumnRenamed("plan_id", "future_plan_id")
    return sums.join(future_plan(t.plan, t.cal_period), "future_plan_id").join(active_dayparts(t), "daypart_id").select(
        "plan_id", F.col("start_date").alias("day"), "daypart_id", "daypart", "units"
    )


def daily_future_by_daypart(t, output_type: int = UNITS) -> DataFrame:
    facts = both_phases(t, "plan_id", "start_date", "daypart_id", "planned_units", "planned_grp")
    return _future_dayparts(t, facts, output_type)


def daily_episode_future(t, output_type: int = UNITS) -> DataFrame:
    return _future_dayparts(t, t.schedule_episode, output_type)


def cumulative_delivery(t, as_of: dt.date, output_type: int = UNITS) -> DataFrame:
    """Spots or points aired up to a date, per plan and project, launch and episodes apart."""
    def to_date(facts: DataFrame, phase: str) -> DataFrame:
        aired = facts.where(F.col("start_date") <= F.lit(as_of))
        return spot_sums(aired, output_type, "plan_id", "project_id").withColumn("phase", F.lit(phase))

    return to_date(t.schedule, "launch").unionByName(to_date(t.schedule_episode, "episode"))
