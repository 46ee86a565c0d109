"""Daily capacity from the weekly JSON a planner uploads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotgrid.functions.columns import json_fault
from spotgrid.plans.calendar import periods, quarter_weeks

CAPACITY_JSON = "map<string,array<struct<DAY_OF_WEEK:string,DAYPART_ID:string,MEDIA_OUTLET_ID:string,CAPACITY:bigint>>>"


def explode_capacity_json(t, as_of: dt.date) -> DataFrame:
    """One row per future day and daypart named by the uploaded weeks, weekdays counted from Monday = 1."""
    weeks = quarter_weeks(t.cal_period, n_quarters=1).select("period_id", "week_no", F.col("week_start").alias("from"), F.col("week_end").alias("to"))
    days = weeks.select("period_id", "week_no", F.explode(F.sequence("from", "to")).alias("start_date"))
    days = days.where(F.col("start_date") > F.lit(as_of)).withColumn("day_of_week", F.weekday("start_date") + 1)
    quarter = periods(t.cal_period, "Q").select("period_id", F.col("name").alias("fiscal_qtr"))
    return (
        capacity_entries(t).join(days, ["period_id", "week_no", "day_of_week"]).join(quarter, "period_id")
        .select("plan_id", "media_outlet_id", "fiscal_qtr", "daypart_id", F.col("capacity").alias("capacity_per_hour"), "start_date",
                F.col("start_date").alias("end_date"), "day_of_week", F.lit("D").alias("period_type")).distinct()
    )


def capacity_json_fault() -> Column:
    """Why an upload can't be loaded, null if it can."""
    weeks = json_fault("week_keys", "ARRAY", F.lit("week that is no number"), F.forall(F.from_json("week_keys", "array<int>"), lambda w: w.isNotNull()))
    return F.coalesce(json_fault("capacity_json", "OBJECT", F.lit("no weeks"), F.from_json("capacity_json", CAPACITY_JSON).isNotNull()), F.concat(F.lit("week keys: "), weeks))


def capacity_json_rejects(t) -> DataFrame:
    """Uploads that give no capacity, and why. An upload is loaded as a whole or not at all."""
    return t.capacity_json.withColumn("reason", capacity_json_fault()).where("reason is not null").select(
        "plan_id", "media_outlet_id", "period_id", "reason", "week_keys", "capacity_json")


def capacity_entries(t) -> DataFrame:
    """Capacity entries of the named weeks that belong to the uploading outlet."""
    parsed = t.capacity_json.where(capacity_json_fault().isNull()).select(
        "plan_id", "media_outlet_id", "period_id", F.explode(F.from_json("week_keys", "array<int>")).alias("week_no"),
        F.from_json("capacity_json", CAPACITY_JSON).alias("weeks"))
    entry = parsed.select("plan_id", "media_outlet_id", "period_id", "week_no",
                          F.explode(F.try_element_at("weeks", F.col("week_no").cast("string"))).alias("e"))
    return entry.where(F.col("e.MEDIA_OUTLET_ID").try_cast("int") == F.col("media_outlet_id")).select(
        "plan_id", "media_outlet_id", "period_id", "week_no", F.col("e.DAY_OF_WEEK").try_cast("int").alias("day_of_week"),
        F.col("e.DAYPART_ID").try_cast("int").alias("daypart_id"), F.col("e.CAPACITY").alias("capacity"))
