"""Spread a project's units over the weeks of its flight."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotgrid.functions.columns import greatest_known, week_label
from spotgrid.functions.joins import day_map

# Modes whose spots are already weekly, and modes that repeat the full count each week.
PLANNED_MODES = ("S", "ES")
EVERY_WEEK_MODES = ("ER", "EG")


def week_overlap(results: DataFrame, cal: DataFrame) -> DataFrame:
    """Weeks each flight touches with its days in the week and its days in total.

    A flight unfolds into one day per seven plus its last day, which meets every week once;
    the week lookup is then an equi join on the day.
    """
    first = greatest_known("flight_start", "qtr_start")
    weeks = day_map(cal, "W").select("day", F.col("period_start").alias("week_date"), F.col("period_end").alias("week_end"))
    touched = (
        results.where(~F.col("calc_based_on").isin(*PLANNED_MODES)).where(first <= F.col("flight_end"))
        .withColumn("day", F.explode(F.array_union(F.sequence(first, F.col("flight_end"), F.expr("INTERVAL 7 DAYS")), F.array("flight_end"))))
        .join(weeks, "day").drop("day").dropDuplicates(["call_id", "project_id", "week_date"])
    )
    lead_in = F.greatest(F.datediff("flight_start", "week_date"), F.lit(0))
    tail = F.greatest(F.datediff("week_end", "flight_end"), F.lit(0))
    return touched.select(
        "call_id", "project_id", "calc_based_on", "qtr_start", "spot_result", "week_date",
        (7 - lead_in - tail).alias("days_in_week"), (F.datediff(F.col("flight_end"), first) + 1).alias("total_days"))


def distribute_proportional(overlap: DataFrame) -> DataFrame:
    """Each week's share by days, rounded down; per-week modes keep the full count."""
    share = F.floor(F.coalesce("spot_result", F.lit(0)) * F.col("days_in_week") / F.col("total_days"))
    return overlap.select(
        "call_id", "project_id", "week_date", "qtr_start",
        F.when(F.col("calc_based_on").isin(*EVERY_WEEK_MODES), F.col("spot_result")).otherwise(F.greatest(share, F.lit(0))).cast("bigint").alias("unit_count"))


def distribute_carry(overlap: DataFrame) -> DataFrame:
    """Like the proportional split, but units and days left shrink week by week, so the last week takes the rest.

    One row per flight holds its weeks in order (a flight has a few dozen at most) and a fold runs over them.
    """
    flights = overlap.groupBy("call_id", "project_id", "calc_based_on", "qtr_start", "spot_result", "total_days").agg(
        F.sort_array(F.collect_list(F.struct("week_date", "days_in_week"))).alias("weeks"))
    start = F.struct(F.col("spot_result").alias("units"), F.col("total_days").alias("days"),
                     F.array().cast("array<struct<week_date:date,unit_count:bigint>>").alias("out"))

    def take(state, week):
        share = F.floor(state["units"] * week["days_in_week"] / F.nullif(state["days"], F.lit(0))).cast("bigint")
        given = F.when(share < 0, F.lit(0).cast("bigint")).otherwise(share)
        return F.struct(
            (state["units"] - share).alias("units"), (state["days"] - week["days_in_week"]).alias("days"),
            F.array_append(state["out"], F.struct(week["week_date"].alias("week_date"), given.alias("unit_count"))).alias("out"))

    carried = F.aggregate("weeks", start, take)["out"]
    repeated = F.transform("weeks", lambda w: F.struct(w["week_date"].alias("week_date"), F.col("spot_result").alias("unit_count")))
    split = F.when(F.col("calc_based_on").isin(*EVERY_WEEK_MODES), repeated).otherwise(carried)
    return flights.select("call_id", "project_id", "qtr_start", F.explode(split).alias("w")).select(
        "call_id", "project_id", "w.week_date", "qtr_start", "w.unit_count")


def week_labels(distribution: DataFrame) -> DataFrame:
    return distribution.select(
        "call_id", "project_id", F.date_format("week_date", "MM/dd").alias("week_date"),
        week_label(F.col("qtr_start"), F.col("week_date")).alias("week_name"), "unit_count")
