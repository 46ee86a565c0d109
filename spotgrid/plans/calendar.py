"""Calendar building blocks: periods, map weeks, neighbouring quarters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Quarters on one map, and the reach of the quarter list.
MAP_QUARTERS = 2
QUARTER_LIST_BACK_DAYS = 95
QUARTER_LIST_AHEAD = 4


def periods(cal: DataFrame, period_type: str) -> DataFrame:
    return cal.where(F.col("period_type") == period_type)


def quarter_weeks(cal: DataFrame, n_quarters: int = MAP_QUARTERS) -> DataFrame:
    """Weeks shown on the map of every quarter: all its own and the following quarters' weeks.

    A quarter hands its weeks to its own map and to the maps of the quarters before it.
    """
    quarters = periods(cal, "Q").select("period_id", F.col("name").alias("fiscal_qtr"))
    shown = quarters.select(
        "fiscal_qtr", F.explode(F.array(*[F.col("period_id") - i for i in range(n_quarters)])).alias("period_id")
    ).join(quarters.select("period_id"), "period_id", "left_semi")
    weeks = periods(cal, "W").select(
        "fiscal_qtr", F.col("start_date").alias("week_start"), F.col("end_date").alias("week_end")
    )
    by_map = Window.partitionBy("period_id").orderBy("week_end")
    numbered = shown.join(weeks, "fiscal_qtr").withColumn("week_no", F.row_number().over(by_map))
    return numbered.select("period_id", "fiscal_qtr", "week_no", "week_start", "week_end")


def week_number(weeks: DataFrame) -> DataFrame:
    """Labels of the map weeks, as the launch grid and the episode grid name them."""
    return weeks.withColumns({
        "week_label": F.concat(F.lit("WEEK"), F.col("week_no")),
        "episode_week_label": F.concat(F.lit("EP_Wek"), F.col("week_no")),
    })


def map_days(cal: DataFrame, n_quarters: int = MAP_QUARTERS) -> DataFrame:
    """One row per (map quarter, day) with the week that holds the day."""
    return quarter_weeks(cal, n_quarters).select(
        "period_id", "week_start", F.explode(F.sequence("week_start", "week_end")).alias("day")
    )


def ids_are_dense(cal: DataFrame) -> Column:
    """True, as a condition for jobs that step from quarter to quarter by id; where ids have a hole the job fails and names what is missing."""
    missing = F.array_except(F.sequence(F.min("period_id"), F.max("period_id")), F.collect_set("period_id"))
    fault = F.raise_error(F.concat(F.lit("no quarter with id "), F.array_join(missing, ", "))).cast("boolean")
    return periods(cal, "Q").agg(F.when(F.size(missing) > 0, fault).otherwise(F.lit(True)).alias("dense")).scalar()


def adjacent_quarter(cal: DataFrame, step: int) -> DataFrame:
    """Quarter pairs by id: ``period_id`` and the quarter ``step`` places on. Ids must be dense."""
    q = periods(cal, "Q").where(ids_are_dense(cal))
    other = q.select(
        (F.col("period_id") - step).alias("period_id"), F.col("period_id").alias("other_period_id"),
        F.col("name").alias("other_name"), F.col("start_date").alias("other_start"), F.col("end_date").alias("other_end"),
    )
    return q.select("period_id", "name").join(other, "period_id")


def next_quarter_by_date(cal: DataFrame) -> DataFrame:
    """Quarter pairs by date: the next quarter starts the day after this one ends."""
    q = periods(cal, "Q")
    nxt = q.select(F.date_sub("start_date", 1).alias("end_date"), F.col("period_id").alias("next_period_id"),
                   F.col("end_date").alias("map_end"))
    return q.select("period_id", "name", "end_date").join(nxt, "end_date").select("period_id", "name", "next_period_id", "map_end")


def quarter_window(cal: DataFrame, as_of: dt.date, back_days: int = QUARTER_LIST_BACK_DAYS,
                   ahead: int = QUARTER_LIST_AHEAD) -> DataFrame:
    """Quarters from the one that held ``as_of - back_days`` to ``ahead`` quarters after the current one."""
    q = periods(cal, "Q")
    lo, today = F.lit(as_of - dt.timedelta(days=back_days)), F.lit(as_of)
    all_q = Window.partitionBy("period_type")  # quarters only: a few hundred rows at most

    def holding(day, col):
        return F.max(F.when(day.between(F.col("start_date"), F.col("end_date")), F.col(col))).over(all_q)

    bounded = q.withColumn("_lo", holding(lo, "start_date")).withColumn("_cur", holding(today, "period_id"))
    bounded = bounded.withColumn("_hi", F.max(F.when(F.col("period_id") == F.col("_cur") + ahead, F.col("end_date"))).over(all_q))
    return bounded.where((F.col("start_date") >= F.col("_lo")) & (F.col("end_date") <= F.col("_hi"))).select(*q.columns)
