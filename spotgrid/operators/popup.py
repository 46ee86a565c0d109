"""Project pop-up: every day and daypart of a flight, with daypart totals and day totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotgrid.functions.joins import day_map
from spotgrid.operators.grids import completed_or_first_version
from spotgrid.plans.context import LAUNCH_EPISODE

# Row kinds of the pop-up.
LAUNCH_ROW, EPISODE_ROW, DAYPART_TOTAL, DAY_TOTAL = 1, 2, 3, 4


def flights(t) -> DataFrame:
    """Launch and episode flights of every plan and project."""
    cols = ["plan_id", "project_id", "media_outlet_id", "demo_id", "start_date", "end_date",
            F.concat(F.col("end_date").cast("string"), F.lit(" "), F.col("end_time")).alias("airing_date")]
    launch = t.campaign_goal.select(*cols, F.lit(LAUNCH_EPISODE).alias("episode_id"))
    current = t.plan_project_episode.join(
        completed_or_first_version(t).select("plan_id", "plan_version_id"), ["plan_id", "plan_version_id"], "left_semi"
    ).select("plan_id", "project_id", "episode_id")
    episodes = t.campaign_goal_episode.join(current, ["plan_id", "project_id", "episode_id"], "left_semi").select(*cols, "episode_id")
    return launch.unionByName(episodes)


def project_popup_grid(t, demo_id: int | None = None) -> DataFrame:
    """Detail rows (types 1 and 2), daypart totals (3) and day totals (4).

    Spots count for ``demo_id``, or for each goal's own audience if none is asked for.
    """
    parts = t.daypart.where(F.col("active_yn") == "Y").select("media_outlet_id", "daypart_id", F.col("name").alias("daypart"))
    known_days = day_map(t.cal_period, "D").select(F.col("day").alias("broadcast_date"))
    # Flights and spots are dealt by plan and project once; days, dayparts, the join, the cells and both totals then need no shuffle.
    # A named number of partitions stays as it is: flights are small, but their cells are many.
    deal = [int(t.spark.conf.get("spark.sql.shuffle.partitions")), "plan_id", "project_id"]
    dated = flights(t).repartition(*deal).withColumn("broadcast_date", F.explode(F.sequence("start_date", "end_date")))
    if demo_id is not None:
        dated = dated.withColumn("demo_id", F.lit(demo_id))
    cells = dated.join(known_days, "broadcast_date", "left_semi").join(parts, "media_outlet_id")
    values = ["planned_units", "planned_grp"]
    keys = ["plan_id", "project_id", "media_outlet_id", "demo_id", "daypart_id", F.col("start_date").alias("broadcast_date")]
    spots = (
        t.schedule.select(*keys, F.lit(LAUNCH_EPISODE).alias("episode_id"), *values)
        .unionByName(t.schedule_episode.select(*keys, "episode_id", *values))
    )
    on = ["plan_id", "project_id", "media_outlet_id", "demo_id", "daypart_id", "broadcast_date", "episode_id"]
    spots = spots.repartition(*deal).distinct()
    detail = cells.join(spots, on, "left").select(
        "plan_id", "project_id", "episode_id", "broadcast_date", "daypart_id", "daypart", "airing_date",
        F.when(F.col("episode_id") == LAUNCH_EPISODE, F.lit("Launch")).otherwise(F.concat(F.lit("Episode"), F.col("episode_id"))).alias("phase"),
        *[F.coalesce(F.col(v), F.lit(0)).cast(spots.schema[v].dataType).alias(v) for v in values])
    # One row per shown cell, with the sums of the rows it stands for; totals roll up from these partial sums.
    cell = ["plan_id", "project_id", "broadcast_date", "episode_id", "daypart_id", "phase", "airing_date", "planned_units", "planned_grp"]
    shown = detail.groupBy(*cell).agg(F.max("daypart").alias("daypart"), F.sum("planned_units").alias("sum_units"), F.sum("planned_grp").alias("sum_grp"))
    sums = [F.sum("sum_units").alias("planned_units"), F.sum("sum_grp").alias("planned_grp")]
    by_part = shown.groupBy("plan_id", "project_id", "daypart_id").agg(F.max("daypart").alias("daypart"), *sums).withColumns({
        "broadcast_date": F.lit("TOTAL"), "data_type": F.lit(DAYPART_TOTAL)})
    by_day = shown.groupBy("plan_id", "project_id", "broadcast_date", "episode_id").agg(*sums).withColumns({
        "broadcast_date": F.col("broadcast_date").cast("string"), "data_type": F.lit(DAY_TOTAL)})
    cells = shown.drop("sum_units", "sum_grp").withColumns({
        "broadcast_date": F.col("broadcast_date").cast("string"),
        "data_type": F.when(F.col("episode_id") == LAUNCH_EPISODE, F.lit(LAUNCH_ROW)).otherwise(F.lit(EPISODE_ROW))})
    typed = lambda rows: rows.withColumns({"planned_units": F.col("planned_units").cast("bigint"), "planned_grp": F.col("planned_grp").cast("decimal(28,2)")})
    every = typed(cells).unionByName(typed(by_part), allowMissingColumns=True).unionByName(typed(by_day), allowMissingColumns=True)
    return every.select("plan_id", "project_id", "broadcast_date", "daypart_id", "daypart", "episode_id", "phase", "airing_date", "planned_units", "planned_grp", "data_type")


def daypart_order(t) -> DataFrame:
    w = Window.partitionBy("media_outlet_id").orderBy("daypart_id")
    return t.daypart.where(F.col("active_yn") == "Y").select(
        "media_outlet_id", "daypart_id", "name", F.row_number().over(w).alias("display_seq"))
