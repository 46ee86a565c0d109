"""Reach guides: build the units-to-reach curve and read it both ways."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotgrid.functions.joins import as_of as as_of_join
from spotgrid.functions.joins import day_map
from spotgrid.plans.calendar import periods
from spotgrid.sources.shared import stage

# The outlet whose guide quarter must end before the map
# quarter starts, and what each mode measures.
EARLY_GUIDE_OUTLET = 1
ONE_WEEK_MODES = ("ER", "EG")
REACH_MODES, GRP_MODES, SPOT_MODE = ("R", "ER"), ("G", "EG"), "S"

NUM = "decimal(18,2)"


def flight_profile(t, as_of: dt.date) -> DataFrame:
    """Open requests with their segment and week count.

    Flights that ended before the current week leave; where the calendar has no current week, or a flight no end,
    nothing is known to have ended. A project of another network has its
    segment looked up again by bit mask.
    """
    week = periods(t.cal_period, "W").where(F.lit(as_of).between(F.col("start_date"), F.col("end_date")))
    current_week_start = week.select("start_date").scalar()
    project = t.project.select("project_id", F.col("media_outlet_id").alias("project_outlet_id"), "target_segment")
    by_mask = t.segment.groupBy(F.col("mask").alias("wanted_segment")).agg(F.min("segment_id").alias("masked_segment_id"))
    days = F.datediff("flight_end", "flight_start") + 1
    return (
        t.reach_request.withColumnRenamed("segment_id", "asked_segment").join(project, "project_id")
        .withColumn("wanted_segment", F.coalesce("asked_segment", "target_segment").cast("bigint"))
        .join(by_mask, "wanted_segment", "left").where(~F.coalesce(F.col("flight_end") < current_week_start, F.lit(False)))
        .withColumns({
            "segment_id": F.when(F.col("project_outlet_id") != F.col("media_outlet_id"), F.col("masked_segment_id"))
            .otherwise(F.col("wanted_segment").cast("int")),
            "flight_week_count": F.greatest(F.round(days / 7).cast("int"), F.lit(1)),
        })
        .select("call_id", "project_id", "media_outlet_id", "demo_id", "segment_id", "frequency", "calc_based_on", "target_reach_pct",
                "target_grps", "planned_spot", "flight_start", "flight_end", "qtr_start", "flight_week_count")
    )


def select_guide(requests: DataFrame, t) -> DataFrame:
    """Guide of the latest quarter before the map's quarter, or the newest guide of the outlet and audience."""
    keys = requests.select("media_outlet_id", "demo_id", "qtr_start").distinct()
    limit = F.when(F.col("media_outlet_id") == EARLY_GUIDE_OUTLET, F.col("qtr_start")).otherwise(F.date_add("qtr_start", 1))
    holding = day_map(t.cal_period, "Q").select(F.col("day").alias("limit"), F.date_sub("period_start", 1).alias("base_end"))
    quarter = periods(t.cal_period, "Q").select(F.col("start_date").alias("base_start"), F.col("end_date").alias("base_end"))
    headers = t.reach_header.withColumnRenamed("target_demo_id", "demo_id")
    exact = headers.groupBy("media_outlet_id", "demo_id", "base_start", "base_end").agg(F.max("reach_id").alias("exact_id"))
    newest = headers.groupBy("media_outlet_id", "demo_id").agg(F.max("reach_id").alias("newest_id"))
    return (
        keys.withColumn("limit", limit).join(holding, "limit", "left").join(quarter, "base_end", "left")
        .join(exact, ["media_outlet_id", "demo_id", "base_start", "base_end"], "left")
        .join(newest, ["media_outlet_id", "demo_id"], "left")
        .select("media_outlet_id", "demo_id", "qtr_start", F.coalesce("exact_id", "newest_id").alias("reach_id"))
    )


def guide_limits(t) -> DataFrame:
    return t.reach_detail.groupBy("reach_id").agg(
        F.max("week_count").alias("available_weeks"), F.max("unit_count").alias("available_units"))


def guided_requests(t, as_of: dt.date) -> DataFrame:
    """Requests with their guide and the week count the guide can serve, beside the weeks asked for; per-week modes read week one."""
    requests = stage(t.spark, flight_profile(t, as_of), "open_requests")
    return (
        requests.join(select_guide(requests, t), ["media_outlet_id", "demo_id", "qtr_start"], "left")
        .join(guide_limits(t), "reach_id", "left")
        .withColumn("week_count", F.when(F.col("calc_based_on").isin(*ONE_WEEK_MODES), F.lit(1))
                    .otherwise(F.least("flight_week_count", "available_weeks")))
    )


def build_reach_guide(t, wanted: DataFrame | None = None) -> DataFrame:
    """Curve points per guide, segment, weeks, frequency and units.

    ``wanted`` (reach_id, segment_id) limits the guides built; segments are summed from their components.
    """
    header = t.reach_header.select("reach_id", "target_demo_id")
    universe = t.demo.select(F.col("demo_id").alias("target_demo_id"), F.col("universe").alias("audience"))
    parts = t.segment_component.select("segment_id", F.col("component_segment_id").alias("part_id"))
    detail = t.reach_detail.withColumnRenamed("segment_id", "part_id")
    on = ["part_id"]
    if wanted is not None:
        parts = wanted.select("reach_id", "segment_id").distinct().join(parts, "segment_id")
        on = ["reach_id", "part_id"]
    key = ["reach_id", "segment_id", "week_count", "unit_count"]
    # Windows are summed per component first, so the spread over segments sees one row per curve point.
    per_part = detail.groupBy("reach_id", "part_id", "week_count", "unit_count", "frequency").agg(
        F.sum("reach").alias("reach"), F.sum("universe").alias("universe"), F.sum("cov_grp").alias("cov"), F.count(F.lit(1)).alias("n"))
    share = (F.sum("reach") * 100).cast("decimal(23,0)") / F.sum("universe").cast("decimal(14,0)")
    coverage = F.sum("cov").cast("decimal(23,2)") / F.sum("n").cast("decimal(12,0)")
    curve = per_part.join(parts, on).groupBy(*key, "frequency").agg(
        F.round(share, 2).cast(NUM).alias("reach_pct"), F.round(coverage, 0).cast(NUM).alias("cov_grp"))
    per_window = detail.where(F.col("frequency") == 1).join(parts, on).groupBy(*key, "start_date", "end_date").agg(F.sum("impressions").alias("imps"))
    rating = (F.col("imps") * 100).cast("decimal(23,0)") / F.col("audience").cast("decimal(14,0)")
    points = per_window.join(header, "reach_id").join(universe, "target_demo_id").groupBy(*key).agg(
        F.max(F.round(rating, 2)).cast(NUM).alias("grp"))
    return curve.join(points, key).select("reach_id", "segment_id", "week_count", "frequency", "unit_count", "reach_pct", "cov_grp", "grp")


def target_metric() -> Column:
    """What a request aims at, in the measure of its mode."""
    mode = F.col("calc_based_on")
    return F.when(mode.isin(*REACH_MODES), F.col("target_reach_pct")).when(mode.isin(*GRP_MODES), F.col("target_grps")) \
        .when(mode == SPOT_MODE, F.col("planned_spot").cast(NUM))


CURVE = ["reach_id", "segment_id", "week_count", "frequency"]
#: Measures along which a curve is read, and the modes that read it so.
MEASURES = (("reach_pct", REACH_MODES), ("grp", GRP_MODES), ("unit_count", (SPOT_MODE,)))


def bracket(requests: DataFrame, guide: DataFrame) -> DataFrame:
    """Nearest curve points below and above each target, and the guide's largest point.

    A curve unfolds into one line per measure, and each line is read in one sorted pass. A curve may fall: the lower point is
    the one of most units that doesn't exceed the target, the upper one that of fewest units that reaches it.
    """
    ids = ["call_id", "project_id"]
    point = F.struct("unit_count", "reach_pct", "grp")
    line = F.explode(F.array(*[F.struct(F.lit(i).alias("measure"), F.col(c).cast(NUM).alias("at")) for i, (c, _) in enumerate(MEASURES)]))
    points = guide.select(*CURVE, point.alias("point"), line.alias("line")).select(*CURVE, "point", "line.*")
    measure = F.coalesce(*[F.when(F.col("calc_based_on").isin(*modes), F.lit(i)) for i, (_, modes) in enumerate(MEASURES)])
    asks = requests.select(*ids, *CURVE, measure.alias("measure"), target_metric().alias("at"))
    found = as_of_join(asks, points, [*CURVE, "measure"], "at", "point", ids)
    largest = guide.select(*CURVE, F.col("unit_count").alias("available_units"), point.alias("top"))
    zero = {"unit_count": F.lit(0), "reach_pct": F.lit(0).cast(NUM), "grp": F.lit(0).cast(NUM)}
    named = {f"{side}_{c}": F.coalesce(F.col(f"{side}.{c}"), z) for side in ("lower", "upper") for c, z in zero.items()}
    named |= {f"top_{c}": F.col(f"top.{c}") for c in zero}
    return requests.join(largest, [*CURVE, "available_units"], "left").join(found, ids, "left").select(*requests.columns, "lower", "upper", "top").withColumns(
        named).drop("lower", "upper", "top")


def interpolate(rows: DataFrame) -> DataFrame:
    """Spots, reach and points of each request by its mode, written back with points to one decimal.

    A flat stretch of the curve gives its lower point. Without an upper bracket the guide's largest point counts.
    """
    mode = F.col("calc_based_on")
    lu, lr, lg = F.col("lower_unit_count").cast(NUM), F.col("lower_reach_pct"), F.col("lower_grp")
    uu, ur, ug = F.col("upper_unit_count").cast(NUM), F.col("upper_reach_pct"), F.col("upper_grp")
    by_reach, by_grp, by_spot = mode.isin(*REACH_MODES), mode.isin(*GRP_MODES), mode == SPOT_MODE
    low = F.when(by_reach, lr).when(by_grp, lg).when(by_spot, lu)
    high = F.when(by_reach, ur).when(by_grp, ug).when(by_spot, uu)
    target = target_metric()
    whole = mode.isin(*ONE_WEEK_MODES)

    def step(a: Column, b: Column, digits: Column | int) -> Column:
        """Rise from ``a`` to ``b`` at the target, rounded; zero on a flat curve."""
        exact = ((b - a) * (target - low)).cast("decimal(28,4)") / F.nullif((high - low).cast("decimal(10,2)"), F.lit(0).cast("decimal(10,2)"))
        rounded = F.round(exact, digits) if isinstance(digits, int) else F.when(digits, F.round(exact, 0)).otherwise(F.round(exact, 2))
        return F.coalesce(rounded.cast(NUM), F.lit(0).cast(NUM))

    apart, reversed_ = lu != uu, lu > uu
    spots = F.when(by_spot, F.col("planned_spot").cast(NUM)).when(~apart, lu).when(reversed_, uu).otherwise(lu + step(lu, uu, 0))
    reach = F.when(by_reach, F.col("target_reach_pct")).when(~apart, lr).otherwise(lr + step(lr, ur, whole))
    points = F.when(~apart, lg).when(reversed_, ug).otherwise(lg + step(lg, ug, whole))
    no_upper = F.col("upper_unit_count") == 0
    known = by_reach | by_grp | by_spot
    return rows.select(
        "call_id", "project_id", "media_outlet_id", "calc_based_on", "flight_start", "flight_end", "qtr_start",
        F.col("flight_week_count").alias("asked_weeks"), "week_count",
        F.when(known, F.when(no_upper, F.col("top_unit_count")).otherwise(spots)).cast("bigint").alias("spot_result"),
        F.when(known, F.when(no_upper, F.col("top_reach_pct")).otherwise(reach)).cast(NUM).alias("reach_pct_result"),
        F.when(known, F.round(F.when(no_upper, F.col("top_grp")).otherwise(points), 1)).cast("decimal(18,1)").alias("grps_result"),
    )


def reach_brackets(t, as_of: dt.date) -> DataFrame:
    requests = stage(t.spark, guided_requests(t, as_of), "guided_requests")
    # Both passes over the curves read one table.
    guide = stage(t.spark, build_reach_guide(t, requests.where(F.col("reach_id").isNotNull() & F.col("segment_id").isNotNull())), "reach_curves")
    return bracket(requests, guide)


def reach_estimates(t, as_of: dt.date) -> DataFrame:
    """The whole refresh: profile, guide, brackets and interpolation of every request."""
    return interpolate(reach_brackets(t, as_of))
