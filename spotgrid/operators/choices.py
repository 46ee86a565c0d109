"""Lists a planner picks from, and checks on what may be planned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotgrid.functions.columns import flight_weeks
from spotgrid.functions.joins import day_map, join_on_period
from spotgrid.plans.calendar import periods
from spotgrid.plans.context import default_demo, latest_version

# Ids and codes of the reference lists.
ALL_USERS = ALL_NETWORKS = -1
OWN_CLUSTER, DIVISION_CLUSTER, OTHER_CLUSTER = 1, 2, 3
MISSING_TARGETS, PREMIERE_DIFFERS, IN_OTHER_QUARTER = 4, 5, 7
NO_DAYPARTS, NO_CAPACITY, NO_SPOTS_PER_HOUR = 1, 2, 3
BASE_SEGMENTS, WHOLE_NETWORK_SEGMENT, DAY_SEGMENT_TYPE = 10, 10, 4
TARGET_TO_SEGMENT = {1: 1, 2: 11, 3: 21, 4: 31, 5: 10}
EVENT_PROJECT_TYPE = 2


def user_networks(t) -> DataFrame:
    """Networks every user may see with their rating class; user -1 stands for all networks."""
    rated, streaming = F.col("rated_yn"), F.col("streaming_yn")
    networks = t.media_outlet.where(F.col("media_outlet_id") > 0).select(
        "media_outlet_id", "name", "external_short_name", "short_name", "cable_network_id",
        F.when((rated == "N") & (streaming == "N"), "NON-RATED").when((rated == "N") & (streaming == "Y"), "STREAMING")
        .otherwise("RATED").alias("media_outlet_type"))
    everyone = networks.select(F.lit(ALL_USERS).cast("bigint").alias("user_id"), "*")
    return everyone.unionByName(t.user_outlet.join(networks, "media_outlet_id")).distinct()


def cluster_networks(t, media_outlet_id: int) -> DataFrame:
    """Every network seen from one network: itself, its division, or another."""
    active = t.division_network.where(F.col("active_yn") == "Y")
    excluded = t.division.where((F.col("include_in_cluster") == "N") & (F.col("active_yn") == "Y"))
    home = active.where(F.col("media_outlet_id") == media_outlet_id).join(excluded, "division_id", "left_anti").select("division_id")
    same = active.join(home, "division_id", "left_semi").select("media_outlet_id").distinct().withColumn("same_division", F.lit(True))
    seen = t.media_outlet.where(F.col("media_outlet_id") > 0).select("media_outlet_id").join(same, "media_outlet_id", "left")
    cluster = (
        F.when(F.col("same_division").isNull(), OTHER_CLUSTER)
        .when(F.col("media_outlet_id") == media_outlet_id, OWN_CLUSTER).otherwise(DIVISION_CLUSTER)
    )
    return seen.select("media_outlet_id", cluster.alias("cluster_id")).join(t.cluster, "cluster_id").select(
        "media_outlet_id", "cluster_id", "cluster_name")


def _of_network(df: DataFrame, media_outlet_id: int | None) -> DataFrame:
    return df if media_outlet_id in (None, ALL_NETWORKS) else df.where(F.col("media_outlet_id") == media_outlet_id)


def frequencies(t, media_outlet_id: int = ALL_NETWORKS) -> DataFrame:
    return _of_network(t.outlet_frequency, media_outlet_id).select("frequency_id", F.col("frequency").alias("name")).distinct()


def demo_types(t, media_outlet_id: int | None = None) -> DataFrame:
    active = _of_network(t.outlet_demo, media_outlet_id).where(F.col("active_yn") == "Y")
    return active.join(t.demo, "demo_id").select(
        "demo_id", F.col("name").alias("demo_type_name"), "active_yn", "default_yn", "media_outlet_id")


def episodic_phases(t) -> DataFrame:
    return t.phase.where(F.col("is_active") == "Y").select("phase_type", "description", "is_active", "display_seq")


def segment_selection(t) -> DataFrame:
    """For every project and base segment, whether the project's target covers it.

    The base segments are the fixed ids 1 to 10, so each project unfolds into at most ten rows.
    """
    masked = F.when(F.col("segment_mask") > 0, F.col("target_segment"))
    remap = F.create_map(*[F.lit(v) for pair in TARGET_TO_SEGMENT.items() for v in pair])
    computed = F.when(F.col("is_segment_computed") == "N", F.coalesce(F.try_element_at(remap, F.col("target_segment")), F.col("target_segment"))) \
        .otherwise(F.col("target_segment"))
    projects = t.project.select("project_id", "segment_mask", masked.alias("marker"), computed.alias("parent_id"),
                                F.explode(F.sequence(F.lit(1), F.lit(BASE_SEGMENTS))).alias("segment_id"))
    parts = t.segment_component.select(F.col("segment_id").alias("parent_id"), F.col("component_segment_id").alias("segment_id")).distinct().withColumn(
        "listed", F.lit(True))
    rows = (
        projects.join(t.segment, "segment_id").join(t.segment_type, "segment_type_id")
        .join(parts, ["parent_id", "segment_id"], "left")
    )
    by_mask = (F.col("mask").bitwiseAND(F.col("segment_mask")) > 0) & (F.col("segment_type_id") == DAY_SEGMENT_TYPE)
    chosen = (
        F.when(F.col("marker") == 0, by_mask)
        .when(F.col("marker") == WHOLE_NETWORK_SEGMENT, F.col("segment_id") == WHOLE_NETWORK_SEGMENT)
        .otherwise(F.col("listed").isNotNull())
    )
    return rows.select("project_id", "segment_id", "segment_name", "segment_type_id", "description", "mask", chosen.cast("int").alias("is_selected"))


def network_config_errors(t) -> DataFrame:
    """Missing set-up per outlet and quarter that has a plan: dayparts, spots per hour, capacity."""
    asked = t.plan.select("media_outlet_id", "period_id").distinct()
    with_parts = t.daypart.where((F.col("active_yn") == "Y") & F.col("start_offset").isNotNull()).select("media_outlet_id").distinct()
    with_spots = t.spots_per_hour.select("media_outlet_id").distinct()
    q = day_map(t.cal_period, "Q").select("day", "period_id", "period_end")
    with_capacity = (
        t.capacity.where(F.col("plan_type") == 1).select("media_outlet_id", "start_date", "end_date").distinct()
        .join(q, F.col("start_date") == F.col("day")).where(F.col("end_date") <= F.col("period_end"))
        .select("media_outlet_id", "period_id").distinct()
    )
    missing = [
        (asked.join(with_parts, "media_outlet_id", "left_anti"), NO_DAYPARTS),
        (asked.join(with_spots, "media_outlet_id", "left_anti"), NO_SPOTS_PER_HOUR),
        (asked.join(with_capacity, ["media_outlet_id", "period_id"], "left_anti"), NO_CAPACITY),
    ]
    errors = missing[0][0].withColumn("validation_id", F.lit(missing[0][1]))
    for df, code in missing[1:]:
        errors = errors.unionByName(df.withColumn("validation_id", F.lit(code)))
    return errors.join(t.map_validation, "validation_id").select("media_outlet_id", "period_id", "validation_id", "validation_message")


def project_eligibility(t, project_type: int, networks: str | None = None, views: DataFrame | None = None) -> DataFrame:
    """Active projects by start quarter with their checks, seen from the plan of a home outlet in that quarter.

    ``networks`` is an optional comma list of outlet ids. ``views`` (home_outlet_id, media_outlet_id) says which outlets'
    projects each home outlet looks at; without it, an outlet looks at its own. The home plan and the check for other
    quarters belong to the home outlet.
    """
    projects = t.project.where((F.col("is_active") == "Y") & (F.col("project_type") == project_type))
    if networks is not None:
        projects = projects.where(F.col("media_outlet_id").isin(*[int(n) for n in networks.split(",")]))
    if project_type == EVENT_PROJECT_TYPE:
        projects = projects.join(t.subevent.where(F.col("optimization_type") == "O"), "subevent_id", "left_semi")
    quarters = periods(t.cal_period, "Q").select("period_id", F.col("name").alias("quarter_name"),
                                                 F.col("start_date").alias("quarter_start"), F.col("end_date").alias("quarter_end"))
    base = join_on_period(projects.drop("plan_id"), "start_date", t.cal_period, "Q").drop("period_start", "period_end")
    base = base.withColumn("home_outlet_id", F.col("media_outlet_id")) if views is None else base.join(views, "media_outlet_id")
    plans = t.plan.where((F.col("active_yn") == "Y") & (F.col("plan_type") == project_type)).withColumnRenamed("media_outlet_id", "home_outlet_id")
    home = plans.select(F.col("plan_id").alias("home_plan_id"), "home_outlet_id", "period_id", "plan_status_id")
    newest = latest_version(t.plan_version)

    keyed = base.select("project_id", "home_outlet_id", "period_id").join(home, ["home_outlet_id", "period_id"])
    in_plan = t.plan_project.join(newest, ["plan_id", "plan_version_id"], "left_semi").select("plan_id", "project_id")
    elsewhere = (
        keyed.select("project_id", "home_outlet_id", "home_plan_id").join(in_plan, "project_id")
        .join(plans.select("plan_id", "home_outlet_id", F.col("name").alias("plan_name")), ["plan_id", "home_outlet_id"])
        .where(F.col("plan_id") != F.col("home_plan_id")).select("project_id", "home_outlet_id", "plan_name").distinct()
    )
    # The version to compare with: the newest one of a complete plan, the one before it otherwise.
    reference = home.join(newest.withColumnRenamed("plan_id", "home_plan_id"), "home_plan_id").select(
        F.col("home_plan_id").alias("plan_id"),
        F.when(F.col("plan_status_id") != 3, F.col("plan_version_id") - 1).otherwise(F.col("plan_version_id")).alias("plan_version_id"))
    compared = t.plan_project.join(reference, ["plan_id", "plan_version_id"], "left_semi").select("plan_id", "project_id")
    optimised = (
        t.plan_project.where(F.col("optimize_yn") == "Y").groupBy("plan_id", "project_id").agg(F.max("plan_version_id").alias("plan_version_id"))
        .join(compared, ["plan_id", "project_id"], "left_semi")
        .join(t.plan_version.select("plan_id", "plan_version_id", "optimization_type"), ["plan_id", "plan_version_id"])
        .join(keyed.select(F.col("home_plan_id").alias("plan_id"), "project_id", "home_outlet_id"), ["plan_id", "project_id"])
        .select("project_id", "home_outlet_id", "optimization_type")
    )
    no_targets = F.col("target_demo_id").isNull()
    if project_type != EVENT_PROJECT_TYPE:
        no_targets = no_targets | F.col("target_segment").isNull() | F.col("target_frequency").isNull()

    def message(check: str) -> DataFrame:
        return t.map_validation.select(F.col("validation_id").alias(check), F.col("validation_message").alias(f"{check}_msg"))

    demo = default_demo(t.outlet_demo).join(t.demo, "demo_id").select(
        "media_outlet_id", F.col("demo_id").alias("network_default_demo_id"), F.col("name").alias("network_default_demo"))
    return (
        base.join(quarters, "period_id").join(elsewhere, ["project_id", "home_outlet_id"], "left").join(optimised, ["project_id", "home_outlet_id"], "left")
        .withColumns({
            "target_metrics_chk": F.when(no_targets, MISSING_TARGETS).otherwise(0),
            "premiere_date_chk": F.when(F.col("premiere_date") != F.col("end_date"), PREMIERE_DIFFERS).otherwise(0),
            "cross_qtr_chk": F.when(F.col("plan_name").isNotNull(), IN_OTHER_QUARTER).otherwise(0),
            "optimization_type_chk": F.coalesce("optimization_type", F.lit(-1)),
            "no_of_weeks": flight_weeks(F.col("start_date"), F.col("end_date")),
        })
        .join(demo, "media_outlet_id")
        .join(message("target_metrics_chk"), "target_metrics_chk", "left").join(message("premiere_date_chk"), "premiere_date_chk", "left")
        .join(message("cross_qtr_chk"), "cross_qtr_chk", "left")
        .withColumn("cross_qtr_chk_msg", F.replace(F.col("cross_qtr_chk_msg"), F.lit("<>"), F.col("plan_name")))
        .join(t.demo.select(F.col("demo_id").alias("target_demo_id"), F.col("name").alias("demo_name")), "target_demo_id", "left")
        .join(t.segment.select(F.col("segment_id").alias("target_segment"), "segment_name"), "target_segment", "left")
        .join(t.media_outlet.select("media_outlet_id", F.col("short_name").alias("media_outlet_name")), "media_outlet_id", "left")
        .join(t.campaign_type.select("campaign_type_id", F.col("name").alias("campaign_type"), "display_seq"), "campaign_type_id", "left")
        .join(t.event_type, "event_type_id", "left").join(t.subevent.select("subevent_id", "subevent_name"), "subevent_id", "left")
        .select("project_id", F.col("name").alias("project_name"), F.col("start_date").alias("project_start_date"), F.col("end_date").alias("project_end_date"),
                "premiere_date", "priority", "target_demo_id", "demo_name", "target_segment", "segment_name", "target_frequency", "target_reach", "target_grp",
                "media_outlet_id", "media_outlet_name", "campaign_type", "display_seq", "no_of_weeks", "user_comment", "scatter_imps", "event_type_name",
                "subevent_name", "is_episodic", "quarter_name", "quarter_start", "quarter_end", "plan_name", "target_metrics_chk", "premiere_date_chk",
                "cross_qtr_chk", "optimization_type_chk", "target_metrics_chk_msg", "premiere_date_chk_msg", "cross_qtr_chk_msg",
                "network_default_demo_id", "network_default_demo", "home_outlet_id")
    )
