"""Versioned save of plans as table-to-table steps: old snapshot and staging in, new snapshot out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotgrid.functions.columns import json_fault, monday_of
from spotgrid.functions.joins import assign_ids, replace_groups, snapshot_merge
from spotgrid.plans.context import latest_version
from spotgrid.sources.day_sums import partitions_of
from spotgrid.sources.shared import stage

# Status codes, the two full bit masks that use the total segment type, and event texts.
DRAFT, FAILED = 0, 7
CHANGED_STATUS, NEW_STATUS, EPISODE_STATUS = 11, 12, 10
FULL_MASKS, TOTAL_SEGMENT_TYPE = (31, 480), 3
EPISODES_ONLY_PHASE, LAUNCH_PHASES = 2, (1, 3)
PLAN_CREATED, VERSION_CREATED = "NEW PLAN CREATED", "NEW PLAN VERSION CREATED"
SPOTS_REMOVED = "SPOTS REMOVED FOR DELETED PROJECT FROM A PLAN"
REACH_REMOVED = "REACH DATA REMOVED FOR DELETED PROJECT FROM A PLAN"
SAVE_STEP = "SAVE PLANS"

EPISODE_JSON = ("array<struct<PROJECT_ID:bigint,EPISODE_NUM:int,TARGET_GRP:double,TARGET_SPOT:int,START_TS:timestamp,"
                "END_TS:timestamp,EPISODE_START_TS:timestamp,chkSelectRow:boolean>>")


def resolve_plan(t) -> DataFrame:
    """Plan id of every save request: the plan of its outlet, quarter and type, or a new id."""
    known = t.plan.select("media_outlet_id", "period_id", "plan_type", "plan_id", "plan_status_id")
    asked = t.save_request.join(known, ["media_outlet_id", "period_id", "plan_type"], "left")
    found = asked.where(F.col("plan_id").isNotNull()).withColumn("is_new", F.lit(False))
    fresh = assign_ids(asked.where(F.col("plan_id").isNull()).drop("plan_id"), "plan_id", "uid", t.plan)
    return found.unionByName(fresh.withColumn("is_new", F.lit(True)))


def decide_version(t) -> DataFrame:
    """Version every request writes: first, the newest again, or the next one.

    A decision already staged under ``save_decision`` is taken as it is.
    """
    if t.given("save_decision"):
        return t.save_decision
    newest = latest_version(t.plan_version).withColumnRenamed("plan_version_id", "newest")
    reuse = F.col("plan_status_id").isin(DRAFT, FAILED)
    return (
        resolve_plan(t).join(newest, "plan_id", "left")
        .withColumn("version_action", F.when(F.col("newest").isNull(), "first").when(reuse, "reuse").otherwise("next"))
        .withColumn("plan_version_id", F.when(F.col("newest").isNull(), F.lit(0).cast("bigint")).when(reuse, F.col("newest")).otherwise(F.col("newest") + 1))
        .drop("newest")
    )


def versioned_name(name: F.Column, version: F.Column) -> F.Column:
    """The map name without any ``-v...`` ending, numbered with the version."""
    cut = F.instr(name, "-v")
    base = F.when(cut > 0, F.substring(name, F.lit(1), cut - 1)).otherwise(name)
    return F.concat(base, F.lit("-v"), version + 1)


def saved_plans(t, as_of: dt.datetime) -> DataFrame:
    """Plan table after the save: named for the version, back in draft, comments cleared; new plans added."""
    decided = decide_version(t)
    name = versioned_name(F.col("map_name"), F.col("plan_version_id"))
    saved = decided.select("plan_id", "is_new", "media_outlet_id", "period_id", "plan_type", name.alias("new_name"), F.col("user_id").alias("new_user"))
    touched = t.plan.join(saved.where(~F.col("is_new")).select("plan_id", "new_name", "new_user"), "plan_id").withColumns({
        "name": F.col("new_name"), "update_user": F.col("new_user"), "update_ts": F.lit(as_of), "plan_status_id": F.lit(DRAFT),
        "comments": F.lit(None).cast("string")}).drop("new_name", "new_user")
    added = saved.where("is_new").select(
        "plan_id", "media_outlet_id", "period_id", "plan_type", F.col("new_name").alias("name"), F.lit(DRAFT).alias("plan_status_id"),
        F.lit("Y").alias("active_yn"), F.lit("Y").alias("checked_yn"), F.lit(None).cast("string").alias("comments"), F.lit(as_of).alias("create_ts"), F.lit(as_of).alias("update_ts"),
        F.col("new_user").alias("update_user"))
    return snapshot_merge(t.plan, touched.unionByName(added), ["plan_id"])


def saved_versions(t, as_of: dt.datetime) -> DataFrame:
    """Version table after the save: reused versions take the new optimisation type, others are added with name and editor."""
    decided = decide_version(t).select("plan_id", "plan_version_id", F.col("optimization_type").alias("new_type"), "version_action", "map_name", "user_id")
    keys = ["plan_id", "plan_version_id"]
    reused = t.plan_version.join(decided.where(F.col("version_action") == "reuse").select(*keys, "new_type"), keys).withColumns({
        "optimization_type": F.col("new_type"), "update_ts": F.lit(as_of)}).drop("new_type")
    added = decided.where(F.col("version_action") != "reuse").select(
        *keys, F.col("new_type").alias("optimization_type"), F.col("map_name").alias("version_name"), F.lit("Y").alias("active_yn"),
        F.col("user_id").alias("create_user"), F.lit(as_of).alias("create_ts"), F.col("user_id").alias("update_user"), F.lit(as_of).alias("update_ts"))
    return snapshot_merge(t.plan_version, reused.unionByName(added, allowMissingColumns=True), keys)


def staged_projects(t, as_of: dt.datetime) -> DataFrame:
    """Project rows a save writes, before results are carried forward."""
    decided = decide_version(t).select("uid", "plan_id", "plan_version_id", "user_id")
    before = t.plan_project.select("plan_id", (F.col("plan_version_id") + 1).alias("plan_version_id"), "project_id",
                                   F.col("update_ts").alias("previous_ts"))
    by_mask = t.segment.groupBy(F.col("mask").alias("segment_mask"), F.col("segment_type_id").alias("wanted_type")).agg(
        F.min("segment_id").alias("masked_segment"))
    optimise = F.col("optimize_yn") == "Y"
    now = F.lit(as_of)
    return (
        t.stg_plan_project.join(decided, "uid")
        .withColumn("wanted_type", F.when(F.col("segment_mask").isin(*FULL_MASKS), F.lit(TOTAL_SEGMENT_TYPE)).otherwise(F.col("segment_type_id")))
        .join(by_mask, ["segment_mask", "wanted_type"], "left").join(before, ["plan_id", "plan_version_id", "project_id"], "left")
        .select(
            "plan_id", "plan_version_id", "project_id",
            F.when(optimise | (F.col("is_dirty") == "Y"), F.lit(CHANGED_STATUS)).otherwise(F.coalesce("status_cd", F.lit(NEW_STATUS))).alias("status_cd"),
            "optimize_yn", "is_dirty", F.lit("Y").alias("is_active"), "display_seq", "priority", "episode_priority",
            F.col("target_reach").alias("target_reach_pct"), "target_grp",
            F.when((F.col("cluster_id") >= 1) & F.col("segment_id").isNull(), F.col("masked_segment")).otherwise(F.col("segment_id")).alias("segment_id"),
            "frequency", "demo_id", "cluster_id", "phase_type", "on_map_start", "on_map_end", "on_map_premiere", "on_map_start_ts", "on_map_end_ts",
            "planned_spots", "guide_reach_pct", "guide_grp", "guide_spots", "network_target_demo_id", "segment_type_id", "segment_mask",
            "no_of_episode", "user_comment", F.col("user_id").alias("create_user"), now.alias("create_ts"), F.col("user_id").alias("update_user"),
            F.when(optimise, now).otherwise(F.coalesce("previous_ts", now)).alias("update_ts"))
    )


def carry_forward_results(staged: DataFrame, t) -> DataFrame:
    """Rating points and reach of the previous version, copied before that version loses any row."""
    before = t.plan_project.select("plan_id", (F.col("plan_version_id") + 1).alias("plan_version_id"), "project_id", "proj_grp", "proj_reach_pct")
    return staged.join(before, ["plan_id", "plan_version_id", "project_id"], "left")


def freeze_optimize_flag(rows: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Episode-only projects and finished launches are not optimised again."""
    frozen = (F.col("phase_type") == EPISODES_ONLY_PHASE) | (F.col("phase_type").isin(*LAUNCH_PHASES) & (F.col("on_map_end") <= F.lit(as_of.date())))
    return rows.withColumn("optimize_yn", F.when(frozen, "N").otherwise(F.col("optimize_yn")))


def removed_projects(t) -> DataFrame:
    """Active projects of the previous version that the saved version no longer has."""
    decided = decide_version(t).select("uid", "plan_id", "plan_version_id", "media_outlet_id")
    kept = t.stg_plan_project.select("uid", "project_id")
    previous = decided.withColumnRenamed("plan_version_id", "saved_version").withColumn("plan_version_id", F.col("saved_version") - 1)
    gone = t.plan_project.where(F.col("is_active") == "Y").select("plan_id", "plan_version_id", "project_id", "campaign_goal_id")
    return previous.join(gone, ["plan_id", "plan_version_id"]).join(kept, ["uid", "project_id"], "left_anti").select(
        "plan_id", "saved_version", "media_outlet_id", "project_id", "campaign_goal_id")


def removed_episode_projects(t) -> DataFrame:
    decided = decide_version(t).select("uid", "plan_id", "plan_version_id", "media_outlet_id")
    previous = decided.withColumnRenamed("plan_version_id", "saved_version").withColumn("plan_version_id", F.col("saved_version") - 1)
    gone = t.plan_project_episode.where(F.col("is_active") == "Y").select("plan_id", "plan_version_id", "project_id").distinct()
    return previous.join(gone, ["plan_id", "plan_version_id"]).join(
        t.stg_plan_project.select("uid", "project_id"), ["uid", "project_id"], "left_anti").select("plan_id", "saved_version", "media_outlet_id", "project_id")


def upsert_plan_projects(t, as_of: dt.datetime) -> DataFrame:
    """Project table after the save: the saved versions' rows replaced, removed projects taken out of the previous
    version and switched off in older ones."""
    decided = decide_version(t).select("plan_id", "plan_version_id")
    rows = freeze_optimize_flag(carry_forward_results(staged_projects(t, as_of), t), as_of)
    removed = removed_projects(t).select("plan_id", "project_id", (F.col("saved_version") - 1).alias("plan_version_id"))
    old = (
        t.plan_project.join(removed, ["plan_id", "plan_version_id", "project_id"], "left_anti")
        .join(removed.select("plan_id", "project_id", F.lit(True).alias("off")), ["plan_id", "project_id"], "left")
        .withColumn("is_active", F.when(F.col("off"), "N").otherwise(F.col("is_active"))).drop("off")
    )
    return replace_groups(old, rows, decided, ["plan_id", "plan_version_id"])


def upsert_spots(t) -> DataFrame:
    """Weekly spots after the save; removed projects lose their previous version's spots."""
    decided = decide_version(t).select("uid", "plan_id", "plan_version_id")
    rows = t.stg_spots.join(decided, "uid").select("plan_id", "plan_version_id", "project_id", "week_date", "unit_count")
    removed = removed_projects(t).select("plan_id", "project_id", (F.col("saved_version") - 1).alias("plan_version_id"))
    old = t.plan_project_spots.join(removed, ["plan_id", "plan_version_id", "project_id"], "left_anti")
    return replace_groups(old, rows, decided, ["plan_id", "plan_version_id"])


def propagate_targets(t) -> DataFrame:
    """Project table after the save: targets of the newest staged row, and removed projects unlinked from their plan."""
    decided = decide_version(t).select("uid", "plan_id", "plan_version_id", "media_outlet_id")
    newest = (
        t.stg_plan_project.join(decided.select("uid", "media_outlet_id"), "uid").groupBy("project_id", "media_outlet_id")
        .agg(F.max(F.struct("uid", "target_reach", "planned_spots", "guide_reach_pct", "target_grp", "priority")).alias("s"))
    )
    previous = t.plan_project.select("plan_id", (F.col("plan_version_id") + 1).alias("plan_version_id"), "project_id")
    unlinked = (
        decided.join(previous, ["plan_id", "plan_version_id"])
        .join(t.stg_plan_project.select("uid", "project_id"), ["uid", "project_id"], "left_anti")
        .select("project_id", "plan_id", "media_outlet_id", F.lit(True).alias("gone")).distinct()
    )
    use_guide = (F.coalesce("s.target_reach", F.lit(0)) == 0) & (F.col("s.planned_spots") > 0) & (F.coalesce("target_grp", F.lit(0)) == 0)
    staged = F.col("s").isNotNull()
    return t.project.join(newest, ["project_id", "media_outlet_id"], "left").join(unlinked, ["project_id", "plan_id", "media_outlet_id"], "left").withColumns({
        "target_reach": F.when(staged & use_guide, F.col("s.guide_reach_pct")).when(staged, F.col("s.target_reach")).otherwise(F.col("target_reach")),
        "target_grp": F.when(staged, F.col("s.target_grp")).otherwise(F.col("target_grp")),
        "priority": F.when(staged, F.col("s.priority")).otherwise(F.col("priority")),
        "plan_id": F.when(F.col("gone"), F.lit(None)).otherwise(F.col("plan_id")),
    }).select(*t.project.columns)


def cascade_remove(t, clean_schedule: bool = False) -> dict[str, DataFrame]:
    """Tables without the rows of removed projects.

    Launch schedule rows stay, as the source behaviour has it, unless ``clean_schedule`` is set.
    """
    launch = removed_projects(t).select("project_id", "media_outlet_id").distinct()
    episode = removed_episode_projects(t).select("project_id", "media_outlet_id").distinct()
    key = ["project_id", "media_outlet_id"]
    planned = F.col("reach_type") == "PLANNED"

    def without_planned(table: DataFrame) -> DataFrame:
        # Rows without a reach type aren't planned ones; they stay.
        return table.where(planned).join(launch, key, "left_anti").unionByName(table.where(~F.coalesce(planned, F.lit(False))))

    out = {
        "schedule_episode": t.schedule_episode.join(episode, key, "left_anti"),
        "project_reach": without_planned(t.project_reach),
        "project_reach_episode": without_planned(t.project_reach_episode),
        "campaign_goal": t.campaign_goal.join(launch, key, "left_anti"),
        "campaign_goal_episode": t.campaign_goal_episode.join(launch, key, "left_anti"),
    }
    if clean_schedule:
        out["schedule"] = t.schedule.join(launch, key, "left_anti")
    return {name: df.select(*getattr(t, name).columns) for name, df in out.items()}


def refresh_episode_sums(t, path: str) -> DataFrame:
    """The stored episode day sums under ``path`` after ``cascade_remove``: only outlets and quarters with spots of removed projects are summed anew."""
    gone = removed_episode_projects(t).select("project_id", "media_outlet_id").distinct()
    touched = partitions_of(t.schedule_episode.join(gone, ["project_id", "media_outlet_id"], "left_semi"))
    store = t.replace(schedule_episode=cascade_remove(t)["schedule_episode"]).day_sums(path)["schedule_episode"]
    store.refresh(touched)
    return store.rows()


def audit_events(t, as_of: dt.datetime) -> DataFrame:
    """History rows: plans and versions created, and two per removed project."""
    decided = decide_version(t)
    none = F.lit(None).cast("bigint")
    events = [
        decided.where("is_new").select("plan_id", none.alias("plan_version_id"), none.alias("project_id"), F.lit(PLAN_CREATED).alias("description")),
        decided.where(F.col("version_action") != "reuse").select("plan_id", "plan_version_id", none.alias("project_id"), F.lit(VERSION_CREATED).alias("description")),
        removed_projects(t).select("plan_id", F.col("saved_version").alias("plan_version_id"), "project_id",
                                   F.explode(F.array(F.lit(SPOTS_REMOVED), F.lit(REACH_REMOVED))).alias("description")),
    ]
    return events[0].unionByName(events[1]).unionByName(events[2]).withColumns({
        "model_exec_id": none, "episode_id": none, "step_name": F.lit(SAVE_STEP), "event_ts": F.lit(as_of)})


def store_episode_json(t) -> DataFrame:
    """Episode JSON table with the saved versions' staged texts."""
    decided = decide_version(t).select("uid", "plan_id", "plan_version_id")
    rows = t.stg_episode_json.join(decided, "uid").select("plan_id", "plan_version_id", "project_id", "episode_dtl_json")
    return replace_groups(t.episode_json, rows, decided, ["plan_id", "plan_version_id"])


def episode_json_fault(text: str) -> Column:
    """Why an episode text can't be loaded, null if it can."""
    known = lambda e: e["PROJECT_ID"].isNotNull() & e["EPISODE_NUM"].isNotNull()
    return json_fault(text, "ARRAY", F.lit("episode without ids"), F.forall(F.from_json(text, EPISODE_JSON), known))


def episode_json_rejects(episode_json: DataFrame) -> DataFrame:
    """Texts that flatten to nothing, and why. A text is loaded as a whole or not at all."""
    return episode_json.withColumn("reason", episode_json_fault("episode_dtl_json")).where("reason is not null").select(
        "plan_id", "plan_version_id", "project_id", "reason", "episode_dtl_json")


def flatten_episode_json(episode_json: DataFrame, only_selected: bool = True) -> DataFrame:
    """One typed row per episode object of the JSON texts; ``episode_json_rejects`` has the texts that give none."""
    sound = episode_json.where(episode_json_fault("episode_dtl_json").isNull())
    rows = sound.select("plan_id", "plan_version_id", F.inline(F.from_json("episode_dtl_json", EPISODE_JSON)))
    if only_selected:
        rows = rows.where("chkSelectRow")
    return rows.select(
        "plan_id", "plan_version_id", F.col("PROJECT_ID").alias("project_id"), F.col("EPISODE_NUM").alias("episode_id"),
        F.col("TARGET_GRP").cast("decimal(18,2)").alias("target_grp"), F.col("TARGET_SPOT").alias("target_spots"),
        F.col("START_TS").cast("date").alias("start_date"), F.col("END_TS").cast("date").alias("end_date"),
        F.col("EPISODE_START_TS").alias("episode_start_ts"))


def staged_episodes(t) -> DataFrame:
    decided = decide_version(t).select("uid", "plan_id", "plan_version_id")
    return flatten_episode_json(t.stg_episode_json.join(decided, "uid"))


def insert_episodes(t, as_of: dt.datetime) -> DataFrame:
    """Episode rows of the saved versions; flags and audience come from the project row."""
    project = staged_projects(t, as_of).select("plan_id", "plan_version_id", "project_id", "optimize_yn", "is_dirty", "is_active",
                                               F.col("episode_priority").alias("priority"), "cluster_id", "segment_id", "frequency", "demo_id")
    return staged_episodes(t).join(project, ["plan_id", "plan_version_id", "project_id"]).select(
        "plan_id", "plan_version_id", "project_id", "episode_id", F.col("target_spots").alias("tgt_spots"), "target_grp", "episode_start_ts",
        F.lit(EPISODE_STATUS).alias("status_cd"), "optimize_yn", "is_dirty", "is_active", "priority", "cluster_id", "segment_id", "frequency", "demo_id",
        F.col("start_date").alias("on_map_start"), F.col("end_date").alias("on_map_end"))


def episode_spots(t) -> DataFrame:
    """Weekly count of each saved episode: its point target if set, else its spots, on the Monday it starts."""
    return staged_episodes(t).select(
        "plan_id", "plan_version_id", "project_id", "episode_id", monday_of(F.col("start_date")).alias("week_date"),
        F.coalesce("target_grp", "target_spots").cast("decimal(18,2)").alias("unit_count"))


def upsert_episode_map(t) -> DataFrame:
    """Saved episode weeks merged with staged ones that have units."""
    decided = decide_version(t).select("uid", "plan_id", "plan_version_id")
    keys = ["plan_id", "plan_version_id", "project_id", "episode_id", "week_date"]
    rows = t.stg_episode_map.where(F.col("unit_count") > 0).join(decided, "uid").select(
        *keys, "unit_count", "episode_start_date", "episode_end_date", "broadcast_date", "episode_start_ts")
    return snapshot_merge(t.plan_project_spots_episode_map, rows, keys)


def save_plans(t, as_of: dt.datetime, clean_schedule: bool = False) -> dict[str, DataFrame]:
    """Every table a save changes, as its new snapshot, and the history rows to append.

    The version decision is staged once. All snapshots read the tables as they were before the save,
    so results are carried forward before the previous version loses rows.
    """
    t = t.replace(save_decision=stage(t.spark, decide_version(t), "save_decision"))
    saved = t.save_decision.select("plan_id", "plan_version_id")
    version = ["plan_id", "plan_version_id"]
    return {
        "plan": saved_plans(t, as_of),
        "plan_version": saved_versions(t, as_of),
        "plan_project": upsert_plan_projects(t, as_of),
        "plan_project_spots": upsert_spots(t),
        "project": propagate_targets(t),
        "episode_json": store_episode_json(t),
        "plan_project_episode": replace_groups(t.plan_project_episode, insert_episodes(t, as_of), saved, version),
        "plan_project_spots_episode": replace_groups(t.plan_project_spots_episode, episode_spots(t), saved, version),
        "plan_project_spots_episode_map": upsert_episode_map(t),
        "history": audit_events(t, as_of),
        **cascade_remove(t, clean_schedule),
    }
