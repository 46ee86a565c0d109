"""The composed jobs and the table sinks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spotgrid.operators import ingest, prepare, save
from spotgrid.sources import snapshot
from spotgrid.sources.tables import BoundTables

SF_DIR = "/root/testdata/sf0.001"
NOON = dt.datetime(1998, 6, 17, 12)


@pytest.fixture(scope="module")
def saved(spark):
    t = BoundTables(spark, SF_DIR)
    return t, save.save_plans(t, NOON)


@pytest.mark.parametrize("name", ["plan", "plan_version", "plan_project", "plan_project_spots", "plan_project_episode",
                                  "plan_project_spots_episode", "plan_project_spots_episode_map", "episode_json", "project", "campaign_goal"])
def test_snapshots_keep_their_table_columns(saved, name):
    t, out = saved
    assert set(getattr(t, name).columns) <= set(out[name].columns)


def test_snapshot_keys_stay_unique(saved):
    _, out = saved
    for name, key in {"plan": ["plan_id"], "plan_version": ["plan_id", "plan_version_id"],
                      "plan_project": ["plan_id", "plan_version_id", "project_id"],
                      "plan_project_spots": ["plan_id", "plan_version_id", "project_id", "week_date"],
                      "plan_project_episode": ["plan_id", "plan_version_id", "project_id", "episode_id"]}.items():
        assert out[name].groupBy(*key).count().where("count > 1").count() == 0, name


def test_every_staged_project_is_saved(saved):
    t, out = saved
    wanted = t.stg_plan_project.join(save.decide_version(t).select("uid", "plan_id", "plan_version_id"), "uid").select(
        "plan_id", "plan_version_id", "project_id")
    assert wanted.count() > 0
    assert wanted.join(out["plan_project"], ["plan_id", "plan_version_id", "project_id"], "left_anti").count() == 0


def test_prepared_rows_have_windows_and_no_open_goals(spark):
    t = BoundTables(spark, SF_DIR)
    out = prepare.prepare_requests(t, NOON, last_measured=dt.date(1998, 5, 13), forced={27: 20})
    assert out["plan_project"].count() == t.plan_project.count()
    newest = t.plan_version.groupBy("plan_id").agg(F.max("plan_version_id").alias("plan_version_id"))
    rows = out["plan_project"].join(newest, ["plan_id", "plan_version_id"], "left_semi")
    assert rows.where("measured_start is null or measured_end is null").count() == 0
    assert rows.where("optimize_yn = 'N' and campaign_goal_id is null").count() == 0
    assert rows.where("optimize_yn = 'Y' and status_cd <> 2").count() == 0
    ids = out["new_runs"].select("model_exec_id")
    assert ids.join(t.model_exec, "model_exec_id", "left_semi").count() == 0 and ids.distinct().count() == ids.count()


def test_replace_partitions_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshot.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "p int, v string"), path, ("p",))
    table = spark.read.parquet(path)
    changed = table.where("p = 2").withColumn("v", F.lit("B"))
    snapshot.replace_partitions(spark, changed, path, ("p",))
    snapshot.append_rows(spark.createDataFrame([(3, "c")], "p int, v string"), path, ("p",))
    assert sorted((r.p, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_emptied_partitions_go_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(p, q, i) for i, (p, q) in enumerate([(1, "a"), (1, "b"), (2, "a/ b"), (2, None), (3, "c")])]
    snapshot.write_table(spark.createDataFrame(rows, "p int, q string, v int"), path, ("p", "q"))
    table = spark.read.schema("v int, p int, q string").parquet(path)
    snapshot.replace_partitions(spark, table.where("v = 0"), path, ("p", "q"), table.where("v = 0 or v = 1").select("p", "q"))
    touched = spark.createDataFrame([(1, "a"), (2, "a/ b"), (2, None)], "p int, q string")
    for _ in range(2):  # doing it again gives the same table
        snapshot.replace_partitions(spark, spark.createDataFrame([(9, 1, "a")], "v int, p int, q string"), path, ("p", "q"), touched)
        assert sorted(tuple(r) for r in spark.read.schema("v int, p int, q string").parquet(path).collect()) == [(4, 3, "c"), (9, 1, "a")]


def test_a_repeated_run_leaves_the_same_history(spark, tmp_path):
    t, path = BoundTables(spark, SF_DIR), str(tmp_path / "history")
    events = save.audit_events(t, NOON)
    read = lambda: sorted((tuple(r) for r in spark.read.parquet(path).collect()), key=str)
    snapshot.append_run(spark, events, path, "run-1")
    once = read()
    snapshot.append_run(spark, events, path, "run-1")
    assert read() == once and len(once) == events.count() > 0
    snapshot.append_run(spark, events.limit(3), path, "run-2")
    snapshot.append_run(spark, events.limit(0), path, "run-2")
    assert read() == once


def test_json_rows_and_rejects_are_all_inputs(spark):
    good = '[{"PROJECT_ID":5,"EPISODE_NUM":2,"TARGET_SPOT":3,"START_TS":"2024-01-01","END_TS":"2024-01-02","chkSelectRow":true}]'
    texts = {1: good, 2: good[:-1], 3: None, 4: "", 5: '{"PROJECT_ID":5}', 6: '[{"PROJECT_ID":"x","EPISODE_NUM":2}]', 7: "[]", 8: "[1]", 9: "null"}
    frame = spark.createDataFrame([(i, 1, 5, x) for i, x in texts.items()], "plan_id int, plan_version_id int, project_id long, episode_dtl_json string")
    rejects = {r.plan_id: r.reason for r in save.episode_json_rejects(frame).collect()}
    assert rejects == {2: "no JSON", 3: "no text", 4: "no JSON", 5: "no array", 6: "episode without ids", 8: "episode without ids", 9: "no array"}
    assert {r.plan_id for r in save.flatten_episode_json(frame, only_selected=False).collect()} == {1}


def test_uploads_and_rejects_are_all_inputs(spark):
    t = BoundTables(spark, SF_DIR)
    rejected = ingest.capacity_json_rejects(t)
    assert {r.reason for r in rejected.select("reason").distinct().collect()} == {"no JSON"}
    good = t.capacity_json.join(rejected.select("plan_id"), "plan_id", "left_anti")
    assert good.count() + rejected.count() == t.capacity_json.count()
    bad = t.replace(capacity_json=spark.createDataFrame([(1, 1, 8000, "[1, 2", "{}"), (2, 1, 8000, "[1]", "[]"), (3, 1, 8000, None, "{}"), (4, 1, 8000, "[1]", '{"1":[]}'), (5, 1, 8000, '["x"]', "{}")],
                                                        "plan_id long, media_outlet_id int, period_id int, week_keys string, capacity_json string"))
    assert {r.plan_id: r.reason for r in ingest.capacity_json_rejects(bad).collect()} == {
        1: "week keys: no JSON", 2: "no object", 3: "week keys: no text", 5: "week keys: week that is no number"}


def test_rows_without_a_reach_type_stay(spark):
    t = BoundTables(spark, SF_DIR)
    rows = t.project_reach.select("project_id", "media_outlet_id").limit(3).withColumn("reach_type", F.lit(None).cast("string"))
    assert save.cascade_remove(t.replace(project_reach=rows))["project_reach"].count() == 3


def test_no_staged_column_is_lost(saved):
    """What is staged for a project or an episode week is in the saved rows, under the same name or its table's."""
    t, out = saved
    renamed = {"uid": "plan_id", "target_reach": "target_reach_pct"}
    for staged, table in ((t.stg_plan_project, "plan_project"), (t.stg_episode_map, "plan_project_spots_episode_map"), (t.stg_spots, "plan_project_spots")):
        assert {renamed.get(c, c) for c in staged.columns} <= set(out[table].columns)
    rows = save.decide_version(t).select("uid", "plan_id", "plan_version_id").join(t.stg_plan_project, "uid")
    kept = ["user_comment", "no_of_episode", "on_map_premiere", "planned_spots", "guide_reach_pct", "guide_grp", "guide_spots", "on_map_start_ts", "segment_mask"]
    key = ["plan_id", "plan_version_id", "project_id"]
    assert rows.select(*key, *kept).exceptAll(out["plan_project"].select(*key, *kept)).count() == 0


def test_cascade_keeps_most_rows(saved):
    t, out = saved
    for name in ("schedule_episode", "campaign_goal", "campaign_goal_episode", "project_reach", "project_reach_episode"):
        assert 2 * out[name].count() > getattr(t, name).count(), name
