"""Properties that hold for any input, and helpers against brute force."""

import datetime as dt
import random
from types import SimpleNamespace

import pytest

from pyspark.sql import functions as F

from spotgrid import catalog
from spotgrid.functions import columns, joins
from spotgrid.operators import details, distribute, popup, reach, save
from spotgrid.sources.shared import shared_folder, stage
from spotgrid.sources.tables import BoundTables, Tables

SF_DIR = "/root/testdata/sf0.001"
NOON = dt.datetime(1998, 6, 17, 12)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_carry_hands_out_every_unit_of_flights_inside_their_weeks(spark):
    t = BoundTables(spark, SF_DIR)
    estimates = reach.reach_estimates(t, catalog.AS_OF)
    overlap = distribute.week_overlap(estimates, t.cal_period).where(~F.col("calc_based_on").isin("ER", "EG"))
    whole = overlap.groupBy("call_id", "project_id", "spot_result", "total_days").agg(F.sum("days_in_week").alias("d")).where(
        "d = total_days and spot_result is not null")
    handed = distribute.distribute_carry(overlap).groupBy("call_id", "project_id").agg(F.sum("unit_count").alias("given"))
    both = whole.join(handed, ["call_id", "project_id"])
    assert both.count() > 0
    assert both.where("given <> spot_result").count() == 0


def test_estimates_stay_inside_their_bracket(spark):
    t = BoundTables(spark, SF_DIR)
    brackets = reach.reach_brackets(t, catalog.AS_OF).where(
        "calc_based_on in ('R', 'G', 'ER', 'EG') and upper_unit_count > lower_unit_count")
    got = reach.interpolate(brackets).join(brackets.select("call_id", "project_id", "lower_unit_count", "upper_unit_count"), ["call_id", "project_id"])
    assert got.where("spot_result < lower_unit_count or spot_result > upper_unit_count").count() == 0


def test_popup_totals_equal_their_detail(spark):
    grid = popup.project_popup_grid(BoundTables(spark, SF_DIR)).cache()
    sums = {r.data_type: (r.u, r.g) for r in grid.groupBy("data_type").agg(F.sum("planned_units").alias("u"), F.sum("planned_grp").alias("g")).collect()}
    detail = tuple(a + b for a, b in zip(sums[1], sums[2]))
    assert sums[3] == detail and sums[4] == detail
    grid.unpersist()


def test_saving_twice_changes_nothing_more(spark):
    t = BoundTables(spark, SF_DIR)
    once = t.replace(plan=stage(spark, save.saved_plans(t, NOON), "plan"), plan_version=stage(spark, save.saved_versions(t, NOON), "versions"),
                     plan_project_spots=stage(spark, save.upsert_spots(t), "spots"))
    # After the save every plan is a draft, so a second save reuses its version.
    again = save.decide_version(once).select("uid", "plan_id", "plan_version_id", "version_action").collect()
    assert {r.version_action for r in again} == {"reuse"}
    first = {(r.uid, r.plan_id, r.plan_version_id) for r in save.decide_version(t).collect()}
    assert first == {(r.uid, r.plan_id, r.plan_version_id) for r in again}


def test_removed_projects_leave_no_rows_behind(spark):
    t = BoundTables(spark, SF_DIR)
    left = save.cascade_remove(t)
    launch = save.removed_projects(t).select("project_id", "media_outlet_id")
    for name in ("campaign_goal", "campaign_goal_episode"):
        assert left[name].join(launch, ["project_id", "media_outlet_id"], "left_semi").count() == 0
    gone = save.removed_projects(t).select("plan_id", "project_id", (F.col("saved_version") - 1).alias("plan_version_id"))
    assert gone.count() > 0
    assert save.upsert_plan_projects(t, NOON).join(gone, ["plan_id", "project_id", "plan_version_id"], "left_semi").count() == 0


def test_launch_schedule_is_cleaned_only_on_request(spark):
    t = BoundTables(spark, SF_DIR)
    assert "schedule" not in save.cascade_remove(t)
    assert "schedule" in save.cascade_remove(t, clean_schedule=True)


def test_snapshot_merge_keeps_replaces_and_adds(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert rows(joins.snapshot_merge(old, new, ["k"]), "k", "v") == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(joins.replace_groups(old, new, spark.createDataFrame([(1,)], "k int"), ["k"]), "k", "v") == [(2, "B"), (2, "b"), (3, "C")]


def test_assigned_ids_are_dense_and_follow_the_largest(spark):
    keys = random.Random(3).sample(range(10_000), 500)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = joins.assign_ids(df, "id", "k", spark.createDataFrame([(41,)], "id bigint"))
    assert sorted(r.id for r in got.collect()) == list(range(42, 542))
    want = {k: 42 + i for i, k in enumerate(sorted(keys))}
    assert {r.k: r.id for r in got.collect()} == want


def test_a_hole_in_the_quarters_fails_and_is_named(spark, calendar):
    from spotgrid.plans import calendar as plans_calendar, context

    plan = spark.createDataFrame([(7, 1, 1, 101, "Y"), (8, 1, 1, 102, "Y")], "plan_id int, media_outlet_id int, plan_type int, period_id int, active_yn string")
    assert plans_calendar.adjacent_quarter(calendar, 1).count() == 3
    assert [tuple(r) for r in context.past_plan(plan, calendar).collect()] == [(8, 7)]
    holed = calendar.where("period_id not in (101, 102)")
    for frame in (plans_calendar.adjacent_quarter(holed, 1), context.past_plan(plan, holed), context.future_plan(plan, holed)):
        with pytest.raises(Exception, match="no quarter with id 101, 102"):
            frame.collect()


def test_time_bands_by_weekday_keep_their_seconds(spark):
    rng = random.Random(9)
    bands = [(i, 4, s, s + rng.randint(-100, 100_000), rng.randint(0, 127)) for i in range(40) for s in [rng.randint(0, 100_000)]]
    t = BoundTables(spark, SF_DIR).replace(
        episode_timeband=spark.createDataFrame(bands, "constraint_id long, constraint_type_id int, start_offset int, end_offset int, days_mask int"),
        episode_constraint=spark.createDataFrame([(i, 1, 4, i) for i in range(40)], "project_id long, episode_id int, constraint_type_id int, constraint_key long"))
    found = details.episode_timeband_days(t).collect()
    assert all(0 <= r.start_second < r.end_second <= 86400 and 1 <= r.weekday <= 7 for r in found)
    for i, _, start, end, mask in bands:
        pieces = [r for r in found if r.constraint_id == i]
        assert {r.band_weekday for r in pieces} == ({d + 1 for d in range(7) if mask >> d & 1} if end > start else set())
        for day in {r.band_weekday for r in pieces}:
            own = [r for r in pieces if r.band_weekday == day]
            assert sum(r.end_second - r.start_second for r in own) == end - start
            assert sorted((r.weekday - day) % 7 * 86400 + r.start_second for r in own)[0] == start


def test_greatest_of_an_unknown_date_is_unknown(spark):
    row = spark.sql("SELECT 1 AS a, CAST(NULL AS INT) AS b, 3 AS c").select(columns.greatest_known("a", "b").alias("x"), columns.greatest_known("a", "c").alias("y")).first()
    assert tuple(row) == (None, 3)


def test_popup_totals_need_no_expand(spark):
    plan = popup.project_popup_grid(BoundTables(spark, SF_DIR))._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_conditional_key_joins_equal_brute_force(spark):
    rng = random.Random(5)
    left = [(rng.choice([1, 2]), rng.randint(1, 4), rng.choice([None, 10, 11, 12]), i) for i in range(30)]
    right = [(rng.choice([1, 2]), rng.randint(1, 4), rng.choice([None, 10, 11, 13]), 100 + i) for i in range(20)]
    ldf = spark.createDataFrame(left, "m int, p int, g int, a int")
    rdf = spark.createDataFrame(right, "m int, p int, g int, b int")

    def brute(match):
        out = []
        for x in left:
            hits = [r[3] for r in right if match(x, r)]
            out += [(x[3], b) for b in hits] or [(x[3], None)]
        return sorted(out, key=str)

    by_left = brute(lambda x, r: x[0] == r[0] and (x[1] == r[1] if x[2] is None else x[2] == r[2]))
    assert rows(joins.match_left_null(ldf, rdf, "g", ["p"], ["m"]), "a", "b") == by_left
    by_right = brute(lambda x, r: x[0] == r[0] and (x[1] == r[1] if r[2] is None else x[2] == r[2]))
    assert rows(joins.match_right_null(ldf, rdf, "g", "p", ["m"]), "a", "b") == by_right


@pytest.mark.parametrize("split", [100_000, 3])
def test_as_of_join_equals_all_points(spark, split):
    rng = random.Random(7)
    points = [(rng.choice([1, 2, None]), rng.choice([rng.randint(0, 12), None]), rng.randint(0, 50)) for _ in range(60)]
    asks = [(i, rng.choice([1, 1, 1, 2, 3, None]), rng.choice([rng.randint(-2, 14), None])) for i in range(50)]
    got = joins.as_of(spark.createDataFrame(asks, "i int, k int, at int"), spark.createDataFrame(points, "k int, at int, v int"), ["k"], "at", "v", ["i"], split)
    expected = []
    for i, k, at in asks:
        same = [(a, v) for kk, a, v in points if None not in (k, at, a) and kk == k]
        expected.append((i, max((v for a, v in same if a <= at), default=None), min((v for a, v in same if a >= at), default=None)))
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_as_of_join_never_meets_points_one_by_one(spark):
    points = spark.range(500).select(F.lit(1).alias("k"), F.col("id").alias("at"), F.col("id").alias("v"))
    asks = spark.range(400).select(F.col("id").alias("i"), F.lit(1).alias("k"), F.col("id").alias("at"))
    assert joins.as_of_lines(asks, points, ["k"], "at", "v", ["i"], 1000).count() == 900
    # A key with very many asks is dealt to lines of its own.
    assert joins.as_of_lines(asks, points, ["k"], "at", "v", ["i"], 100).groupBy("_deal").count().count() == 4


def test_period_join_equals_between(spark, calendar):
    days = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=5 * i),) for i in range(90)], "d date")
    got = joins.join_on_period(days, "d", calendar, "W").select("d", "period_start")
    weeks = [(r.start_date, r.end_date) for r in calendar.where("period_type = 'W'").collect()]
    want = sorted((r.d, next(s for s, e in weeks if s <= r.d <= e)) for r in days.collect() if any(s <= r.d <= e for s, e in weeks))
    assert sorted((r.d, r.period_start) for r in got.collect()) == want


def test_hot_project_with_a_third_of_all_spots(spark):
    """One project repeated until it holds a third of the schedule: sums scale by exactly the copies."""
    t = BoundTables(spark, SF_DIR)
    hot = t.schedule.groupBy("project_id").count().orderBy(F.desc("count"), "project_id").first().project_id
    copies = t.schedule.where(F.col("project_id") == hot).withColumn("c", F.explode(F.sequence(F.lit(1), F.lit(4)))).drop("c")
    skewed = t.replace(schedule=t.schedule.unionByName(copies))
    assert skewed.schedule.where(F.col("project_id") == hot).count() * 3 > skewed.schedule.count()
    from spotgrid.operators import grids

    key = ["map_plan_id", "plan_id", "project_id", "week_start_date"]
    plain = grids.quarterly_projects(t).select(*key, F.col("planned_units").alias("a"))
    grown = grids.quarterly_projects(skewed).select(*key, F.col("planned_units").alias("b"))
    both = plain.join(grown, key, "full")
    factor = F.when(F.col("project_id") == hot, 5).otherwise(1)
    assert both.where(~F.col("a").eqNullSafe(F.col("b")) & (F.coalesce(F.col("a") * factor, F.lit(0)) != F.coalesce("b", F.lit(0)))).count() == 0


def session_like(master, **conf):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}", getConf=lambda: SimpleNamespace(get=conf.get))
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=context)


def test_shared_folder_is_the_one_the_session_names():
    named = {"spark.checkpoint.dir": "hdfs://shared/work"}
    assert shared_folder(session_like("yarn", **named)) == "hdfs://shared/work"
    assert shared_folder(session_like("local[2]", **named)) == "hdfs://shared/work"


def test_cluster_without_shared_folder_is_refused():
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session_like(master))
    assert shared_folder(session_like("local[2]")) == shared_folder(session_like("local[2]"))


def test_staged_frame_reads_back_equal(spark):
    assert rows(stage(spark, spark.range(10), "numbers"), "id") == rows(spark.range(10), "id")


def test_tables_read_parquet_and_replace(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "plan"))
    t = Tables(spark, root=str(tmp_path))
    assert t.plan.count() == 3
    assert t.replace(plan=spark.range(5)).plan.count() == 5 and t.plan.count() == 3
