"""Hand-computed cases."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from spotgrid.functions import columns as col
from spotgrid.operators import choices, distribute, inventory, prepare, reach, save, validate
from spotgrid.plans import calendar as cal
from spotgrid.plans import context
from spotgrid.plans.calendar import quarter_weeks
from spotgrid.sources.tables import Tables
from tests.conftest import day

OVERLAP = "call_id bigint, project_id bigint, calc_based_on string, qtr_start date, spot_result bigint, week_date date, days_in_week int, total_days int"


def overlap(spark, units, days, mode="R"):
    q, total = day("2024-01-01"), sum(days)
    rows = [(1, 7, mode, q, units, q + dt.timedelta(days=7 * i), d, total) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, OVERLAP)


def units(df):
    return [r.unit_count for r in df.orderBy("week_date").collect()]


def test_carry_gives_the_rest_to_the_last_week(spark):
    assert units(distribute.distribute_carry(overlap(spark, 10, [4, 7, 3]))) == [2, 5, 3]


def test_proportional_rounds_each_week_down(spark):
    assert units(distribute.distribute_proportional(overlap(spark, 10, [4, 7, 3]))) == [2, 5, 2]


@pytest.mark.parametrize("split", [distribute.distribute_carry, distribute.distribute_proportional])
def test_weekly_modes_repeat_the_count(spark, split):
    assert units(split(overlap(spark, 10, [4, 7, 3], "EG"))) == [10, 10, 10]


def test_negative_units_become_zero(spark):
    assert units(distribute.distribute_proportional(overlap(spark, -5, [7, 7]))) == [0, 0]


@pytest.mark.parametrize("days, weeks", [(0, 1), (14, 2), (15, 3), (7, 1)])
def test_flight_weeks(spark, days, weeks):
    start = day("2024-05-01")
    df = spark.createDataFrame([(start, start + dt.timedelta(days=days))], "s date, e date")
    assert df.select(col.flight_weeks(F.col("s"), F.col("e"))).first()[0] == weeks


def test_clock_offsets(spark):
    df = spark.createDataFrame([("30:00:00",), ("06:30:15",)], "t string")
    got = [r[0] for r in df.select(col.time_to_offset(F.col("t"))).collect()]
    assert got == [108000, 23415]
    back = [r[0] for r in df.select(col.offset_to_time(col.time_to_offset(F.col("t")))).collect()]
    assert back == ["30:00:00", "06:30:15"]


def test_monday(spark):
    df = spark.createDataFrame([(day("2024-05-19"),), (day("2024-05-20"),)], "d date")
    assert [r[0] for r in df.select(col.monday_of(F.col("d"))).collect()] == [day("2024-05-13"), day("2024-05-20")]


def test_quarter_weeks_hold_two_quarters(calendar):
    weeks = cal.quarter_weeks(calendar).where("period_id = 101").orderBy("week_no").collect()
    assert [w.week_no for w in weeks] == list(range(1, 27))
    assert weeks[0].week_start == day("2024-04-01") and weeks[-1].week_end == day("2024-09-29")


def test_quarter_window_goes_back_and_ahead(calendar):
    names = {r.name for r in cal.quarter_window(calendar, day("2024-05-15"), back_days=95, ahead=1).collect()}
    assert names == {"1Q24", "2Q24", "3Q24"}


# --- reach guide -------------------------------------------------------------------------

REQUEST = ("call_id bigint, project_id bigint, media_outlet_id int, calc_based_on string, target_reach_pct decimal(18,2), target_grps decimal(18,2), "
           "planned_spot int, flight_start date, flight_end date, qtr_start date, reach_id bigint, segment_id int, frequency int, flight_week_count int, week_count int, available_units int")
GUIDE = "reach_id bigint, segment_id int, week_count int, frequency int, unit_count int, reach_pct decimal(18,2), cov_grp decimal(18,2), grp decimal(18,2)"


def estimate(spark, mode, reach_pct=None, grps=None, spots=None, curve=((10, 30, 100), (20, 50, 180))):
    d = day("2024-01-01")
    asked = spark.createDataFrame([(1, 7, 3, mode, D(reach_pct) if reach_pct is not None else None, D(grps) if grps is not None else None, spots,
                                    d, d, d, 9, 1, 1, 1, 1, 20)], REQUEST)
    guide = spark.createDataFrame([(9, 1, 1, 1, u, D(r), D(0), D(g)) for u, r, g in curve], GUIDE)
    return reach.interpolate(reach.bracket(asked, guide)).select("spot_result", "reach_pct_result", "grps_result").first()


def test_reach_between_two_points(spark):
    assert tuple(estimate(spark, "R", reach_pct=40)) == (15, D("40.00"), D("140.0"))


def test_points_between_two_points(spark):
    assert tuple(estimate(spark, "G", grps=140)) == (15, D("40.00"), D("140.0"))


def test_spots_between_two_points(spark):
    assert tuple(estimate(spark, "S", spots=15)) == (15, D("40.00"), D("140.0"))


def test_weekly_reach_rounds_points_to_whole(spark):
    assert tuple(estimate(spark, "ER", reach_pct=31)) == (11, D("31.00"), D("104.0"))


def test_target_above_the_curve_takes_the_largest_point(spark):
    assert tuple(estimate(spark, "R", reach_pct=90)) == (20, D("50.00"), D("180.0"))


def test_target_on_a_point_takes_that_point(spark):
    assert tuple(estimate(spark, "G", grps=100)) == (10, D("30.00"), D("100.0"))


def test_target_below_the_curve_starts_from_zero(spark):
    assert tuple(estimate(spark, "R", reach_pct=15)) == (5, D("15.00"), D("50.0"))


def test_flat_curve_takes_its_lower_point(spark):
    got = estimate(spark, "R", reach_pct=30, curve=((10, 30, 100), (20, 30, 180)))
    assert got.reach_pct_result == D("30.00") and got.spot_result in (10, 20)


def test_saved_episode_spots_mode_has_no_estimate(spark):
    assert tuple(estimate(spark, "ES", spots=15)) == (None, None, None)


# --- preparation -----------------------------------------------------------------------------

WINDOW = ("plan_id bigint, plan_version_id bigint, project_id bigint, status_cd int, cluster_id int, on_map_start date, on_map_end date, "
          "measured_start date, measured_end date")


def window(spark, rows, measured="2024-05-15"):
    frame = spark.createDataFrame(rows, WINDOW)
    versions = frame.groupBy("plan_id").agg(F.max("plan_version_id").alias("plan_version_id"))
    r = prepare.measurement_window(frame, versions, day(measured), ["project_id"]).first()
    return r.measured_start, r.measured_end


def test_measurement_end_is_the_last_same_weekday(spark):
    got = window(spark, [(1, 0, 7, 9, 1, day("2024-05-06"), day("2024-05-18"), None, None)])
    assert got == (day("2024-04-29"), day("2024-05-11"))


def test_measurement_end_on_the_measured_weekday(spark):
    assert window(spark, [(1, 0, 7, 9, 1, day("2024-05-15"), day("2024-05-22"), None, None)])[1] == day("2024-05-15")


def test_running_flight_inherits_the_previous_window(spark):
    rows = [(1, 0, 7, 9, 1, day("2024-05-06"), day("2024-05-18"), day("2024-03-04"), day("2024-03-16")),
            (1, 1, 7, 9, 1, day("2024-05-06"), day("2024-05-18"), None, None)]
    assert window(spark, rows) == (day("2024-03-04"), day("2024-03-16"))


def test_changed_cluster_flight_loses_the_inherited_window(spark):
    rows = [(1, 0, 7, 9, 2, day("2024-05-06"), day("2024-05-18"), day("2024-03-04"), day("2024-03-16")),
            (1, 1, 7, 11, 2, day("2024-05-06"), day("2024-05-25"), None, None)]
    assert window(spark, rows) == (day("2024-04-22"), day("2024-05-11"))


# --- save -------------------------------------------------------------------------------------

def save_tables(spark, status, versions):
    plans = [(101, 3, 100, 1, "Map-v1", status, "Y", "Y", "c", None, None, 5)] if status is not None else [(77, 9, 100, 1, "x", 0, "Y", "Y", None, None, None, 5)]
    return Tables(spark, overrides={
        "plan": spark.createDataFrame(plans, "plan_id bigint, media_outlet_id int, period_id int, plan_type int, name string, plan_status_id int, "
                                             "active_yn string, checked_yn string, comments string, create_ts timestamp, update_ts timestamp, update_user bigint"),
        "plan_version": spark.createDataFrame([(101, v, 1, 50 + v) for v in versions],
                                              "plan_id bigint, plan_version_id bigint, optimization_type int, model_exec_id bigint"),
        "save_request": spark.createDataFrame([(1, 3, 100, 1, "Map-v9", 8, 0)], "uid bigint, media_outlet_id int, period_id int, plan_type int, "
                                                                               "map_name string, user_id bigint, optimization_type int"),
    })


@pytest.mark.parametrize("status, versions, want", [
    (3, [], 0), (0, [0, 1], 1), (7, [0, 1, 2], 2), (3, [0, 1], 2), (2, [4], 5)])
def test_version_decision(spark, status, versions, want):
    assert save.decide_version(save_tables(spark, status, versions)).first().plan_version_id == want


def test_new_plan_gets_the_next_id_and_first_version(spark):
    row = save.decide_version(save_tables(spark, None, [])).first()
    assert (row.plan_id, row.plan_version_id, row.is_new) == (78, 0, True)


def test_saved_plan_is_renamed_and_back_in_draft(spark):
    t = save_tables(spark, 3, [0, 1])
    row = save.saved_plans(t, dt.datetime(2024, 5, 1)).where("plan_id = 101").first()
    assert (row.name, row.plan_status_id, row.comments, row.update_user) == ("Map-v3", 0, None, 8)


def test_episode_json_is_flattened_and_filtered(spark):
    text = ('[{"PROJECT_ID":5,"EPISODE_NUM":2,"TARGET_GRP":7.5,"TARGET_SPOT":4,"START_TS":"2024-05-01","END_TS":"2024-05-03",'
            '"EPISODE_START_TS":"2024-05-03 20:00:00","chkSelectRow":true},{"PROJECT_ID":5,"EPISODE_NUM":3,"chkSelectRow":false}]')
    df = spark.createDataFrame([(1, 0, text)], "plan_id bigint, plan_version_id bigint, episode_dtl_json string")
    rows = save.flatten_episode_json(df).collect()
    assert [(r.project_id, r.episode_id, r.target_grp, r.start_date) for r in rows] == [(5, 2, D("7.50"), day("2024-05-01"))]
    assert save.flatten_episode_json(df, only_selected=False).count() == 2


# --- context and reports ------------------------------------------------------------------------

def test_episode_label_beats_launch_label(spark):
    pp = spark.createDataFrame([(1, 4, 7, "Y"), (1, 2, 7, "Y")], "plan_id bigint, plan_version_id bigint, project_id bigint, optimize_yn string")
    ppe = spark.createDataFrame([(1, 2, 7, "Y")], pp.schema)
    runs = spark.createDataFrame([(1, 4, "C", dt.datetime(2024, 1, 2, 15, 5)), (1, 2, "C", dt.datetime(2024, 1, 1, 9, 30))],
                                 "plan_id bigint, plan_version_id bigint, exec_status_cd string, exec_end_ts timestamp")
    members = spark.createDataFrame([(1, 1, 7)], "map_plan_id bigint, plan_id bigint, project_id bigint")
    assert context.last_opt_label(members, pp, ppe, runs).first().last_opt_version_ts == "v3 01/01/2024 09:30 AM"
    assert context.last_opt_label(members, pp, ppe.limit(0), runs).first().last_opt_version_ts == "v5 01/02/2024 03:05 PM"


def test_equal_launch_and_episode_totals_stay_apart(spark, calendar):
    facts = "plan_id bigint, media_outlet_id int, project_id bigint, daypart_id int, start_date date, planned_units bigint, planned_grp decimal(18,2)"
    row = [(2, 3, 7, 1, day("2024-04-03"), 5, D(1))]
    t = Tables(spark, overrides={
        "cal_period": calendar, "schedule": spark.createDataFrame(row, facts), "schedule_episode": spark.createDataFrame(row, facts),
        "plan": spark.createDataFrame([(1, 3, 100, 1, "Y"), (2, 3, 101, 1, "Y")],
                                      "plan_id bigint, media_outlet_id int, period_id int, plan_type int, active_yn string")})
    got = inventory.weekly_future_units(t).where("plan_id = 1 and units > 0").collect()
    assert sorted((r.phase, r.units) for r in got) == [("episode", 5), ("launch", 5)]


def cap(spark, week, start, end, opens=21600, closes=108000):
    df = spark.createDataFrame([(day(week), day(start), day(end), opens, closes, D(2), D(48))],
                               "week_date date, on_map_start date, on_map_end date, start_offset int, end_offset int, per_hour_spots decimal(9,2), daily_spots decimal(18,0)")
    return df.select(validate.weekly_cap()).first()[0]


@pytest.mark.parametrize("week, start, end, want", [
    ("2024-05-13", "2024-05-13", "2024-05-13", 48),                # one day: 24 hours of 2 spots
    ("2024-05-13", "2024-05-13", "2024-05-14", 96),                # two days: edges only
    ("2024-05-13", "2024-05-15", "2024-05-30", 36 + 4 * 48),       # starts inside: 18 hours, then days to week end
    ("2024-05-13", "2024-05-14", "2024-05-17", 36 + 60 + 2 * 48),  # inside one week: edges and the days between
    ("2024-05-20", "2024-05-15", "2024-05-30", 7 * 48),            # whole week
    ("2024-05-27", "2024-05-15", "2024-05-30", 60 + 3 * 48),       # ends inside: 30 hours, then days since Monday
])
def test_weekly_cap(spark, week, start, end, want):
    assert cap(spark, week, start, end) == D(want)


def test_missing_set_up_is_reported_per_outlet_and_quarter(spark, calendar):
    outlet = "media_outlet_id int"
    t = Tables(spark, overrides={
        "cal_period": calendar,
        "plan": spark.createDataFrame([(1, 100), (1, 101), (2, 100)], f"{outlet}, period_id int"),
        "daypart": spark.createDataFrame([(1, "Y", 0), (2, "N", 0)], f"{outlet}, active_yn string, start_offset int"),
        "spots_per_hour": spark.createDataFrame([(2,)], outlet),
        "capacity": spark.createDataFrame([(1, 1, day("2024-01-05"), day("2024-01-05"))], f"{outlet}, plan_type int, start_date date, end_date date"),
        "map_validation": spark.createDataFrame([(1, "dayparts"), (2, "capacity"), (3, "spots")], "validation_id int, validation_message string"),
    })
    got = sorted((r.media_outlet_id, r.period_id, r.validation_message) for r in choices.network_config_errors(t).collect())
    assert got == [(1, 100, "spots"), (1, 101, "capacity"), (1, 101, "spots"), (2, 100, "capacity"), (2, 100, "dayparts")]


# --- calendar, reach requests and guide windows ---------------------------------------------------

def test_a_map_of_27_weeks_keeps_its_last_week(spark):
    """A quarter of 14 weeks followed by one of 13: nothing is cut off."""
    monday, rows = day("2024-01-01"), []
    for q, (first, n) in enumerate(((0, 14), (14, 13))):
        start = monday + dt.timedelta(days=7 * first)
        rows.append((100 + q, "Q", f"{q + 1}Q24", f"{q + 1}Q24", start, start + dt.timedelta(days=7 * n - 1)))
        rows += [(1000 + first + w, "W", "w", f"{q + 1}Q24", start + dt.timedelta(days=7 * w), start + dt.timedelta(days=7 * w + 6)) for w in range(n)]
    cal = spark.createDataFrame(rows, "period_id int, period_type string, name string, fiscal_qtr string, start_date date, end_date date")
    assert quarter_weeks(cal).where("period_id = 100").agg({"week_no": "max"}).first()[0] == 27


def requests(spark, calendar, ends):
    rows = [(i, 7, 3, 1, 4, 1, "R", D(5), None, None, day("2024-01-01"), end, day("2024-01-01")) for i, end in enumerate(ends)]
    return Tables(spark, overrides={
        "cal_period": calendar,
        "project": spark.createDataFrame([(7, 3, 4)], "project_id bigint, media_outlet_id int, target_segment int"),
        "segment": spark.createDataFrame([(4, 8)], "segment_id int, mask bigint"),
        "reach_request": spark.createDataFrame(rows, "call_id bigint, project_id bigint, media_outlet_id int, demo_id int, segment_id int, frequency int, "
                                               "calc_based_on string, target_reach_pct decimal(18,2), target_grps decimal(18,2), planned_spot int, "
                                               "flight_start date, flight_end date, qtr_start date")})


@pytest.mark.parametrize("as_of, want", [("2024-06-05", [1, 2]), ("1990-01-01", [0, 1, 2])])
def test_only_flights_that_have_ended_leave(spark, calendar, as_of, want):
    """Outside the calendar there is no current week, and a flight without an end hasn't ended."""
    t = requests(spark, calendar, [day("2024-06-02"), day("2024-06-03"), None])
    assert sorted(r.call_id for r in reach.flight_profile(t, day(as_of)).collect()) == want


def test_long_flights_keep_their_weeks(spark, calendar):
    t = requests(spark, calendar, [day("2024-12-29")])
    assert reach.flight_profile(t, day("2024-06-05")).first().flight_week_count == 52


def test_windows_of_one_start_are_not_summed_together(spark):
    detail = [(9, 1, 1, 1, 10, day("2024-01-01"), day(end), 10, 100, 500, D(1)) for end in ("2024-01-07", "2024-01-14")]
    t = Tables(spark, overrides={
        "reach_header": spark.createDataFrame([(9, 2)], "reach_id bigint, target_demo_id int"),
        "demo": spark.createDataFrame([(2, 1000)], "demo_id int, universe bigint"),
        "segment_component": spark.createDataFrame([(1, 1)], "segment_id int, component_segment_id int"),
        "reach_detail": spark.createDataFrame(detail, "reach_id bigint, segment_id int, week_count int, frequency int, unit_count int, start_date date, "
                                              "end_date date, reach bigint, universe bigint, impressions bigint, cov_grp decimal(18,2)")})
    assert reach.build_reach_guide(t).first().grp == D("50.00")
