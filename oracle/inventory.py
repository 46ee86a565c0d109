from oracle.calendar import WEEKS

GRID = f"grid AS (SELECT p.plan_id, p.media_outlet_id, p.plan_type, p.period_id, w.week_no, w.week_start, w.week_end FROM {{plan}} p JOIN ({WEEKS}) w ON w.period_id = p.period_id)"
DAYS = f"days AS (SELECT p.plan_id, p.media_outlet_id, p.plan_type, d.start_date AS day FROM {{plan}} p JOIN ({WEEKS}) w ON w.period_id = p.period_id JOIN {{cal_period}} d ON d.period_type = 'D' AND d.start_date BETWEEN w.week_start AND w.week_end)"
FUTURE = "nxt AS (SELECT a.plan_id, b.plan_id AS future_plan_id FROM {plan} a JOIN {plan} b ON b.media_outlet_id = a.media_outlet_id AND b.plan_type = a.plan_type AND b.period_id = a.period_id + 1)"
SPOTS = "spots AS (SELECT plan_id, start_date, daypart_id, planned_units, planned_grp FROM {schedule} UNION ALL SELECT plan_id, start_date, daypart_id, planned_units, planned_grp FROM {schedule_episode})"


def capacity(grp: bool) -> str:
    value = "sum(g.grp_capacity)" if grp else "CAST(sum(c.capacity_per_hour) AS BIGINT)"
    join = """LEFT JOIN {capacity_grp} g ON g.capacity_id = c.capacity_id
        AND g.demo_id = (SELECT min(demo_id) FROM {outlet_demo} o WHERE o.media_outlet_id = grid.media_outlet_id AND o.default_yn = 'Y')""" if grp else ""
    return f"""WITH {GRID}
        SELECT grid.plan_id, grid.week_no, grid.week_start, {value} AS capacity
        FROM grid LEFT JOIN {{capacity}} c ON c.media_outlet_id = grid.media_outlet_id AND c.plan_type = 1
             AND c.start_date BETWEEN grid.week_start AND grid.week_end {join}
        WHERE grid.plan_type = 1 GROUP BY ALL"""


def use(ahead: bool, grp: bool, where: str) -> str:
    value = "coalesce(sum(s.planned_grp), 0)" if grp else "CAST(coalesce(sum(s.planned_units), 0) AS BIGINT)"
    source = "n.future_plan_id" if ahead else "grid.plan_id"
    join = "LEFT JOIN nxt n ON n.plan_id = grid.plan_id" if ahead else ""
    return f"""WITH {GRID}, {FUTURE}, {SPOTS}
        SELECT grid.plan_id, grid.week_no, grid.week_start, {value} AS units
        FROM grid {join} LEFT JOIN spots s ON s.plan_id = {source} AND s.start_date BETWEEN grid.week_start AND grid.week_end
        {where} GROUP BY ALL"""


def future_days(table: str, value: str) -> str:
    return f"""SELECT days.plan_id, days.day, {value} AS units FROM days LEFT JOIN nxt n ON n.plan_id = days.plan_id
        LEFT JOIN {table} s ON s.plan_id = n.future_plan_id AND s.start_date = days.day GROUP BY ALL"""


def future_daypart(table: str, value: str) -> str:
    return f"""SELECT n.plan_id, s.start_date AS day, s.daypart_id, d.name AS daypart, {value} AS units
        FROM nxt n JOIN {table} s ON s.plan_id = n.future_plan_id JOIN {{daypart}} d ON d.daypart_id = s.daypart_id AND d.active_yn = 'Y'
        GROUP BY ALL"""


UNITS0 = "CAST(coalesce(sum(s.planned_units), 0) AS BIGINT)"

SQL = {
    "quarterly_capacity": capacity(False),
    "quarterly_capacity_grp": capacity(True),
    "quarterly_future_units": use(True, False, ""),
    "weekly_day_capacity": f"""WITH {DAYS}
        SELECT days.plan_id, days.day, CAST(sum(c.capacity_per_hour) AS BIGINT) AS capacity
        FROM days JOIN {{capacity}} c ON c.media_outlet_id = days.media_outlet_id AND c.plan_type = days.plan_type AND c.start_date = days.day
        GROUP BY ALL""",
    "weekly_day_capacity_grp": f"""WITH {DAYS}
        SELECT days.plan_id, days.day, sum(g.grp_capacity) AS capacity
        FROM days JOIN {{capacity}} c ON c.media_outlet_id = days.media_outlet_id AND c.plan_type = days.plan_type AND c.start_date = days.day
        JOIN {{outlet_demo}} o ON o.media_outlet_id = days.media_outlet_id AND o.default_yn = 'Y'
        JOIN {{capacity_grp}} g ON g.capacity_id = c.capacity_id AND g.demo_id = o.demo_id
        GROUP BY ALL""",
    "weekly_future_units": f"""WITH {DAYS}, {FUTURE}
        SELECT *, 'launch' AS phase FROM ({future_days('{schedule}', UNITS0)})
        UNION ALL SELECT *, 'episode' FROM ({future_days('{schedule_episode}', UNITS0)})""",
    "weekly_episode_future_units": f"WITH {DAYS}, {FUTURE} " + future_days("{schedule_episode}", "coalesce(sum(s.planned_grp), 0)"),
    "daily_daypart_capacity": f"""WITH {DAYS}
        SELECT DISTINCT days.plan_id, days.day, c.daypart_id, d.name AS daypart, c.capacity_per_hour AS capacity
        FROM days JOIN {{capacity}} c ON c.media_outlet_id = days.media_outlet_id AND c.plan_type = days.plan_type AND c.start_date = days.day
        JOIN {{daypart}} d ON d.daypart_id = c.daypart_id AND d.active_yn = 'Y'""",
    "daily_future_by_daypart": f"WITH {FUTURE}, {SPOTS} " + future_daypart("spots", "sum(s.planned_grp)"),
    "daily_episode_future": f"WITH {FUTURE} " + future_daypart("{schedule_episode}", "CAST(sum(s.planned_units) AS BIGINT)"),
    "cumulative_delivery": """
        SELECT plan_id, project_id, CAST(sum(planned_units) AS BIGINT) AS units, 'launch' AS phase
        FROM {schedule} WHERE start_date <= DATE '1998-06-17' GROUP BY ALL
        UNION ALL
        SELECT plan_id, project_id, CAST(sum(planned_units) AS BIGINT), 'episode'
        FROM {schedule_episode} WHERE start_date <= DATE '1998-06-17' GROUP BY ALL""",
    "inventory_capacity": capacity(False),
    "utilized_inventory": use(False, True, "WHERE grid.plan_type = 1"),
    "future_quarter_spots": use(True, False, "WHERE grid.plan_type = 1"),
}
