from oracle.calendar import WEEKS
from oracle.reports import RUN_VERSION, label, no_of_weeks

NEWEST = "newest AS (SELECT plan_id, max(plan_version_id) AS v FROM {plan_version} GROUP BY 1)"
MAPS = """maps AS (SELECT p.*, q.start_date AS qs, q.end_date AS qe, n.end_date AS ne FROM {plan} p
    JOIN {cal_period} q ON q.period_type = 'Q' AND q.period_id = p.period_id
    LEFT JOIN {cal_period} n ON n.period_type = 'Q' AND n.period_id = p.period_id + 1)"""


MAP_WEEKS = f"""mw AS (SELECT p.plan_id AS map_plan_id, p.media_outlet_id, p.plan_type, p.checked_yn, w.week_start, w.week_end, 'WEEK' || w.week_no AS wk, 'EP_Wek' || w.week_no AS ewk
        FROM {{plan}} p JOIN ({WEEKS}) w ON w.period_id = p.period_id)"""


EPISODE_MEMBERS = """cpf AS (
    SELECT m.plan_id AS map_plan_id, e.plan_id, e.project_id, e.episode_id, e.campaign_goal_id, e.episode_start_ts, e.on_map_start, e.on_map_end
    FROM maps m JOIN newest n ON n.plan_id = m.plan_id JOIN {plan_project_episode} e ON e.plan_id = m.plan_id AND e.plan_version_id = n.v
    UNION
    SELECT DISTINCT m.plan_id, e.plan_id, e.project_id, e.episode_id, e.campaign_goal_id, e.episode_start_ts, e.on_map_start, e.on_map_end
    FROM maps m JOIN {plan} p ON p.media_outlet_id = m.media_outlet_id AND p.plan_type = m.plan_type AND p.plan_id <> m.plan_id
    JOIN run_version r ON r.plan_id = p.plan_id
    JOIN {plan_project_episode} e ON e.plan_id = p.plan_id AND e.plan_version_id = r.v
    JOIN {schedule_episode} s ON s.plan_id = e.plan_id AND s.plan_version_id = 0 AND s.project_id = e.project_id AND s.episode_id = e.episode_id
        AND s.start_date BETWEEN m.qs AND coalesce(m.ne, m.qe)
    WHERE EXISTS (SELECT 1 FROM goals g WHERE g.map_plan_id = m.plan_id AND g.campaign_goal_id = e.campaign_goal_id)),
    """
GOALS2 = """goals AS (
    SELECT DISTINCT m.plan_id AS map_plan_id, s.campaign_goal_id FROM {schedule_episode} s
    JOIN (SELECT DISTINCT plan_id, episode_id, campaign_goal_id FROM {plan_project_episode}) e ON e.campaign_goal_id = s.campaign_goal_id AND e.episode_id = s.episode_id
    JOIN {plan} p ON p.plan_id = e.plan_id
    JOIN maps m ON m.media_outlet_id = p.media_outlet_id AND m.plan_type = p.plan_type AND s.start_date BETWEEN m.qs AND coalesce(m.ne, m.qe)),
    """
EPISODE_OUT = """SELECT c.map_plan_id, c.plan_id, c.project_id, c.episode_id, c.campaign_goal_id, strftime(c.episode_start_ts, '%m/%d/%Y %I:%M:%S %p') AS episode_start_ts,
    strftime(c.on_map_start, '%m/%d/%Y') AS start_ts_dis, strftime(c.on_map_end, '%m/%d/%Y') AS end_ts_dis, f.week_start, f.ewk AS week, f.units
    FROM cpf c """


def other_rows(table: str, value: str, keys: str, wk: str, late: str = "") -> str:
    return f"""SELECT w.map_plan_id, s.campaign_goal_id, {keys}, w.week_start, w.{wk}, {value} AS units
        FROM {table} s JOIN {{project}} pr ON pr.project_id = s.project_id
        JOIN mw w ON w.media_outlet_id = s.media_outlet_id AND w.plan_type = pr.project_type AND s.start_date BETWEEN w.week_start AND w.week_end AND s.plan_id <> w.map_plan_id
        {late} WHERE s.plan_version_id = 0 GROUP BY ALL"""


EKEYS = "s.project_id, s.episode_id"
SUM_UNITS = "CAST(sum(s.planned_units) AS BIGINT)"
STARTED = "JOIN maps mq ON mq.plan_id = w.map_plan_id AND pr.start_date <= mq.qe"

EPISODES_OPTIMISED = f"""WITH {RUN_VERSION}, {NEWEST}, {MAPS}, {MAP_WEEKS}, {GOALS2} {EPISODE_MEMBERS}
    fi AS (
        SELECT w.map_plan_id, s.campaign_goal_id, s.project_id, s.episode_id, w.week_start, w.ewk, {SUM_UNITS} AS units
        FROM {{schedule_episode}} s JOIN mw w ON w.map_plan_id = s.plan_id AND s.start_date BETWEEN w.week_start AND w.week_end
        JOIN newest n ON n.plan_id = s.plan_id
        JOIN {{plan_project_episode}} e ON e.plan_id = s.plan_id AND e.plan_version_id = n.v AND e.project_id = s.project_id AND e.episode_id = s.episode_id
        WHERE s.plan_version_id = 0 AND (w.checked_yn = 'N' OR e.status_cd IN (9, 10)) GROUP BY ALL
        UNION
        {other_rows('{schedule_episode}', SUM_UNITS, EKEYS, 'ewk')}
        UNION
        SELECT w.map_plan_id, NULL, s.project_id, s.episode_id, w.week_start, w.ewk, s.unit_count
        FROM {{plan_project_spots_episode}} s JOIN newest n ON n.plan_id = s.plan_id AND n.v = s.plan_version_id
        JOIN mw w ON w.map_plan_id = s.plan_id AND w.week_start = s.week_date
        JOIN {{plan_project_episode}} e ON e.plan_id = s.plan_id AND e.plan_version_id = s.plan_version_id AND e.project_id = s.project_id AND e.episode_id = s.episode_id
        WHERE e.status_cd NOT IN (9, 10))
    {EPISODE_OUT} LEFT JOIN fi f ON f.map_plan_id = c.map_plan_id AND f.project_id = c.project_id AND f.episode_id = c.episode_id WHERE c.campaign_goal_id IS NULL
    UNION ALL
    {EPISODE_OUT} LEFT JOIN fi f ON f.map_plan_id = c.map_plan_id AND f.campaign_goal_id = c.campaign_goal_id WHERE c.campaign_goal_id IS NOT NULL"""

EPISODES_SAVED = f"""WITH {RUN_VERSION}, {NEWEST}, {MAPS}, {MAP_WEEKS}, {GOALS2} {EPISODE_MEMBERS}
    fi AS (
        SELECT w.map_plan_id, CAST(NULL AS BIGINT) AS campaign_goal_id, s.project_id, s.episode_id, w.week_start, w.ewk, s.unit_count AS units
        FROM {{plan_project_spots_episode_map}} s JOIN newest n ON n.plan_id = s.plan_id AND n.v = s.plan_version_id
        JOIN mw w ON w.map_plan_id = s.plan_id AND w.week_start = s.week_date
        UNION
        {other_rows('{schedule_episode}', SUM_UNITS, EKEYS, 'ewk', STARTED)})
    {EPISODE_OUT} LEFT JOIN fi f ON f.map_plan_id = c.map_plan_id AND f.project_id = c.project_id AND f.episode_id = c.episode_id"""


def plan_grid(grp: bool, target: str) -> str:
    value = "sum(s.planned_grp)" if grp else SUM_UNITS
    kind = "DECIMAL(38,2)" if grp else "BIGINT"
    status = "e.status_cd IN (9, 10)" if grp else "(w.checked_yn = 'N' OR e.status_cd IN (9, 10))"
    demo = ("pp.demo_id", "rd.name") if target == "project" else ("od.demo_id", "odn.name")
    cols = f"""b.map_plan_id, b.plan_id, b.project_id, b.past_project, pp.campaign_goal_id, pp.display_seq, pr.name AS project_name, pp.phase_type,
        ph.description AS ph_description, pr.is_episodic, pr.media_outlet_id AS project_outlet_id, mo.short_name AS network_name, pp.status_cd,
        rps.name AS project_status, pp.proj_reach_pct AS proj_reach_percent, pp.proj_grp, pr.start_date AS project_start_date, pr.end_date AS project_end_date,
        pp.on_map_start, pp.on_map_end, pp.on_map_premiere, pr.premiere_date, {no_of_weeks('pp.on_map_start', 'pp.on_map_end')} AS no_of_weeks,
        {no_of_weeks('pr.start_date', 'pr.end_date')} AS project_weeks, pr.target_frequency AS project_freq, ps.segment_name AS project_segment,
        pd.name AS project_demo, ct.name AS campaign_type, pp.demo_id, rd.name AS demo, pp.segment_id,
        (SELECT string_agg(CAST(x.component_segment_id AS VARCHAR), ', ' ORDER BY x.component_segment_id) FROM {{segment_component}} x
          WHERE x.segment_id = CASE WHEN m.plan_status_id = 3 THEN g.segment_id ELSE pp.segment_id END) AS segment_selected,
        sg.segment_name, m.name AS plan_name, sp.name AS msg_plan_name, m.plan_status_id, mst.name AS plan_status, m.comments AS status_comment, pp.frequency,
        pp.target_reach_pct AS target_reach, pp.target_grp, pp.episode_priority, pp.no_of_episode,
        CASE WHEN b.past_project = 'Y' THEN 'N' ELSE coalesce(cf.flag, 'N') END AS colour_check_flag, pp.priority, pr.scatter_imps, se.subevent_name,
        coalesce(lr.run_ts, m.update_ts) AS exec_end_ts, pp.is_dirty, pr.user_comment, ol.last_opt_version_ts, {demo[0]} AS network_target_demo_id,
        {demo[1]} AS network_target_demo_name, CASE WHEN pr.media_outlet_id = m.media_outlet_id THEN 1 ELSE 99 END AS network_display_seq,
        pp.cluster_id, rc.cluster_name, pp.guide_reach_pct, pp.guide_grp, pp.guide_spots, pp.segment_type_id, pp.segment_mask,
        pr.target_segment AS project_segment_id, pr.target_demo_id AS project_demo_id, pr.campaign_type_id, cf.map_colour_updated_ts, pp.on_map_start_ts,
        pp.on_map_end_ts"""
    return f"""WITH {RUN_VERSION}, {NEWEST}, {MAPS}, {MAP_WEEKS},
    goals AS (
        SELECT DISTINCT m.plan_id AS map_plan_id, s.campaign_goal_id FROM {{schedule}} s
        JOIN (SELECT DISTINCT plan_id, campaign_goal_id FROM {{plan_project}}) e ON e.campaign_goal_id = s.campaign_goal_id JOIN {{plan}} p ON p.plan_id = e.plan_id
        JOIN maps m ON m.media_outlet_id = p.media_outlet_id AND m.plan_type = p.plan_type AND s.start_date BETWEEN m.qs AND m.qe),
    ep_goals AS (
        SELECT DISTINCT m.plan_id AS map_plan_id, s.campaign_goal_id FROM {{schedule_episode}} s
        JOIN (SELECT DISTINCT plan_id, campaign_goal_id FROM {{plan_project_episode}}) e ON e.campaign_goal_id = s.campaign_goal_id JOIN {{plan}} p ON p.plan_id = e.plan_id
        JOIN maps m ON m.media_outlet_id = p.media_outlet_id AND m.plan_type = p.plan_type AND s.start_date BETWEEN m.qs AND m.qe),
    excluded AS (
        SELECT DISTINCT m.plan_id AS map_plan_id, s.project_id FROM {{schedule}} s JOIN {{plan}} p ON p.plan_id = s.plan_id AND p.media_outlet_id = s.media_outlet_id
        JOIN maps m ON m.media_outlet_id = p.media_outlet_id AND m.plan_type = p.plan_type AND s.start_date BETWEEN m.qs AND m.qe),
    members AS (
        SELECT p.plan_id AS map_plan_id, p.plan_id, p.plan_version_id, p.project_id, 'N' AS past_project
        FROM {{plan_project}} p JOIN newest n ON n.plan_id = p.plan_id AND n.v = p.plan_version_id JOIN {{plan}} x ON x.plan_id = p.plan_id
        UNION
        SELECT m.plan_id, pp.plan_id, pp.plan_version_id, pp.project_id, 'Y'
        FROM maps m JOIN {{plan}} p ON p.media_outlet_id = m.media_outlet_id AND p.plan_type = m.plan_type AND p.plan_id <> m.plan_id
        JOIN run_version r ON r.plan_id = p.plan_id JOIN {{plan_project}} pp ON pp.plan_id = p.plan_id AND pp.plan_version_id = r.v
        JOIN {{schedule}} s ON s.plan_id = pp.plan_id AND s.plan_version_id = 0 AND s.project_id = pp.project_id AND s.start_date BETWEEN m.qs AND m.qe
        WHERE EXISTS (SELECT 1 FROM goals g WHERE g.map_plan_id = m.plan_id AND g.campaign_goal_id = pp.campaign_goal_id)
        UNION
        SELECT m.plan_id, pp.plan_id, pp.plan_version_id, pp.project_id, 'Y'
        FROM maps m JOIN {{plan}} p ON p.media_outlet_id = m.media_outlet_id AND p.plan_type = m.plan_type AND p.plan_id <> m.plan_id
        JOIN run_version r ON r.plan_id = p.plan_id JOIN {{plan_project}} pp ON pp.plan_id = p.plan_id AND pp.plan_version_id = r.v
        JOIN {{plan_project_episode}} e ON e.plan_id = pp.plan_id AND e.plan_version_id = pp.plan_version_id AND e.project_id = pp.project_id
        JOIN ep_goals g ON g.map_plan_id = m.plan_id AND g.campaign_goal_id = e.campaign_goal_id
        WHERE NOT EXISTS (SELECT 1 FROM excluded x WHERE x.map_plan_id = m.plan_id AND x.project_id = pp.project_id)),
    {label('members')},
    colour AS (
        SELECT pp.plan_id, pp.project_id, CASE WHEN h.episode_end_date < TIMESTAMP '1998-06-17 12:00:00' THEN 'N'
               WHEN coalesce(h.map_colour_updated_ts, TIMESTAMP '1990-01-01') > pp.update_ts THEN 'Y' ELSE 'N' END AS flag, h.map_colour_updated_ts
        FROM {{plan_project}} pp JOIN newest n ON n.plan_id = pp.plan_id AND n.v = pp.plan_version_id LEFT JOIN {{episode_header}} h ON h.project_id = pp.project_id AND h.active_yn = 'Y'),
    last_run AS (SELECT x.plan_id, max(x.exec_end_ts) AS run_ts FROM {{model_exec}} x JOIN newest n ON n.plan_id = x.plan_id AND n.v = x.plan_version_id GROUP BY 1),
    rows_ AS (
        SELECT {cols} FROM members b JOIN {{plan}} m ON m.plan_id = b.map_plan_id
        JOIN {{plan_project}} pp ON pp.plan_id = b.plan_id AND pp.plan_version_id = b.plan_version_id AND pp.project_id = b.project_id
        JOIN {{outlet_demo}} od ON od.media_outlet_id = m.media_outlet_id AND od.active_yn = 'Y' AND od.default_yn = 'Y' JOIN {{demo}} odn ON odn.demo_id = od.demo_id
        LEFT JOIN colour cf ON cf.plan_id = b.plan_id AND cf.project_id = b.project_id LEFT JOIN last_run lr ON lr.plan_id = b.map_plan_id
        LEFT JOIN opt_label ol ON ol.map_plan_id = b.map_plan_id AND ol.project_id = b.project_id
        LEFT JOIN {{project}} pr ON pr.project_id = b.project_id LEFT JOIN {{campaign_goal}} g ON g.campaign_goal_id = pp.campaign_goal_id
        LEFT JOIN {{plan_status}} rps ON rps.plan_status_id = CASE WHEN b.past_project = 'N' AND pp.optimize_yn = 'Y' AND m.plan_status_id = 2 THEN 2 ELSE pp.status_cd END
        LEFT JOIN {{plan_status}} mst ON mst.plan_status_id = m.plan_status_id LEFT JOIN {{phase}} ph ON ph.phase_type = pp.phase_type
        LEFT JOIN {{demo}} rd ON rd.demo_id = pp.demo_id LEFT JOIN {{demo}} pd ON pd.demo_id = pr.target_demo_id
        LEFT JOIN {{segment}} sg ON sg.segment_id = pp.segment_id LEFT JOIN {{segment}} ps ON ps.segment_id = pr.target_segment
        LEFT JOIN {{subevent}} se ON se.subevent_id = pr.subevent_id LEFT JOIN {{media_outlet}} mo ON mo.media_outlet_id = pr.media_outlet_id
        LEFT JOIN {{plan}} sp ON sp.plan_id = b.plan_id LEFT JOIN {{campaign_type}} ct ON ct.campaign_type_id = pr.campaign_type_id
        LEFT JOIN {{cluster}} rc ON rc.cluster_id = pp.cluster_id),
    done_amounts AS (
        SELECT w.map_plan_id, s.campaign_goal_id, s.project_id, w.week_start, w.wk, {value} AS units
        FROM {{schedule}} s JOIN mw w ON w.map_plan_id = s.plan_id AND s.start_date BETWEEN w.week_start AND w.week_end JOIN newest n ON n.plan_id = s.plan_id
        JOIN {{plan_project}} e ON e.plan_id = s.plan_id AND e.plan_version_id = n.v AND e.project_id = s.project_id
        WHERE s.plan_version_id = 0 AND {status} GROUP BY ALL
        UNION
        {other_rows('{schedule}', value, 's.project_id', 'wk')}
        UNION
        SELECT w.map_plan_id, NULL, s.project_id, w.week_start, w.wk, CAST(s.unit_count AS {kind}) FROM {{plan_project_spots}} s
        JOIN newest n ON n.plan_id = s.plan_id AND n.v = s.plan_version_id JOIN mw w ON w.map_plan_id = s.plan_id AND w.week_start = s.week_date
        JOIN {{plan_project}} e ON e.plan_id = s.plan_id AND e.plan_version_id = s.plan_version_id AND e.project_id = s.project_id WHERE e.status_cd NOT IN (9, 10)),
    open_amounts AS (
        SELECT w.map_plan_id, s.project_id, w.week_start, w.wk, CAST(s.unit_count AS {kind}) AS units FROM {{plan_project_spots}} s
        JOIN newest n ON n.plan_id = s.plan_id AND n.v = s.plan_version_id JOIN mw w ON w.map_plan_id = s.plan_id AND w.week_start = s.week_date
        UNION
        SELECT map_plan_id, project_id, week_start, wk, units FROM ({other_rows('{schedule}', value, 's.project_id', 'wk', STARTED)}))
    SELECT DISTINCT * FROM (
        SELECT r.*, a.week_start, a.wk AS week, a.units FROM rows_ r LEFT JOIN open_amounts a ON a.map_plan_id = r.map_plan_id AND a.project_id = r.project_id WHERE r.plan_status_id <> 3
        UNION ALL
        SELECT r.*, a.week_start, a.wk, a.units FROM rows_ r LEFT JOIN done_amounts a ON a.map_plan_id = r.map_plan_id
          AND ((a.campaign_goal_id IS NULL AND a.project_id = r.project_id) OR a.campaign_goal_id = r.campaign_goal_id) WHERE r.plan_status_id = 3)"""


SQL = {
    "plan_grid_for_edit": plan_grid(False, "project"),
    "plan_grid_for_edit_default_demo": plan_grid(True, "default"),
    "episodes_optimised": EPISODES_OPTIMISED,
    "episodes_saved": EPISODES_SAVED,
}
