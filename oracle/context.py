MODEL_TYPE = "CASE plan_type WHEN 1 THEN 1 WHEN 2 THEN 3 END"

# Projects of earlier plans inside a plan's quarter.
CARRY = """
    launch_rows AS (
        SELECT DISTINCT m.plan_id AS map_plan_id, s.plan_id, s.project_id
        FROM {schedule} s JOIN {plan} p ON p.plan_id = s.plan_id
        JOIN {plan} m ON m.media_outlet_id = p.media_outlet_id AND m.plan_type = p.plan_type AND m.period_id > p.period_id
        JOIN {cal_period} q ON q.period_type = 'Q' AND q.period_id = m.period_id
        WHERE s.plan_version_id = 0 AND s.active_yn = 'Y' AND s.start_date BETWEEN q.start_date AND q.end_date),
    episode_rows AS (
        SELECT DISTINCT m.plan_id AS map_plan_id, s.plan_id, s.project_id
        FROM {schedule_episode} s JOIN {plan} p ON p.plan_id = s.plan_id
        JOIN {plan} m ON m.media_outlet_id = p.media_outlet_id AND m.plan_type = p.plan_type AND m.period_id > p.period_id
        JOIN {cal_period} q ON q.period_type = 'Q' AND q.period_id = m.period_id
        WHERE s.plan_version_id = 0 AND s.active_yn = 'Y' AND s.start_date BETWEEN q.start_date AND q.end_date),
    carry AS (
        SELECT *, 'PAST LAUNCH' AS phase_dur_type FROM launch_rows
        UNION ALL
        SELECT e.*, 'PAST EP' FROM episode_rows e WHERE NOT EXISTS (
            SELECT 1 FROM launch_rows l WHERE l.map_plan_id = e.map_plan_id AND l.project_id = e.project_id))"""

CURRENT = """
    done AS (SELECT plan_id, max(plan_version_id) AS v FROM {model_exec} WHERE exec_status_cd = 'C' GROUP BY plan_id),
    cur_launch AS (
        SELECT p.plan_id, p.plan_version_id, p.project_id FROM {plan_project} p JOIN done ON done.plan_id = p.plan_id AND done.v = p.plan_version_id
        WHERE p.campaign_goal_id > 0 AND p.status_cd <> 2),
    cur AS (
        SELECT *, 1 AS episode_id, 'CUR LAUNCH' AS phase_dur_type FROM cur_launch
        UNION ALL
        SELECT p.plan_id, p.plan_version_id, p.project_id, e.episode_id, 'CUR EP'
        FROM {plan_project} p JOIN done ON done.plan_id = p.plan_id AND done.v = p.plan_version_id
        JOIN {plan_project_episode} e ON e.plan_id = p.plan_id AND e.plan_version_id = p.plan_version_id AND e.project_id = p.project_id
        WHERE p.status_cd <> 2 AND e.campaign_goal_id > 0
          AND NOT EXISTS (SELECT 1 FROM cur_launch l WHERE l.plan_id = p.plan_id AND l.project_id = p.project_id))"""


def label(members: str) -> str:
    """CTEs ending in ``opt_label`` (map_plan_id, project_id, last_opt_version_ts) for the rows of ``members``."""
    return f"""
    opt_runs AS (
        SELECT m.map_plan_id, m.plan_id, m.project_id, 1 AS phase, max(x.plan_version_id) AS v, max(x.exec_end_ts) AS ts
        FROM (SELECT DISTINCT map_plan_id, plan_id, project_id FROM {members}) m
        JOIN {{plan_project}} p ON p.plan_id = m.plan_id AND p.project_id = m.project_id AND p.optimize_yn = 'Y'
        JOIN {{model_exec}} x ON x.plan_id = p.plan_id AND x.plan_version_id = p.plan_version_id AND x.exec_status_cd = 'C'
        GROUP BY ALL
        UNION ALL
        SELECT m.map_plan_id, m.plan_id, m.project_id, 2, max(x.plan_version_id), max(x.exec_end_ts)
        FROM (SELECT DISTINCT map_plan_id, plan_id, project_id FROM {members}) m
        JOIN {{plan_project_episode}} p ON p.plan_id = m.plan_id AND p.project_id = m.project_id AND p.optimize_yn = 'Y'
        JOIN {{model_exec}} x ON x.plan_id = p.plan_id AND x.plan_version_id = p.plan_version_id AND x.exec_status_cd = 'C'
        GROUP BY ALL),
    opt_label AS (
        SELECT map_plan_id, project_id, 'v' || (v + 1) || ' ' || strftime(ts, '%m/%d/%Y %I:%M %p') AS last_opt_version_ts
        FROM (SELECT *, row_number() OVER (PARTITION BY map_plan_id, project_id ORDER BY phase DESC, plan_id DESC) AS rn FROM opt_runs)
        WHERE rn = 1)"""


SQL = {
    "plan_context": f"""
        SELECT p.plan_id, p.media_outlet_id, p.plan_type, {MODEL_TYPE} AS model_type_id, p.period_id, p.plan_status_id,
               q.name AS qtr_name, q.start_date AS qtr_start, q.end_date AS qtr_end, n.end_date AS map_end
        FROM {{plan}} p JOIN {{cal_period}} q ON q.period_type = 'Q' AND q.period_id = p.period_id
        LEFT JOIN {{cal_period}} n ON n.period_type = 'Q' AND n.start_date = q.end_date + 1""",
    "latest_completed_version": """
        SELECT plan_id, media_outlet_id, model_type_id, max(plan_version_id) AS plan_version_id
        FROM {model_exec} WHERE exec_status_cd = 'C' GROUP BY ALL""",
    "latest_version": "SELECT plan_id, max(plan_version_id) AS plan_version_id FROM {plan_version} GROUP BY plan_id",
    "past_plan": """
        SELECT a.plan_id, b.plan_id AS past_plan_id FROM {plan} a JOIN {plan} b
        ON b.media_outlet_id = a.media_outlet_id AND b.plan_type = a.plan_type AND b.period_id = a.period_id - 1 AND b.active_yn = 'Y'""",
    "future_plan": """
        SELECT a.plan_id, b.plan_id AS future_plan_id FROM {plan} a JOIN {plan} b
        ON b.media_outlet_id = a.media_outlet_id AND b.plan_type = a.plan_type AND b.period_id = a.period_id + 1""",
    "default_demo": "SELECT media_outlet_id, min(demo_id) AS demo_id FROM {outlet_demo} WHERE default_yn = 'Y' GROUP BY 1",
    "last_opt_label": "WITH members AS (SELECT plan_id AS map_plan_id, plan_id, project_id FROM {plan_project}),"
                      + label("members") + " SELECT * FROM opt_label",
    "carry_over_projects": "WITH " + CARRY + " SELECT * FROM carry",
    "current_projects": "WITH " + CURRENT + " SELECT * FROM cur",
}
