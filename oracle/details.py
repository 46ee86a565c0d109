from oracle.reports import DONE_OR_ZERO


def clock(expr: str) -> str:
    return f"strftime(TIMESTAMP '1970-01-01 00:00:00' + INTERVAL '1' SECOND * ({expr}), '%I:%M %p')"


def hms(expr: str) -> str:
    return f"printf('%02d:%02d:%02d', CAST(floor(({expr}) / 3600) AS INT), CAST(floor(({expr}) % 3600 / 60) AS INT), CAST(({expr}) % 60 AS INT))"


def seconds(col: str) -> str:
    return f"(CAST(split_part({col}, ':', 1) AS INT) * 3600 + CAST(split_part({col}, ':', 2) AS INT) * 60 + CAST(split_part({col}, ':', 3) AS INT))"


COUNTED = ("plan", "campaign_goal", "campaign_goal_episode", "schedule", "schedule_episode", "plan_project", "plan_project_episode",
           "plan_project_spots", "plan_project_spots_episode", "plan_project_spots_episode_map", "plan_version", "model_exec")

SQL = {
    "plan_header": """
        SELECT p.media_outlet_id, q.name AS qtr_name, p.plan_type, p.plan_id, p.name AS plan_name, p.period_id, p.plan_status_id, st.name AS plan_status,
               p.create_ts, p.update_ts, p.update_user, coalesce(u.first_name, '0') AS first_name, coalesce(u.last_name, '0') AS last_name, p.comments AS status_comment,
               CASE WHEN l.flag = 'Y' THEN l.lock_ts END AS locked_ts, CASE WHEN l.flag = 'Y' THEN lu.first_name || ' ' || lu.last_name END AS locked_by,
               CASE WHEN l.flag = 'Y' THEN l.lock_user END AS locked_by_id
        FROM {plan} p JOIN {cal_period} q ON q.period_type = 'Q' AND q.period_id = p.period_id JOIN {plan_status} st ON st.plan_status_id = p.plan_status_id
        LEFT JOIN {sec_user} u ON u.user_id = p.update_user
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY plan_id ORDER BY lock_id DESC) AS rn FROM {plan_lock}) l ON l.plan_id = p.plan_id AND l.rn = 1
        LEFT JOIN {sec_user} lu ON lu.user_id = l.lock_user
        WHERE p.checked_yn = 'Y'
        UNION ALL
        SELECT p.media_outlet_id, q.name, p.plan_type, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
        FROM {plan} p JOIN {cal_period} q ON q.period_type = 'Q' AND q.period_id = p.period_id WHERE p.checked_yn = 'N'""",
    "episode_rules_json": f"""WITH {DONE_OR_ZERO}
        SELECT j.plan_id, j.project_id, j.episode_dtl_json FROM {{episode_json}} j JOIN ver v ON v.plan_id = j.plan_id AND v.v = j.plan_version_id""",
    "saved_episode_rules_json": """
        SELECT DISTINCT j.plan_id, j.project_id, j.episode_dtl_json FROM {episode_json} j JOIN {plan_project_episode} e
          ON e.plan_id = j.plan_id AND e.plan_version_id = j.plan_version_id AND e.project_id = j.project_id
        WHERE j.plan_version_id = (SELECT max(v.plan_version_id) FROM {plan_version} v WHERE v.plan_id = j.plan_id)""",
    "multi_net_flag": """
        SELECT DISTINCT x.request_id, x.project_id, CASE WHEN g.project_id IS NULL THEN 'single' ELSE 'multi' END AS planned_on, g.geo_plan_name
        FROM (SELECT request_id, media_outlet_id, CAST(unnest(CAST(project_ids_json AS JSON)::BIGINT[]) AS BIGINT) AS project_id FROM {project_list}) x
        LEFT JOIN {geo_project} g ON g.project_id = x.project_id AND g.media_outlet_id = x.media_outlet_id AND g.active_yn = 'Y'""",
    "episode_details": f"""
        SELECT d.project_id, d.episode_id, d.broadcast_date, {clock('d.air_offset')} AS start_time, {clock('d.air_offset + d.duration')} AS end_time, d.dow,
               d.pl_start, d.pl_end, CAST(datediff('day', d.pl_start, d.pl_end) + 1 AS INT) AS planning_days, coalesce(d.tgt_spot, 0) AS tgt_spot, d.tgt_grp,
               u.is_episode_changed_db, u.is_episode_att_edited, d.status
        FROM {{episode_detail}} d JOIN {{episode_edit}} u ON u.project_id = d.project_id AND u.episode_id = d.episode_id""",
    "episode_timebands": f"""
        SELECT c.project_id, c.episode_id, t.constraint_id, {hms('t.start_offset')} AS start_time, {hms('t.end_offset')} AS end_time, t.days_mask
        FROM {{episode_constraint}} c JOIN {{episode_timeband}} t ON t.constraint_type_id = c.constraint_type_id AND t.constraint_id = c.constraint_key
        WHERE c.constraint_type_id = 4""",
    "episode_timeband_days": f"""
        SELECT project_id, episode_id, constraint_id, band_weekday, CAST((band_weekday - 1 + later) % 7 + 1 AS INT) AS weekday, start_second, end_second,
               {hms('start_second')} AS start_time, {hms('end_second')} AS end_time
        FROM (SELECT c.project_id, c.episode_id, t.constraint_id, CAST(d.i + 1 AS INT) AS band_weekday, n.i AS later,
                     CAST(CASE WHEN t.start_offset > n.i * 86400 THEN t.start_offset - n.i * 86400 ELSE 0 END AS INT) AS start_second,
                     CAST(CASE WHEN t.end_offset < (n.i + 1) * 86400 THEN t.end_offset - n.i * 86400 ELSE 86400 END AS INT) AS end_second
              FROM {{episode_constraint}} c JOIN {{episode_timeband}} t ON t.constraint_type_id = c.constraint_type_id AND t.constraint_id = c.constraint_key,
                   range(7) d(i), range(3) n(i)
              WHERE c.constraint_type_id = 4 AND (t.days_mask >> d.i) & 1 = 1 AND t.start_offset < (n.i + 1) * 86400 AND t.end_offset > n.i * 86400)""",
    "episode_header": f"""
        SELECT project_id, episode_start_date, episode_end_date, {clock('start_offset')} AS episode_start_time, {clock('end_offset')} AS episode_end_time,
               tgt_spots, tgt_grp, dow_mask FROM {{episode_header}} WHERE active_yn = 'Y'""",
    "blackouts": "SELECT project_id, start_date, end_date FROM {blackout} WHERE kind = 'blackout'",
    "recurring_exclusions": f"""
        SELECT project_id, {hms('start_offset')} AS start_time, {hms('end_offset')} AS end_time, days_mask FROM {{recurring_exclusion}} WHERE active_yn = 'Y'""",
    "clock_offsets": f"""
        SELECT campaign_goal_id, {seconds('start_time')} AS start_offset, {seconds('end_time')} AS end_offset,
               {hms(seconds('start_time') + ' + ' + seconds('end_time'))} AS sum_time FROM {{campaign_goal}}""",
    "exec_report": """
        SELECT x.model_exec_id, l.media_outlet_id, mo.short_name AS network_code, l.broadcast_date, u.user_name AS email, u.first_name || ' ' || u.last_name AS name,
               NULL AS plan_name, NULL AS quarter, CASE WHEN lv.status = 15 THEN 'Re-Timing' ELSE 'Optimization' END AS plan_type, x.model_type_id,
               x.exec_status_cd AS exec_status, CAST(lv.sub_log_version_id AS VARCHAR) AS version_no, x.opt_process_key
        FROM {model_exec} x JOIN {log_version} lv ON lv.log_version_id = x.plan_version_id JOIN {log} l ON l.log_id = lv.log_id
        JOIN {sec_user} u ON u.user_id = x.user_id JOIN {media_outlet} mo ON mo.media_outlet_id = l.media_outlet_id WHERE x.model_type_id IN (2, 4)
        UNION ALL
        SELECT x.model_exec_id, p.media_outlet_id, mo.short_name, NULL, u.user_name, u.first_name || ' ' || u.last_name, p.name, q.fiscal_qtr,
               CASE WHEN coalesce(v.optimization_type, 0) = 0 THEN 'Optimize' ELSE 'Distribute' END, x.model_type_id, x.exec_status_cd, NULL, x.opt_process_key
        FROM {model_exec} x JOIN {plan} p ON p.plan_id = x.plan_id JOIN {plan_version} v ON v.plan_id = x.plan_id AND v.plan_version_id = x.plan_version_id
        JOIN {media_outlet} mo ON mo.media_outlet_id = p.media_outlet_id JOIN {sec_user} u ON u.user_id = x.user_id
        JOIN {cal_period} q ON q.period_type = 'Q' AND q.period_id = p.period_id WHERE x.model_type_id NOT IN (2, 4)""",
    "table_row_counts": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS cnt FROM {{{n}}}" for n in COUNTED),
}
