NOW = "TIMESTAMP '1998-06-17 12:00:00'"
NEWEST = "newest AS (SELECT plan_id, max(plan_version_id) AS v FROM {plan_version} GROUP BY 1)"
RUNS = f"""runs AS (
    SELECT (SELECT max(model_exec_id) FROM {{model_exec}}) + row_number() OVER (ORDER BY p.plan_id) AS model_exec_id,
           CASE p.plan_type WHEN 1 THEN 1 WHEN 2 THEN 3 END AS model_type_id, p.media_outlet_id, p.plan_id, n.v AS plan_version_id, pv.optimization_type,
           'P' AS exec_status_cd, {NOW} AS req_ts
    FROM {{plan}} p JOIN newest n ON n.plan_id = p.plan_id JOIN {{plan_version}} pv ON pv.plan_id = p.plan_id AND pv.plan_version_id = n.v)"""


def window(table: str, keys: list[str]) -> str:
    same = " AND ".join(f"b.{k} = x.{k}" for k in keys)
    shown = ", ".join(keys)
    n = "DATE '1998-05-13'"
    wd = f"(isodow(on_map_end) - 1)"
    return f"""WITH {NEWEST},
        inherited AS (
            SELECT x.plan_id, x.plan_version_id, {', '.join('x.' + k for k in keys)}, x.on_map_start, x.on_map_end, x.cluster_id, x.status_cd, b.plan_id IS NOT NULL AND x.on_map_start <= {n} AS inh,
                   b.on_map_start AS bs, b.on_map_end AS be, b.measured_start AS bns, b.measured_end AS bne,
                   CASE WHEN b.plan_id IS NOT NULL AND x.on_map_start <= {n} THEN b.measured_start ELSE x.measured_start END AS ns,
                   CASE WHEN b.plan_id IS NOT NULL AND x.on_map_start <= {n} THEN b.measured_end ELSE x.measured_end END AS ne
            FROM {{{table}}} x JOIN newest n ON n.plan_id = x.plan_id AND n.v = x.plan_version_id
            LEFT JOIN {{{table}}} b ON b.plan_id = x.plan_id AND b.plan_version_id = x.plan_version_id - 1 AND {same}),
        reset AS (
            SELECT * REPLACE (
                CASE WHEN inh AND cluster_id > 1 AND status_cd = 11 THEN CASE WHEN on_map_start = bs AND on_map_end = be THEN bns END ELSE ns END AS ns,
                CASE WHEN inh AND cluster_id > 1 AND status_cd = 11 THEN CASE WHEN on_map_start = bs AND on_map_end = be THEN bne END ELSE ne END AS ne) FROM inherited),
        ended AS (
            SELECT * REPLACE (CASE WHEN ne IS NOT NULL THEN ne WHEN {wd} = isodow({n}) - 1 THEN {n}
                WHEN {wd} < isodow({n}) - 1 THEN CAST(date_trunc('week', {n}) AS DATE) + CAST({wd} AS INT)
                ELSE CAST(date_trunc('week', {n}) AS DATE) - 7 + CAST({wd} AS INT) END AS ne) FROM reset)
        SELECT plan_id, plan_version_id, {shown}, on_map_start, on_map_end,
               CASE WHEN ns IS NULL THEN ne - CAST(datediff('day', on_map_start, on_map_end) AS INT) ELSE ns END AS measured_start, ne AS measured_end FROM ended"""


def backfill(table: str, keys: list[str]) -> str:
    part = ", ".join(["plan_id", *keys])
    return f"""WITH {NEWEST}, k AS (
            SELECT x.*, n.v, max(coalesce(x.campaign_id, 0)) OVER (PARTITION BY {', '.join('x.' + c for c in ['plan_id', *keys])}) AS kc,
                   max(coalesce(x.campaign_goal_id, 0)) OVER (PARTITION BY {', '.join('x.' + c for c in ['plan_id', *keys])}) AS kg
            FROM {{{table}}} x LEFT JOIN newest n ON n.plan_id = x.plan_id AND n.v = x.plan_version_id)
        SELECT * EXCLUDE (v, kc, kg) REPLACE (
            CASE WHEN v IS NOT NULL AND optimize_yn = 'N' AND campaign_goal_id IS NULL THEN kc ELSE campaign_id END AS campaign_id,
            CASE WHEN v IS NOT NULL AND optimize_yn = 'N' AND campaign_goal_id IS NULL THEN kg ELSE campaign_goal_id END AS campaign_goal_id) FROM k"""


def params(forced: bool) -> str:
    value = "CASE WHEN r.optimization_type = 1 AND m.param_id = 27 THEN 20 ELSE m.param_value END" if forced else "m.param_value"
    return f"""WITH {NEWEST}, {RUNS}
        SELECT r.model_exec_id, f.param_id, f.param_value FROM runs r JOIN (VALUES (1, 1, 3), (1, 2, 1), (1, 12, 0), (0, 1, 2)) f(kind, param_id, param_value)
          ON f.kind = CASE WHEN r.optimization_type = 1 THEN 1 ELSE 0 END
        UNION ALL
        SELECT r.model_exec_id, m.param_id, {value} FROM runs r JOIN {{model_param}} m ON m.media_outlet_id = r.media_outlet_id AND m.model_type_id = 1
        WHERE CASE WHEN r.optimization_type = 1 THEN m.param_id NOT IN (1, 2, 12) ELSE m.param_id <> 1 END"""


CAP = """CAST(CASE
    WHEN datediff('day', on_map_start, week_date) <= 0 AND datediff('day', on_map_end, week_date + 1) >= 0 THEN
        CASE WHEN datediff('day', on_map_start, on_map_end) = 0 THEN (eo - so) / 3600.0 * ph
             WHEN datediff('day', on_map_start, on_map_end) = 1 THEN ((86400 - so) + eo) / 3600.0 * ph
             ELSE ((86400 - so) + eo) / 3600.0 * ph + datediff('day', on_map_start - 1, on_map_end) * ds END
    WHEN datediff('day', on_map_start, week_date) <= 0 AND datediff('day', on_map_end, week_date + 6) >= 0 THEN
        ((86400 - so) + eo) / 3600.0 * ph + (datediff('day', on_map_start, on_map_end) - 1) * ds
    WHEN datediff('day', on_map_start, week_date) <= 0 AND datediff('day', on_map_end, week_date + 6) < 0 THEN
        CASE WHEN datediff('day', on_map_start, on_map_end) = 1 THEN (86400 - so) / 3600.0 * ph
             ELSE (86400 - so) / 3600.0 * ph + datediff('day', on_map_start, week_date + 6) * ds END
    WHEN datediff('day', on_map_start, week_date) > 0 AND datediff('day', on_map_end, week_date + 6) < 0 THEN 7 * ds
    WHEN datediff('day', on_map_start, week_date) > 0 AND datediff('day', on_map_end, week_date + 6) >= 0 THEN
        CASE WHEN datediff('day', on_map_start, on_map_end) = 1 THEN eo / 3600.0 * ph ELSE eo / 3600.0 * ph + datediff('day', week_date, on_map_end) * ds END
    END AS DECIMAL(18,2))"""
HOURLY = "hourly AS (SELECT media_outlet_id, CAST(round(sum(spots), 0) AS DECIMAL(18,0)) AS ds, min(spots) AS ph FROM {spots_per_hour} GROUP BY 1)"

PROJECT_CAPS = f"""{HOURLY}, base AS (
    SELECT pp.plan_id, pp.plan_version_id, pp.project_id, pr.name || ' (' || mo.short_name || ')' AS project_name, s.week_date, s.unit_count, pp.on_map_start, pp.on_map_end,
           CASE WHEN pr.start_date = pp.on_map_start THEN pr.start_offset ELSE 21600 END AS so, CASE WHEN pr.end_date = pp.on_map_end THEN pr.end_offset ELSE 108000 END AS eo, h.ds, h.ph
    FROM {{plan}} p JOIN {{plan_version}} v ON v.plan_id = p.plan_id JOIN {{plan_project}} pp ON pp.plan_id = p.plan_id AND pp.plan_version_id = v.plan_version_id AND pp.optimize_yn = 'Y'
    JOIN {{plan_project_spots}} s ON s.plan_id = pp.plan_id AND s.plan_version_id = pp.plan_version_id AND s.project_id = pp.project_id
        AND s.week_date BETWEEN CAST(date_trunc('week', pp.on_map_start) AS DATE) AND pp.on_map_end
    JOIN {{project}} pr ON pr.project_id = pp.project_id JOIN {{media_outlet}} mo ON mo.media_outlet_id = pr.media_outlet_id JOIN hourly h ON h.media_outlet_id = p.media_outlet_id),
    caps AS (SELECT plan_id, plan_version_id, project_id, project_name, week_date, unit_count, {CAP} AS weekly_cap FROM base)"""
EPISODE_CAPS = f"""{HOURLY}, base AS (
    SELECT e.plan_id, e.plan_version_id, e.project_id, e.episode_id, pr.name || ' (' || mo.short_name || ')' AS project_name, s.week_date,
           CASE WHEN pp.phase_type = 1 THEN NULL ELSE s.unit_count END AS unit_count, e.on_map_start, e.on_map_end,
           CASE WHEN d.pl_start = e.on_map_start THEN d.pl_start_offset ELSE 21600 END AS so, CASE WHEN d.pl_end = e.on_map_end THEN d.pl_end_offset ELSE 108000 END AS eo, h.ds, h.ph
    FROM {{plan}} p JOIN {{plan_version}} v ON v.plan_id = p.plan_id JOIN {{plan_project_episode}} e ON e.plan_id = p.plan_id AND e.plan_version_id = v.plan_version_id AND e.optimize_yn = 'Y'
    JOIN {{plan_project}} pp ON pp.plan_id = e.plan_id AND pp.plan_version_id = e.plan_version_id AND pp.project_id = e.project_id
    JOIN {{plan_project_spots_episode_map}} s ON s.plan_id = e.plan_id AND s.plan_version_id = e.plan_version_id AND s.project_id = e.project_id AND s.episode_id = e.episode_id
        AND s.week_date BETWEEN CAST(date_trunc('week', e.on_map_start) AS DATE) AND CAST(date_trunc('week', e.on_map_end) AS DATE)
    JOIN {{project}} pr ON pr.project_id = e.project_id JOIN {{episode_detail}} d ON d.project_id = e.project_id AND d.episode_id = e.episode_id
    JOIN {{media_outlet}} mo ON mo.media_outlet_id = pr.media_outlet_id JOIN hourly h ON h.media_outlet_id = p.media_outlet_id),
    caps AS (SELECT plan_id, plan_version_id, project_id, episode_id, project_name, week_date, unit_count, {CAP} AS weekly_cap FROM base)"""

SQL = {
    "new_exec_requests": f"WITH {NEWEST}, {RUNS} SELECT * FROM runs",
    "linked_versions": f"""WITH {NEWEST}, {RUNS} SELECT v.* REPLACE (coalesce(r.model_exec_id, v.model_exec_id) AS model_exec_id)
        FROM {{plan_version}} v LEFT JOIN runs r ON r.plan_id = v.plan_id AND r.plan_version_id = v.plan_version_id""",
    "submitted_plans": f"""SELECT p.* REPLACE (CASE WHEN v.plan_id IS NULL THEN p.plan_status_id ELSE 1 END AS plan_status_id), CASE WHEN v.plan_id IS NOT NULL THEN {NOW} END AS schedule_ts
        FROM {{plan}} p LEFT JOIN (SELECT DISTINCT plan_id FROM {{plan_version}}) v ON v.plan_id = p.plan_id""",
    "measurement_window_projects": window("plan_project", ["project_id"]),
    "measurement_window_episodes": window("plan_project_episode", ["project_id", "episode_id"]),
    "backfill_projects": backfill("plan_project", ["project_id"]),
    "backfill_episodes": backfill("plan_project_episode", ["project_id", "episode_id"]),
    "mark_in_progress": f"""WITH {NEWEST} SELECT p.* REPLACE (CASE WHEN n.v IS NOT NULL AND (p.optimize_yn = 'Y' OR EXISTS (
            SELECT 1 FROM {{plan_project_episode}} e WHERE e.plan_id = p.plan_id AND e.plan_version_id = p.plan_version_id AND e.project_id = p.project_id AND e.optimize_yn = 'Y'))
            THEN 2 ELSE p.status_cd END AS status_cd)
        FROM {{plan_project}} p LEFT JOIN newest n ON n.plan_id = p.plan_id AND n.v = p.plan_version_id""",
    "expand_model_params": params(False),
    "expand_model_params_forced": params(True),
    "project_week_caps": f"WITH {PROJECT_CAPS} SELECT *, coalesce(weekly_cap < unit_count, FALSE) AS violates FROM caps",
    "daily_cap_check": f"""WITH {PROJECT_CAPS} SELECT plan_id, plan_version_id, project_id, project_name,
        string_agg(CAST(week_date AS VARCHAR), ',' ORDER BY week_date) AS weeks FROM caps GROUP BY ALL""",
    "daily_cap_check_episode": f"""WITH {EPISODE_CAPS} SELECT plan_id, plan_version_id, project_id, episode_id, project_name,
        string_agg(CAST(week_date AS VARCHAR), ',' ORDER BY week_date) AS weeks FROM caps WHERE weekly_cap < unit_count GROUP BY ALL""",
    "capacity_json_rejects": """SELECT plan_id, media_outlet_id, period_id, 'no JSON' AS reason, week_keys, capacity_json FROM {capacity_json} WHERE NOT json_valid(capacity_json)""",
    "explode_capacity_json": """
        WITH wk AS (SELECT q.period_id, q.name AS fiscal_qtr, w.start_date AS ws, w.end_date AS we, row_number() OVER (PARTITION BY q.period_id ORDER BY w.start_date) AS week_no
                    FROM {cal_period} q JOIN {cal_period} w ON w.period_type = 'W' AND w.fiscal_qtr = q.name WHERE q.period_type = 'Q'),
        keyed AS (SELECT plan_id, media_outlet_id, period_id, capacity_json, unnest(CAST(CAST(week_keys AS JSON) AS INT[])) AS week_no FROM {capacity_json} WHERE json_valid(capacity_json)),
        entry AS (SELECT plan_id, media_outlet_id, period_id, week_no, unnest(CAST(json_extract(capacity_json, '$."' || week_no || '"') AS JSON[])) AS e FROM keyed)
        SELECT DISTINCT x.plan_id, x.media_outlet_id, k.fiscal_qtr, CAST(x.e->>'DAYPART_ID' AS INT) AS daypart_id, CAST(x.e->>'CAPACITY' AS BIGINT) AS capacity_per_hour,
               d.start_date, d.start_date AS end_date, CAST(isodow(d.start_date) AS INT) AS day_of_week, 'D' AS period_type
        FROM entry x JOIN wk k ON k.period_id = x.period_id AND k.week_no = x.week_no
        JOIN {cal_period} d ON d.period_type = 'D' AND d.fiscal_qtr = k.fiscal_qtr AND d.start_date BETWEEN k.ws AND k.we
        WHERE CAST(x.e->>'MEDIA_OUTLET_ID' AS INT) = x.media_outlet_id AND isodow(d.start_date) = CAST(x.e->>'DAY_OF_WEEK' AS INT) AND d.start_date > DATE '1998-06-17'""",
}
