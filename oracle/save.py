NOW = "TIMESTAMP '1998-06-17 12:00:00'"

RESOLVED = """resolved AS (
    SELECT r.*, p.plan_id, p.plan_status_id, FALSE AS is_new FROM {save_request} r
    JOIN {plan} p ON p.media_outlet_id = r.media_outlet_id AND p.period_id = r.period_id AND p.plan_type = r.plan_type
    UNION ALL
    SELECT r.*, (SELECT max(plan_id) FROM {plan}) + row_number() OVER (ORDER BY r.uid), NULL, TRUE FROM {save_request} r
    WHERE NOT EXISTS (SELECT 1 FROM {plan} p WHERE p.media_outlet_id = r.media_outlet_id AND p.period_id = r.period_id AND p.plan_type = r.plan_type))"""

DECIDED = RESOLVED + """, decided AS (
    SELECT r.*, CASE WHEN v.n IS NULL THEN 'first' WHEN r.plan_status_id IN (0, 7) THEN 'reuse' ELSE 'next' END AS version_action,
           CASE WHEN v.n IS NULL THEN 0 WHEN r.plan_status_id IN (0, 7) THEN v.n ELSE v.n + 1 END AS plan_version_id
    FROM resolved r LEFT JOIN (SELECT plan_id, max(plan_version_id) AS n FROM {plan_version} GROUP BY 1) v ON v.plan_id = r.plan_id)"""

NAMED = """(CASE WHEN position('-v' IN d.map_name) > 0 THEN left(d.map_name, position('-v' IN d.map_name) - 1) ELSE d.map_name END) || '-v' || (d.plan_version_id + 1)"""

STAGED = f"""staged AS (
    SELECT d.plan_id, d.plan_version_id, s.project_id,
        CAST(CASE WHEN s.optimize_yn = 'Y' THEN 11 WHEN s.is_dirty = 'Y' THEN 11 WHEN s.status_cd IS NULL THEN 12 ELSE s.status_cd END AS INT) AS status_cd,
        s.optimize_yn, s.is_dirty, 'Y' AS is_active, s.display_seq, s.priority, s.episode_priority, s.target_reach AS target_reach_pct, s.target_grp,
        CASE WHEN s.cluster_id >= 1 AND s.segment_id IS NULL THEN (SELECT min(g.segment_id) FROM {{segment}} g WHERE g.mask = s.segment_mask
             AND g.segment_type_id = CASE WHEN s.segment_mask IN (31, 480) THEN 3 ELSE s.segment_type_id END) ELSE s.segment_id END AS segment_id,
        s.frequency, s.demo_id, s.cluster_id, s.phase_type, s.on_map_start, s.on_map_end, s.on_map_premiere, s.on_map_start_ts, s.on_map_end_ts,
        s.planned_spots, s.guide_reach_pct, s.guide_grp, s.guide_spots, s.network_target_demo_id, s.segment_type_id, s.segment_mask, s.no_of_episode,
        s.user_comment, d.user_id AS create_user, {NOW} AS create_ts, d.user_id AS update_user,
        CASE WHEN s.optimize_yn = 'Y' THEN {NOW} ELSE coalesce(b.update_ts, {NOW}) END AS update_ts, b.proj_grp, b.proj_reach_pct
    FROM {{stg_plan_project}} s JOIN decided d ON d.uid = s.uid
    LEFT JOIN {{plan_project}} b ON b.plan_id = d.plan_id AND b.plan_version_id = d.plan_version_id - 1 AND b.project_id = s.project_id)"""

FROZEN = """frozen AS (SELECT * REPLACE (CASE WHEN phase_type = 2 OR (phase_type IN (1, 3) AND on_map_end <= DATE '1998-06-17') THEN 'N' ELSE optimize_yn END AS optimize_yn) FROM staged)"""

REMOVED = """removed AS (
    SELECT d.plan_id, d.plan_version_id AS saved_version, d.media_outlet_id, p.project_id, p.campaign_goal_id
    FROM decided d JOIN {plan_project} p ON p.plan_id = d.plan_id AND p.plan_version_id = d.plan_version_id - 1
    WHERE p.is_active = 'Y' AND p.project_id NOT IN (SELECT s.project_id FROM {stg_plan_project} s WHERE s.uid = d.uid)),
    removed_episode AS (
    SELECT DISTINCT d.plan_id, d.plan_version_id AS saved_version, d.media_outlet_id, p.project_id
    FROM decided d JOIN {plan_project_episode} p ON p.plan_id = d.plan_id AND p.plan_version_id = d.plan_version_id - 1
    WHERE p.is_active = 'Y' AND p.project_id NOT IN (SELECT s.project_id FROM {stg_plan_project} s WHERE s.uid = d.uid))"""

EPISODES = """parsed AS (
    SELECT d.plan_id, d.plan_version_id, unnest(CAST(CASE WHEN json_valid(j.episode_dtl_json) THEN CAST(j.episode_dtl_json AS JSON) END AS JSON[])) AS o
    FROM {stg_episode_json} j JOIN decided d ON d.uid = j.uid)"""

EPISODE_COLS = """plan_id, plan_version_id, CAST(o->>'PROJECT_ID' AS BIGINT) AS project_id, CAST(o->>'EPISODE_NUM' AS INT) AS episode_id,
    CAST(o->>'TARGET_GRP' AS DECIMAL(18,2)) AS target_grp, CAST(o->>'TARGET_SPOT' AS INT) AS target_spots, CAST(o->>'START_TS' AS DATE) AS start_date,
    CAST(o->>'END_TS' AS DATE) AS end_date, CAST(o->>'EPISODE_START_TS' AS TIMESTAMP) AS episode_start_ts"""


def without(table: str, gone: str, extra: str = "") -> str:
    return (f"WITH {DECIDED}, {REMOVED} SELECT x.* FROM {{{table}}} x WHERE NOT EXISTS (SELECT 1 FROM {gone} r "
            f"WHERE r.project_id = x.project_id AND r.media_outlet_id = x.media_outlet_id {extra})")


def others(table: str) -> str:
    return f"NOT EXISTS (SELECT 1 FROM decided d WHERE d.plan_id = {table}.plan_id AND d.plan_version_id = {table}.plan_version_id)"


def day_sums(table: str, more: str, where: str = "") -> str:
    return (f"SELECT x.plan_id, x.plan_version_id, x.active_yn, x.media_outlet_id, x.project_id, x.campaign_goal_id, x.daypart_id, x.start_date, x.end_date{more}, "
            f"CAST(sum(x.planned_units) AS BIGINT) AS planned_units, sum(x.planned_grp) AS planned_grp FROM {{{table}}} x {where} GROUP BY ALL")


SQL = {
    "schedule_day_sums": day_sums("schedule", ""),
    "episode_day_sums_after_save": f"WITH {DECIDED}, {REMOVED} " + day_sums(
        "schedule_episode", ", x.episode_id",
        "WHERE NOT EXISTS (SELECT 1 FROM removed_episode r WHERE r.project_id = x.project_id AND r.media_outlet_id = x.media_outlet_id)"),
    "resolve_plan": f"WITH {RESOLVED} SELECT * FROM resolved",
    "decide_version": f"WITH {DECIDED} SELECT * FROM decided",
    "saved_plans": f"""WITH {DECIDED}
        SELECT p.* FROM {{plan}} p WHERE p.plan_id NOT IN (SELECT plan_id FROM decided)
        UNION ALL BY NAME
        SELECT p.* REPLACE ({NAMED} AS name, d.user_id AS update_user, {NOW} AS update_ts, 0 AS plan_status_id, NULL AS comments)
        FROM {{plan}} p JOIN decided d ON d.plan_id = p.plan_id
        UNION ALL BY NAME
        SELECT d.plan_id, d.media_outlet_id, d.period_id, d.plan_type, {NAMED} AS name, 0 AS plan_status_id, 'Y' AS active_yn, 'Y' AS checked_yn, NULL AS comments,
               {NOW} AS create_ts, {NOW} AS update_ts, d.user_id AS update_user FROM decided d WHERE d.is_new""",
    "saved_versions": f"""WITH {DECIDED}
        SELECT v.* FROM {{plan_version}} v WHERE {others('v')}
        UNION ALL BY NAME
        SELECT v.* REPLACE (d.optimization_type AS optimization_type, {NOW} AS update_ts) FROM {{plan_version}} v JOIN decided d ON d.plan_id = v.plan_id AND d.plan_version_id = v.plan_version_id
        UNION ALL BY NAME
        SELECT d.plan_id, d.plan_version_id, d.map_name AS version_name, d.optimization_type, CAST(NULL AS BIGINT) AS model_exec_id, 'Y' AS active_yn,
               d.user_id AS create_user, {NOW} AS create_ts, d.user_id AS update_user, {NOW} AS update_ts FROM decided d WHERE d.version_action <> 'reuse'""",
    "carry_forward_results": f"WITH {DECIDED}, {STAGED} SELECT * FROM staged",
    "freeze_optimize_flag": f"WITH {DECIDED}, {STAGED}, {FROZEN} SELECT * EXCLUDE (proj_grp, proj_reach_pct) FROM frozen",
    "upsert_plan_projects": f"""WITH {DECIDED}, {STAGED}, {FROZEN}, {REMOVED}
        SELECT p.* REPLACE (CASE WHEN EXISTS (SELECT 1 FROM removed r WHERE r.plan_id = p.plan_id AND r.project_id = p.project_id) THEN 'N' ELSE p.is_active END AS is_active)
        FROM {{plan_project}} p WHERE {others('p')} AND NOT EXISTS (
            SELECT 1 FROM removed r WHERE r.plan_id = p.plan_id AND r.project_id = p.project_id AND r.saved_version - 1 = p.plan_version_id)
        UNION ALL BY NAME SELECT * FROM frozen""",
    "upsert_spots": f"""WITH {DECIDED}, {REMOVED}
        SELECT p.* FROM {{plan_project_spots}} p WHERE {others('p')} AND NOT EXISTS (
            SELECT 1 FROM removed r WHERE r.plan_id = p.plan_id AND r.project_id = p.project_id AND r.saved_version - 1 = p.plan_version_id)
        UNION ALL
        SELECT d.plan_id, d.plan_version_id, s.project_id, s.week_date, s.unit_count FROM {{stg_spots}} s JOIN decided d ON d.uid = s.uid""",
    "propagate_targets": f"""WITH {DECIDED},
        newest AS (SELECT * FROM (SELECT s.*, d.media_outlet_id, row_number() OVER (PARTITION BY s.project_id, d.media_outlet_id ORDER BY s.uid DESC) AS rn
                   FROM {{stg_plan_project}} s JOIN decided d ON d.uid = s.uid) WHERE rn = 1),
        gone AS (SELECT DISTINCT d.plan_id, d.media_outlet_id, p.project_id FROM decided d JOIN {{plan_project}} p ON p.plan_id = d.plan_id AND p.plan_version_id = d.plan_version_id - 1
                 WHERE p.project_id NOT IN (SELECT s.project_id FROM {{stg_plan_project}} s WHERE s.uid = d.uid))
        SELECT p.* REPLACE (
            CASE WHEN n.uid IS NULL THEN p.target_reach WHEN coalesce(n.target_reach, 0) = 0 AND n.planned_spots > 0 AND coalesce(p.target_grp, 0) = 0 THEN n.guide_reach_pct ELSE n.target_reach END AS target_reach,
            CASE WHEN n.uid IS NULL THEN p.target_grp ELSE n.target_grp END AS target_grp, CASE WHEN n.uid IS NULL THEN p.priority ELSE n.priority END AS priority,
            CASE WHEN g.project_id IS NOT NULL THEN NULL ELSE p.plan_id END AS plan_id)
        FROM {{project}} p LEFT JOIN newest n ON n.project_id = p.project_id AND n.media_outlet_id = p.media_outlet_id
        LEFT JOIN gone g ON g.project_id = p.project_id AND g.plan_id = p.plan_id AND g.media_outlet_id = p.media_outlet_id""",
    "removed_projects": f"WITH {DECIDED}, {REMOVED} SELECT * FROM removed",
    "removed_episode_projects": f"WITH {DECIDED}, {REMOVED} SELECT * FROM removed_episode",
    "cascade_schedule_episode": without("schedule_episode", "removed_episode"),
    "cascade_project_reach": without("project_reach", "removed", "AND x.reach_type = 'PLANNED'"),
    "cascade_project_reach_episode": without("project_reach_episode", "removed", "AND x.reach_type = 'PLANNED'"),
    "cascade_campaign_goal": without("campaign_goal", "removed"),
    "cascade_campaign_goal_episode": without("campaign_goal_episode", "removed"),
    "audit_events": f"""WITH {DECIDED}, {REMOVED}, events AS (
        SELECT plan_id, CAST(NULL AS BIGINT) AS plan_version_id, CAST(NULL AS BIGINT) AS project_id, 'NEW PLAN CREATED' AS description, {NOW} AS event_ts FROM decided WHERE is_new
        UNION ALL SELECT plan_id, plan_version_id, NULL, 'NEW PLAN VERSION CREATED', {NOW} FROM decided WHERE version_action <> 'reuse'
        UNION ALL SELECT plan_id, saved_version, project_id, 'SPOTS REMOVED FOR DELETED PROJECT FROM A PLAN', {NOW} FROM removed
        UNION ALL SELECT plan_id, saved_version, project_id, 'REACH DATA REMOVED FOR DELETED PROJECT FROM A PLAN', {NOW} FROM removed)
        SELECT *, CAST(NULL AS BIGINT) AS model_exec_id, CAST(NULL AS BIGINT) AS episode_id, 'SAVE PLANS' AS step_name FROM events""",
    "store_episode_json": f"""WITH {DECIDED}
        SELECT j.* FROM {{episode_json}} j WHERE {others('j')}
        UNION ALL SELECT d.plan_id, d.plan_version_id, s.project_id, s.episode_dtl_json FROM {{stg_episode_json}} s JOIN decided d ON d.uid = s.uid""",
    "flatten_episode_json": f"""WITH parsed AS (SELECT plan_id, plan_version_id, unnest(CAST(CASE WHEN json_valid(episode_dtl_json) THEN CAST(episode_dtl_json AS JSON) END AS JSON[])) AS o FROM {{episode_json}})
        SELECT {EPISODE_COLS} FROM parsed WHERE CAST(o->>'chkSelectRow' AS BOOLEAN)""",
    "episode_json_rejects": """SELECT plan_id, plan_version_id, project_id, episode_dtl_json,
        CASE WHEN episode_dtl_json IS NULL THEN 'no text' WHEN NOT json_valid(episode_dtl_json) THEN 'no JSON' ELSE 'no array' END AS reason
        FROM {episode_json} WHERE NOT coalesce(json_valid(episode_dtl_json), false) OR CASE WHEN json_valid(episode_dtl_json) THEN json_type(episode_dtl_json) END <> 'ARRAY'""",
    "insert_episodes": f"""WITH {DECIDED}, {STAGED}, {EPISODES}, e AS (SELECT {EPISODE_COLS} FROM parsed WHERE CAST(o->>'chkSelectRow' AS BOOLEAN))
        SELECT e.plan_id, e.plan_version_id, e.project_id, e.episode_id, e.target_spots AS tgt_spots, e.target_grp, e.episode_start_ts, 10 AS status_cd, s.optimize_yn,
               s.is_dirty, s.is_active, s.episode_priority AS priority, s.cluster_id, s.segment_id, s.frequency, s.demo_id, e.start_date AS on_map_start, e.end_date AS on_map_end
        FROM e JOIN staged s ON s.plan_id = e.plan_id AND s.plan_version_id = e.plan_version_id AND s.project_id = e.project_id""",
    "episode_spots": f"""WITH {DECIDED}, {EPISODES}, e AS (SELECT {EPISODE_COLS} FROM parsed WHERE CAST(o->>'chkSelectRow' AS BOOLEAN))
        SELECT plan_id, plan_version_id, project_id, episode_id, CAST(date_trunc('week', start_date) AS DATE) AS week_date,
               CAST(CASE WHEN target_grp IS NULL THEN target_spots ELSE target_grp END AS DECIMAL(18,2)) AS unit_count FROM e""",
    "upsert_episode_map": f"""WITH {DECIDED}, s AS (
            SELECT d.plan_id, d.plan_version_id, m.project_id, m.episode_id, m.week_date, m.unit_count, m.episode_start_date, m.episode_end_date,
                   m.broadcast_date, m.episode_start_ts FROM {{stg_episode_map}} m JOIN decided d ON d.uid = m.uid WHERE m.unit_count > 0)
        SELECT x.* FROM {{plan_project_spots_episode_map}} x WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.plan_id = x.plan_id AND s.plan_version_id = x.plan_version_id
            AND s.project_id = x.project_id AND s.episode_id = x.episode_id AND s.week_date = x.week_date)
        UNION ALL SELECT * FROM s""",
}
