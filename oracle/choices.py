from oracle.reports import no_of_weeks

NETWORK = """media_outlet_id, name, external_short_name, short_name, cable_network_id,
    CASE WHEN rated_yn = 'Y' AND streaming_yn = 'N' THEN 'RATED' WHEN rated_yn = 'N' AND streaming_yn = 'N' THEN 'NON-RATED'
         WHEN rated_yn = 'N' AND streaming_yn = 'Y' THEN 'STREAMING' ELSE 'RATED' END AS media_outlet_type"""


def eligibility(kind: int, views: str = "(SELECT media_outlet_id AS home_outlet_id, media_outlet_id FROM {media_outlet})") -> str:
    targets = "p.target_demo_id IS NULL" if kind == 2 else "p.target_demo_id IS NULL OR p.target_segment IS NULL OR p.target_frequency IS NULL"
    event = "AND p.subevent_id IN (SELECT subevent_id FROM {subevent} WHERE optimization_type = 'O')" if kind == 2 else ""
    return f"""WITH newest AS (SELECT plan_id, max(plan_version_id) AS v FROM {{plan_version}} GROUP BY 1),
    base AS (SELECT p.* EXCLUDE (plan_id), w.home_outlet_id, q.period_id, q.name AS quarter_name, q.start_date AS quarter_start, q.end_date AS quarter_end, h.plan_id AS home, h.plan_status_id AS home_status
        FROM {{project}} p JOIN {{cal_period}} q ON q.period_type = 'Q' AND p.start_date BETWEEN q.start_date AND q.end_date
        JOIN {views} w ON w.media_outlet_id = p.media_outlet_id
        LEFT JOIN {{plan}} h ON h.media_outlet_id = w.home_outlet_id AND h.period_id = q.period_id AND h.plan_type = {kind} AND h.active_yn = 'Y'
        WHERE p.is_active = 'Y' AND p.project_type = {kind} {event}),
    elsewhere AS (
        SELECT DISTINCT b.project_id, b.home_outlet_id, o.name AS plan_name FROM base b
        JOIN {{plan}} o ON o.media_outlet_id = b.home_outlet_id AND o.plan_type = {kind} AND o.active_yn = 'Y' AND o.plan_id <> b.home
        JOIN newest n ON n.plan_id = o.plan_id JOIN {{plan_project}} pp ON pp.plan_id = o.plan_id AND pp.plan_version_id = n.v AND pp.project_id = b.project_id),
    opt AS (
        SELECT b.project_id, b.home_outlet_id, pv.optimization_type FROM base b
        JOIN (SELECT plan_id, project_id, max(plan_version_id) AS v FROM {{plan_project}} WHERE optimize_yn = 'Y' GROUP BY 1, 2) s ON s.plan_id = b.home AND s.project_id = b.project_id
        JOIN {{plan_version}} pv ON pv.plan_id = s.plan_id AND pv.plan_version_id = s.v JOIN newest n ON n.plan_id = b.home
        JOIN {{plan_project}} x ON x.plan_id = b.home AND x.project_id = b.project_id AND x.plan_version_id = CASE WHEN b.home_status <> 3 THEN n.v - 1 ELSE n.v END)
    SELECT p.project_id, p.name AS project_name, p.start_date AS project_start_date, p.end_date AS project_end_date, p.premiere_date, p.priority, p.target_demo_id,
        rd.name AS demo_name, p.target_segment, sg.segment_name, p.target_frequency, p.target_reach, p.target_grp, p.media_outlet_id, mo.short_name AS media_outlet_name,
        ct.name AS campaign_type, ct.display_seq, {no_of_weeks('p.start_date', 'p.end_date')} AS no_of_weeks, p.user_comment, p.scatter_imps, et.event_type_name,
        se.subevent_name, p.is_episodic, p.quarter_name, p.quarter_start, p.quarter_end, e.plan_name, CASE WHEN {targets} THEN 4 ELSE 0 END AS target_metrics_chk,
        CASE WHEN p.premiere_date <> p.end_date THEN 5 ELSE 0 END AS premiere_date_chk, CASE WHEN e.plan_name IS NOT NULL THEN 7 ELSE 0 END AS cross_qtr_chk,
        coalesce(o.optimization_type, -1) AS optimization_type_chk, v1.validation_message AS target_metrics_chk_msg, v2.validation_message AS premiere_date_chk_msg,
        replace(v4.validation_message, '<>', e.plan_name) AS cross_qtr_chk_msg, od.demo_id AS network_default_demo_id, nd.name AS network_default_demo, p.home_outlet_id
    FROM base p LEFT JOIN elsewhere e ON e.project_id = p.project_id AND e.home_outlet_id = p.home_outlet_id
    LEFT JOIN opt o ON o.project_id = p.project_id AND o.home_outlet_id = p.home_outlet_id
    JOIN {{outlet_demo}} od ON od.media_outlet_id = p.media_outlet_id AND od.default_yn = 'Y' JOIN {{demo}} nd ON nd.demo_id = od.demo_id
    LEFT JOIN {{map_validation}} v1 ON v1.validation_id = CASE WHEN {targets} THEN 4 ELSE 0 END
    LEFT JOIN {{map_validation}} v2 ON v2.validation_id = CASE WHEN p.premiere_date <> p.end_date THEN 5 ELSE 0 END
    LEFT JOIN {{map_validation}} v4 ON v4.validation_id = CASE WHEN e.plan_name IS NOT NULL THEN 7 ELSE 0 END
    LEFT JOIN {{demo}} rd ON rd.demo_id = p.target_demo_id LEFT JOIN {{segment}} sg ON sg.segment_id = p.target_segment
    LEFT JOIN {{media_outlet}} mo ON mo.media_outlet_id = p.media_outlet_id LEFT JOIN {{campaign_type}} ct ON ct.campaign_type_id = p.campaign_type_id
    LEFT JOIN {{event_type}} et ON et.event_type_id = p.event_type_id LEFT JOIN {{subevent}} se ON se.subevent_id = p.subevent_id"""


SQL = {
    "user_networks": f"""
        SELECT CAST(-1 AS BIGINT) AS user_id, {NETWORK} FROM {{media_outlet}} WHERE media_outlet_id > 0
        UNION SELECT u.user_id, n.* FROM {{user_outlet}} u JOIN (SELECT {NETWORK} FROM {{media_outlet}}) n ON n.media_outlet_id = u.media_outlet_id""",
    "cluster_networks": """
        SELECT m.media_outlet_id, c.cluster_id, c.cluster_name FROM {media_outlet} m
        LEFT JOIN (SELECT DISTINCT media_outlet_id FROM {division_network} WHERE active_yn = 'Y' AND division_id IN (
            SELECT division_id FROM {division_network} WHERE media_outlet_id = 3 AND active_yn = 'Y'
            AND division_id NOT IN (SELECT division_id FROM {division} WHERE include_in_cluster = 'N' AND active_yn = 'Y'))) t ON t.media_outlet_id = m.media_outlet_id
        JOIN {cluster} c ON c.cluster_id = CASE WHEN t.media_outlet_id = 3 THEN 1 WHEN t.media_outlet_id IS NULL THEN 3 ELSE 2 END""",
    "frequencies": "SELECT DISTINCT frequency_id, frequency AS name FROM {outlet_frequency}",
    "demo_types": """SELECT d.demo_id, d.name AS demo_type_name, o.active_yn, o.default_yn, o.media_outlet_id
        FROM {demo} d, {outlet_demo} o WHERE d.demo_id = o.demo_id AND o.active_yn = 'Y'""",
    "episodic_phases": "SELECT phase_type, description, is_active, display_seq FROM {phase} WHERE is_active = 'Y'",
    "segment_selection": """
        SELECT p.project_id, s.segment_id, s.segment_name, s.segment_type_id, st.description, s.mask,
            CAST(CASE WHEN p.segment_mask > 0 AND p.target_segment = 0 THEN CASE WHEN (s.mask & p.segment_mask) > 0 AND s.segment_type_id = 4 THEN 1 ELSE 0 END
                 WHEN p.segment_mask > 0 AND p.target_segment = 10 THEN CASE WHEN s.segment_id = 10 THEN 1 ELSE 0 END
                 ELSE CASE WHEN EXISTS (SELECT 1 FROM {segment_component} c WHERE c.component_segment_id = s.segment_id AND c.segment_id =
                     CASE WHEN p.is_segment_computed = 'N' THEN CASE p.target_segment WHEN 1 THEN 1 WHEN 2 THEN 11 WHEN 3 THEN 21 WHEN 4 THEN 31 WHEN 5 THEN 10
                          ELSE p.target_segment END ELSE p.target_segment END) THEN 1 ELSE 0 END END AS INT) AS is_selected
        FROM {project} p JOIN {segment} s ON s.segment_id <= 10 JOIN {segment_type} st ON st.segment_type_id = s.segment_type_id""",
    "network_config_errors": """
        SELECT x.media_outlet_id, x.period_id, v.validation_id, v.validation_message FROM (
            SELECT a.media_outlet_id, a.period_id, CASE WHEN (SELECT count(*) FROM {daypart} d WHERE d.media_outlet_id = a.media_outlet_id AND d.active_yn = 'Y') = 0 THEN 1 END AS err
            FROM (SELECT DISTINCT media_outlet_id, period_id FROM {plan}) a
            UNION ALL
            SELECT a.media_outlet_id, a.period_id, CASE WHEN (SELECT count(*) FROM {spots_per_hour} d WHERE d.media_outlet_id = a.media_outlet_id) = 0 THEN 3 END
            FROM (SELECT DISTINCT media_outlet_id, period_id FROM {plan}) a
            UNION ALL
            SELECT a.media_outlet_id, a.period_id, CASE WHEN count(c.capacity_id) = 0 THEN 2 END
            FROM (SELECT DISTINCT media_outlet_id, period_id FROM {plan}) a JOIN {cal_period} q ON q.period_type = 'Q' AND q.period_id = a.period_id
            LEFT JOIN {capacity} c ON c.plan_type = 1 AND c.media_outlet_id = a.media_outlet_id AND c.start_date >= q.start_date AND c.end_date <= q.end_date
            GROUP BY a.media_outlet_id, a.period_id) x JOIN {map_validation} v ON v.validation_id = x.err""",
    "project_eligibility": eligibility(1),
    "project_eligibility_events": eligibility(2),
    "project_eligibility_from_network": eligibility(1, "{network_view}"),
}
