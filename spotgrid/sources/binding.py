"""Derive the planning tables from the star-schema parquet files.

Each view is one SQL text. ``{name}`` refers to another view or to a base
parquet table. The same text feeds Spark (see ``tables.BoundTables``) and the
SQL check, so both sides start from equal inputs; only ``cal_day`` differs,
because the two engines spell a run of dates differently.

Key arithmetic in brief:

* outlet  = one of 25 networks, project = supplier, project type 1 or 2
* period  = year * 4 + quarter of the Monday of a date (quarters are whole weeks)
* plan_id = outlet * 1000000 + period * 10 + plan type
* goal id = plan_id * 100000000000 + project * 10 + episode (1 = launch)
* schedule rows are line items; their plan is the quarter of a date up to 99
  days before the spot airs, so many rows fall in a later quarter than their plan
"""

from __future__ import annotations

from string import Formatter

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Whole weeks from 99 days before the first spot airs to the last one.
CAL_DAY = {
    "spark": """
        SELECT CAST(datediff(d, lo) AS INT) AS n, d, CAST(date_trunc('week', d) AS DATE) AS monday
        FROM (SELECT lo, explode(sequence(lo, hi)) AS d
              FROM (SELECT CAST(date_trunc('week', CAST(min(l_shipdate) AS DATE) - 99) AS DATE) AS lo,
                           CAST(date_trunc('week', CAST(max(l_shipdate) AS DATE)) AS DATE) + 6 AS hi FROM {lineitem}) b) x""",
    "duckdb": """
        SELECT CAST(d - lo AS INT) AS n, d, CAST(date_trunc('week', d) AS DATE) AS monday
        FROM (SELECT lo, CAST(unnest(generate_series(lo, hi, INTERVAL '1' DAY)) AS DATE) AS d
              FROM (SELECT CAST(date_trunc('week', CAST(min(l_shipdate) AS DATE) - 99) AS DATE) AS lo,
                           CAST(date_trunc('week', CAST(max(l_shipdate) AS DATE)) AS DATE) + 6 AS hi FROM {lineitem}) b) x""",
}

_QTR_NAME = "CAST(quarter(monday) AS STRING) || 'Q' || substr(CAST(year(monday) AS STRING), 3, 2)"

VIEWS: dict[str, str] = {
    # --- calendar -----------------------------------------------------------
    "cal_period": f"""
        SELECT CAST(year(monday) * 4 + quarter(monday) AS INT) AS period_id, 'Q' AS period_type,
               {_QTR_NAME} AS name, {_QTR_NAME} AS fiscal_qtr,
               min(d) AS start_date, max(d) AS end_date
        FROM {{cal_day}} GROUP BY year(monday), quarter(monday)
        UNION ALL
        SELECT CAST(1000000 + n AS INT), 'W', 'W' || CAST(n AS STRING), {_QTR_NAME}, d, d + 6
        FROM {{cal_day}} WHERE d = monday
        UNION ALL
        SELECT CAST(2000000 + n AS INT), 'D', 'D' || CAST(n AS STRING), {_QTR_NAME}, d, d
        FROM {{cal_day}}""",
    # --- networks, audiences, segments, dayparts -----------------------------
    "media_outlet": """
        SELECT n_nationkey + 1 AS media_outlet_id, n_name AS name,
               'NET' || CAST(n_nationkey + 1 AS STRING) AS short_name,
               'EXT' || CAST(n_nationkey + 1 AS STRING) AS external_short_name,
               n_nationkey + 1001 AS cable_network_id,
               CASE WHEN n_nationkey % 3 = 0 THEN 'N' ELSE 'Y' END AS rated_yn,
               CASE WHEN n_nationkey % 6 IN (0, 1) THEN 'Y' ELSE 'N' END AS streaming_yn
        FROM {nation}""",
    "division": """
        SELECT r_regionkey + 1 AS division_id, r_name AS name,
               CASE WHEN r_regionkey = 4 THEN 'N' ELSE 'Y' END AS include_in_cluster, 'Y' AS active_yn
        FROM {region}""",
    "division_network": """
        SELECT n_regionkey + 1 AS division_id, n_nationkey + 1 AS media_outlet_id,
               CASE WHEN n_nationkey % 7 = 6 THEN 'N' ELSE 'Y' END AS active_yn
        FROM {nation}""",
    "network_view": """
        SELECT n_nationkey + 1 AS home_outlet_id, n_nationkey + 1 AS media_outlet_id FROM {nation}
        UNION ALL SELECT n_nationkey + 1, (n_nationkey + 1) % 25 + 1 FROM {nation}""",
    "cluster": """
        SELECT * FROM (VALUES (1, 'Own network'), (2, 'Same division'), (3, 'Other'))
        AS v(cluster_id, cluster_name)""",
    "demo": """
        SELECT r_regionkey + 1 AS demo_id, 'Demo ' || r_name AS name,
               CAST(100000 * (r_regionkey + 1) AS BIGINT) AS universe FROM {region}""",
    "outlet_demo": """
        SELECT media_outlet_id, demo_id,
               CASE WHEN media_outlet_id % 4 = 1 AND demo_id = (media_outlet_id + 2) % 5 + 1 THEN 'N' ELSE 'Y' END AS active_yn,
               CASE WHEN demo_id = media_outlet_id % 5 + 1 THEN 'Y' ELSE 'N' END AS default_yn
        FROM (SELECT DISTINCT c_nationkey + 1 AS media_outlet_id,
                     CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
                          WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS demo_id
              FROM {customer}) x""",
    "outlet_frequency": """
        SELECT DISTINCT n_nationkey + 1 AS media_outlet_id, CAST(s_suppkey % 3 + 1 AS INT) AS frequency_id,
               CAST(s_suppkey % 3 + 1 AS INT) AS frequency
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "segment": """
        SELECT segment_id, 'Segment ' || CAST(segment_id AS STRING) AS segment_name,
               CASE WHEN segment_id <= 5 THEN 4 WHEN segment_id <= 9 THEN 2 WHEN segment_id <= 12 THEN 3 ELSE 1 END AS segment_type_id,
               CAST(CASE WHEN segment_id <= 9 THEN power(2, segment_id - 1) WHEN segment_id = 10 THEN 511
                    WHEN segment_id = 11 THEN 31 WHEN segment_id = 12 THEN 480 ELSE 1000 + segment_id END AS BIGINT) AS mask
        FROM (SELECT DISTINCT p_size AS segment_id FROM {part}) x""",
    "segment_type": """
        SELECT * FROM (VALUES (1, 'Computed'), (2, 'Late'), (3, 'Total'), (4, 'Day')) AS v(segment_type_id, description)""",
    "segment_component": """
        SELECT DISTINCT p_size AS segment_id,
               CAST(CASE WHEN p_size <= 9 THEN p_size ELSE p_partkey % 9 + 1 END AS INT) AS component_segment_id
        FROM {part}""",
    "daypart": """
        SELECT media_outlet_id * 10 + k AS daypart_id, media_outlet_id, 'Daypart ' || CAST(k AS STRING) AS name,
               CASE WHEN k = 7 AND media_outlet_id % 5 = 0 THEN 'N' ELSE 'Y' END AS active_yn,
               21600 + (k - 1) * 10800 AS start_offset, 21600 + k * 10800 - 1 AS end_offset
        FROM (SELECT DISTINCT c_nationkey + 1 AS media_outlet_id, CAST(c_custkey % 7 + 1 AS INT) AS k
              FROM {customer}) x""",
    "spots_per_hour": """
        SELECT media_outlet_id, air_hour, CAST(2 + media_outlet_id % 3 + air_hour % 2 AS DECIMAL(9,2)) AS spots
        FROM (SELECT DISTINCT s_nationkey + 1 AS media_outlet_id, CAST(s_suppkey % 24 AS INT) AS air_hour
              FROM {supplier}) x""",
    "map_validation": """
        SELECT * FROM (VALUES (1, 'Dayparts are not set up'), (2, 'Capacity is not loaded'),
            (3, 'Spots per hour are not set up'), (4, 'Target metrics are missing'),
            (5, 'Premiere and end date differ'), (7, 'Project is part of plan <>')) AS v(validation_id, validation_message)""",
    "plan_status": """
        SELECT * FROM (VALUES (0, 'Draft', 'D'), (1, 'Submitted', 'S'), (2, 'In progress', 'I'), (3, 'Complete', 'C'),
            (7, 'Failed', 'F'), (9, 'Optimized', 'O'), (10, 'Planned', 'P'), (11, 'Changed', 'X'), (12, 'New', 'N'))
            AS v(plan_status_id, name, code)""",
    "phase": """
        SELECT phase_type, description, CASE WHEN phase_type = 4 THEN 'N' ELSE 'Y' END AS is_active, 6 - phase_type AS display_seq
        FROM (SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INT) AS phase_type, substr(o_orderpriority, 3) AS description FROM {orders}) x""",
    "campaign_type": """
        SELECT * FROM (VALUES (1, 'Series', 3), (2, 'Movie', 1), (3, 'Special', 2), (4, 'Event', 4))
            AS v(campaign_type_id, name, display_seq)""",
    "event_type": """
        SELECT * FROM (VALUES (1, 'Sports'), (2, 'Awards'), (3, 'Holiday')) AS v(event_type_id, event_type_name)""",
    "subevent": """
        SELECT * FROM (VALUES (1, 'Final', 'O'), (2, 'Qualifier', 'O'), (3, 'Gala', 'D'), (4, 'Parade', 'D'))
            AS v(subevent_id, subevent_name, optimization_type)""",
    # --- projects and users --------------------------------------------------
    "project": """
        SELECT s_suppkey + 1 AS project_id, s_name AS name, CAST(s_suppkey % 25 + 1 AS INT) AS media_outlet_id,
               CASE WHEN s_suppkey % 100 >= 75 THEN 2 ELSE 1 END AS project_type,
               s_nationkey % 5 + 1 AS campaign_type_id,
               DATE '1995-01-02' + CAST(s_suppkey * 37 % 2400 AS INT) AS start_date,
               CAST(s_suppkey % 24 * 3600 AS INT) AS start_offset,
               DATE '1995-01-09' + CAST(s_suppkey * 37 % 2400 + s_suppkey % 120 AS INT) AS end_date,
               CAST(s_suppkey % 20 * 3600 + 1800 AS INT) AS end_offset,
               DATE '1995-01-09' + CAST(s_suppkey * 37 % 2400 + s_suppkey % 120 + CASE WHEN s_suppkey % 6 = 0 THEN 1 ELSE 0 END AS INT) AS premiere_date,
               CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE CAST(s_suppkey % 5 + 1 AS INT) END AS target_demo_id,
               CAST(CASE WHEN s_suppkey % 13 = 0 THEN NULL WHEN s_suppkey % 7 = 0 THEN 0 ELSE s_suppkey % 10 + 1 END AS INT) AS target_segment,
               CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE CAST(s_suppkey % 3 + 1 AS INT) END AS target_frequency,
               CAST(s_suppkey % 80 AS DECIMAL(18,2)) AS target_reach,
               CAST(CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE s_suppkey % 300 END AS DECIMAL(18,2)) AS target_grp,
               CAST(s_suppkey % 512 AS BIGINT) AS segment_mask,
               CASE WHEN s_suppkey % 2 = 0 THEN 'N' ELSE 'Y' END AS is_segment_computed,
               CASE WHEN s_suppkey % 19 = 0 THEN 'N' ELSE 'Y' END AS is_active,
               CASE WHEN s_suppkey % 3 = 0 THEN 'Y' ELSE 'N' END AS is_episodic,
               CAST(s_suppkey % 9 + 1 AS INT) AS priority, 'note ' || s_name AS user_comment,
               CAST(s_acctbal AS DECIMAL(18,2)) AS scatter_imps,
               CAST(s_suppkey % 4 + 1 AS INT) AS event_type_id, CAST(s_suppkey % 5 + 1 AS INT) AS subevent_id,
               CAST((s_suppkey % 25 + 1) * 1000000 + (7980 + s_suppkey % 28) * 10 + CASE WHEN s_suppkey % 100 >= 75 THEN 2 ELSE 1 END AS BIGINT) AS plan_id
        FROM {supplier}""",
    "geo_project": """
        SELECT s_suppkey + 1 AS project_id, CAST(s_suppkey % 25 + 1 AS INT) AS media_outlet_id,
               'Geo ' || CAST(s_nationkey AS STRING) AS geo_plan_name, CASE WHEN s_acctbal > 5000 THEN 'Y' ELSE 'N' END AS active_yn
        FROM {supplier}""",
    "project_list": """
        SELECT o_orderkey AS request_id, CAST(o_custkey % 25 + 1 AS INT) AS media_outlet_id,
               '[' || CAST(o_custkey % 25 + 1 AS STRING) || ', ' || CAST(o_custkey % 25 + 26 AS STRING)
                   || ', ' || CAST(o_orderkey % 90 + 1 AS STRING) || ']' AS project_ids_json
        FROM {orders}""",
    "sec_user": """
        SELECT c_custkey + 1 AS user_id, 'First' || CAST(c_custkey AS STRING) AS first_name, c_name AS last_name,
               'user' || CAST(c_custkey AS STRING) || '@example.org' AS user_name
        FROM {customer}""",
    "user_outlet": """
        SELECT c_custkey + 1 AS user_id, c_nationkey + 1 AS media_outlet_id FROM {customer}
        UNION
        SELECT c_custkey + 1, CAST(c_custkey % 25 + 1 AS INT) FROM {customer}""",
    # --- facts ----------------------------------------------------------------
    "spot_line": """
        SELECT CAST(media_outlet_id AS BIGINT) * 1000000 + (year(monday) * 4 + quarter(monday)) * 10 + plan_type AS plan_id, *
        FROM (SELECT l_suppkey + 1 AS project_id, CAST(l_suppkey % 25 + 1 AS INT) AS media_outlet_id,
                     CASE WHEN l_suppkey % 100 >= 75 THEN 2 ELSE 1 END AS plan_type,
                     CAST(date_trunc('week', CAST(l_shipdate AS DATE) - CAST(l_orderkey % 100 AS INT)) AS DATE) AS monday,
                     CAST(l_shipdate AS DATE) AS start_date, l_linenumber, l_orderkey, l_partkey,
                     CAST(l_quantity AS BIGINT) AS planned_units,
                     CAST(l_extendedprice AS DECIMAL(8,2)) AS planned_grp
              FROM {lineitem}) x""",
    "schedule": """
        SELECT plan_id, CASE WHEN l_orderkey % 30 = 1 THEN 1 ELSE 0 END AS plan_version_id, project_id,
               plan_id * 100000000000 + project_id * 10 + 1 AS campaign_goal_id, media_outlet_id,
               CAST(media_outlet_id * 10 + l_partkey % 7 + 1 AS INT) AS daypart_id,
               CAST(project_id % 5 + 1 AS INT) AS demo_id, start_date, start_date AS end_date, planned_units, planned_grp,
               CASE WHEN l_orderkey % 20 = 0 THEN 'N' ELSE 'Y' END AS active_yn
        FROM {spot_line} WHERE l_linenumber <= 4""",
    "schedule_episode": """
        SELECT plan_id, CASE WHEN l_orderkey % 30 = 1 THEN 1 ELSE 0 END AS plan_version_id, project_id,
               l_linenumber - 3 AS episode_id,
               plan_id * 100000000000 + project_id * 10 + l_linenumber - 3 AS campaign_goal_id, media_outlet_id,
               CAST(media_outlet_id * 10 + l_partkey % 7 + 1 AS INT) AS daypart_id,
               CAST(project_id % 5 + 1 AS INT) AS demo_id, start_date, start_date AS end_date, planned_units, planned_grp,
               CASE WHEN l_orderkey % 20 = 0 THEN 'N' ELSE 'Y' END AS active_yn
        FROM {spot_line} WHERE l_linenumber > 4""",
    "run_line": """
        SELECT CAST(media_outlet_id AS BIGINT) * 1000000 + (year(monday) * 4 + quarter(monday)) * 10 + plan_type AS plan_id,
               year(monday) * 4 + quarter(monday) AS period_id, *
        FROM (SELECT CAST(o_custkey % 25 + 1 AS INT) AS media_outlet_id, CASE WHEN o_orderkey % 4 = 3 THEN 2 ELSE 1 END AS plan_type,
                     CAST(date_trunc('week', CAST(o_orderdate AS DATE)) AS DATE) AS monday,
                     CAST(o_orderdate AS DATE) AS order_date, o_orderkey, o_custkey, o_orderstatus, o_orderdate,
                     CAST(o_totalprice AS DECIMAL(18,2)) AS price
              FROM {orders}) x""",
    "plan": """
        SELECT plan_id, media_outlet_id, CAST(period_id AS INT) AS period_id, plan_type,
               'Map ' || CAST(plan_id AS STRING) || CASE WHEN media_outlet_id % 2 = 0 THEN '-v1' ELSE '' END AS name,
               CASE CAST((media_outlet_id + period_id) % 5 AS INT) WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN 7 WHEN 3 THEN 3 ELSE 2 END AS plan_status_id,
               CASE WHEN (media_outlet_id + period_id) % 23 = 0 THEN 'N' ELSE 'Y' END AS active_yn,
               CASE WHEN period_id <= 7990 THEN 'N' ELSE 'Y' END AS checked_yn,
               CASE WHEN period_id % 2 = 0 THEN 'reviewed' ELSE NULL END AS comments,
               min(o_orderdate) AS create_ts, max(o_orderdate) AS update_ts, CAST(max(o_custkey) + 1 AS BIGINT) AS update_user
        FROM {run_line} GROUP BY plan_id, media_outlet_id, period_id, plan_type""",
    "model_exec": """
        SELECT o_orderkey + 1 AS model_exec_id, plan_id, CAST(floor(o_orderkey / 4) AS BIGINT) % 4 AS plan_version_id, media_outlet_id,
               CASE WHEN o_orderkey % 50 = 0 THEN 2 WHEN plan_type = 1 THEN 1 ELSE 3 END AS model_type_id,
               CASE o_orderstatus WHEN 'F' THEN 'C' WHEN 'O' THEN 'P' ELSE 'IC' END AS exec_status_cd,
               o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) + INTERVAL '1' MINUTE * CAST(o_orderkey % 60 AS INT) AS exec_end_ts,
               CAST(o_custkey + 1 AS BIGINT) AS user_id, 'K' || CAST(o_orderkey AS STRING) AS opt_process_key
        FROM {run_line}""",
    "plan_version": """
        SELECT plan_id, plan_version_id, 'Version ' || CAST(plan_version_id AS STRING) AS version_name,
               CAST((plan_id + plan_version_id) % 2 AS INT) AS optimization_type, max(model_exec_id) AS model_exec_id, 'Y' AS active_yn,
               min(user_id) AS create_user, min(exec_end_ts) AS create_ts, max(user_id) AS update_user, max(exec_end_ts) AS update_ts
        FROM {model_exec} GROUP BY plan_id, plan_version_id""",
    "log_version": """
        SELECT o_orderkey AS log_version_id, o_orderkey AS log_id, CASE WHEN o_orderkey % 3 = 0 THEN 15 ELSE 10 END AS status,
               CAST(o_orderkey % 9 AS INT) AS sub_log_version_id FROM {orders}""",
    "log": """
        SELECT o_orderkey AS log_id, CAST(o_custkey % 25 + 1 AS INT) AS media_outlet_id, CAST(o_orderdate AS DATE) AS broadcast_date FROM {orders}""",
    "plan_lock": """
        SELECT event_id AS lock_id, CAST(user_id % 25 + 1 AS BIGINT) * 1000000 + (7980 + event_id % 28) * 10 + 1 AS plan_id,
               CASE WHEN event_type IN ('click', 'view') THEN 'Y' ELSE 'N' END AS flag, user_id AS lock_user, ts AS lock_ts
        FROM {events}""",
    # --- plan contents ---------------------------------------------------------
    "plan_project_key": """
        SELECT plan_id, project_id, media_outlet_id, plan_type, min(start_date) AS first_date, max(start_date) AS last_date
        FROM {spot_line} GROUP BY plan_id, project_id, media_outlet_id, plan_type""",
    "plan_project": """
        SELECT k.plan_id, v.plan_version_id, k.project_id,
               CAST(CASE (k.project_id + v.plan_version_id * 3 + k.plan_id) % 7 WHEN 0 THEN 2 WHEN 1 THEN 9 WHEN 2 THEN 10 WHEN 3 THEN 10
                    WHEN 4 THEN 9 WHEN 5 THEN 11 ELSE 12 END AS INT) AS status_cd,
               CASE WHEN (k.project_id + v.plan_version_id) % 3 = 0 THEN 'N' ELSE 'Y' END AS optimize_yn,
               CASE WHEN (k.project_id + v.plan_version_id) % 5 = 0 THEN 'Y' ELSE 'N' END AS is_dirty,
               CASE WHEN (k.project_id + k.plan_id) % 29 = 0 THEN 'N' ELSE 'Y' END AS is_active,
               CAST(k.project_id % 40 AS INT) AS display_seq, CAST(k.project_id % 9 + 1 AS INT) AS priority,
               CAST(k.project_id % 5 AS INT) AS episode_priority, CAST(k.project_id % 4 AS INT) AS no_of_episode,
               CAST((k.project_id * 3 + v.plan_version_id) % 90 AS DECIMAL(18,2)) AS target_reach_pct,
               CAST((k.project_id * 7 + v.plan_version_id) % 300 AS DECIMAL(18,2)) AS target_grp,
               CAST((k.project_id * 5 + v.plan_version_id) % 95 AS DECIMAL(18,2)) AS proj_reach_pct,
               CAST((k.project_id * 11 + v.plan_version_id) % 400 AS DECIMAL(18,2)) AS proj_grp,
               CAST(k.project_id % 12 + 1 AS INT) AS segment_id, CAST(k.project_id % 2 + 1 AS INT) AS frequency,
               CAST(k.project_id % 5 + 1 AS INT) AS demo_id,
               CASE WHEN k.project_id % 4 = 0 THEN NULL ELSE CAST(k.project_id % 4 AS INT) END AS cluster_id,
               CAST(k.project_id % 3 + 1 AS INT) AS phase_type,
               k.first_date AS on_map_start,
               CASE WHEN k.project_id % 9 = 4 THEN least(k.first_date + 3, k.last_date)
                    ELSE k.last_date + CAST(CASE WHEN v.plan_version_id = 2 THEN k.project_id % 3 ELSE 0 END AS INT) END AS on_map_end,
               k.last_date AS on_map_premiere,
               CASE WHEN (k.project_id + v.plan_version_id) % 4 = 0 THEN NULL ELSE k.plan_id * 10000000000 + k.project_id END AS campaign_id,
               CASE WHEN (k.project_id + v.plan_version_id) % 4 = 0 THEN NULL ELSE k.plan_id * 100000000000 + k.project_id * 10 + 1 END AS campaign_goal_id,
               CASE WHEN (k.project_id + v.plan_version_id) % 3 = 1 THEN NULL ELSE k.first_date - 35 END AS measured_start,
               CASE WHEN (k.project_id + v.plan_version_id) % 3 = 1 THEN NULL ELSE k.last_date - 35 END AS measured_end,
               CAST(k.project_id % 37 AS INT) AS planned_spots, CAST(k.project_id % 46 AS DECIMAL(18,2)) AS guide_reach_pct,
               CAST(k.project_id % 210 AS DECIMAL(18,2)) AS guide_grp, CAST(k.project_id % 39 AS INT) AS guide_spots,
               CAST(k.project_id % 5 + 1 AS INT) AS network_target_demo_id, 4 AS segment_type_id, CAST(k.project_id % 512 AS BIGINT) AS segment_mask,
               CAST(k.first_date AS TIMESTAMP) + INTERVAL '6' HOUR AS on_map_start_ts, CAST(k.last_date AS TIMESTAMP) + INTERVAL '23' HOUR AS on_map_end_ts,
               CAST(k.media_outlet_id AS BIGINT) AS create_user, CAST(k.first_date AS TIMESTAMP) AS create_ts,
               CAST(k.media_outlet_id + 1 AS BIGINT) AS update_user, CAST(k.first_date AS TIMESTAMP) AS update_ts,
               'pp ' || CAST(k.project_id AS STRING) AS user_comment
        FROM {plan_project_key} k JOIN {plan_version} v ON k.plan_id = v.plan_id""",
    "episode_key": """
        SELECT plan_id, project_id, media_outlet_id, l_linenumber - 3 AS episode_id,
               min(start_date) AS first_date, max(start_date) AS last_date
        FROM {spot_line} WHERE l_linenumber > 4 GROUP BY plan_id, project_id, media_outlet_id, l_linenumber""",
    "plan_project_episode": """
        SELECT k.plan_id, v.plan_version_id, k.project_id, k.episode_id,
               CAST((k.project_id + k.episode_id) % 60 AS INT) AS tgt_spots,
               CAST(CASE WHEN k.project_id % 2 = 0 THEN NULL ELSE (k.project_id + k.episode_id) % 50 END AS DECIMAL(18,2)) AS target_grp,
               CAST(k.last_date AS TIMESTAMP) + INTERVAL '1' HOUR * CAST(k.project_id % 24 AS INT) AS episode_start_ts,
               CAST(CASE (k.project_id + k.episode_id + v.plan_version_id) % 5 WHEN 0 THEN 9 WHEN 1 THEN 10 WHEN 2 THEN 11 WHEN 3 THEN 12 ELSE 9 END AS INT) AS status_cd,
               CASE WHEN (k.project_id + k.episode_id) % 3 = 0 THEN 'N' ELSE 'Y' END AS optimize_yn, 'Y' AS is_active,
               k.first_date AS on_map_start, k.last_date AS on_map_end,
               CASE WHEN k.project_id % 4 = 0 THEN NULL ELSE CAST(k.project_id % 4 AS INT) END AS cluster_id,
               CAST(k.project_id % 9 + 1 AS INT) AS priority,
               CAST((k.project_id * 5 + v.plan_version_id) % 95 AS DECIMAL(18,2)) AS proj_reach_pct,
               CAST((k.project_id * 11 + v.plan_version_id) % 400 AS DECIMAL(18,2)) AS proj_grp,
               CASE WHEN (k.project_id + v.plan_version_id) % 5 = 0 THEN NULL ELSE k.plan_id * 10000000000 + k.project_id END AS campaign_id,
               CASE WHEN (k.project_id + v.plan_version_id) % 5 = 0 THEN NULL
                    ELSE k.plan_id * 100000000000 + k.project_id * 10 + k.episode_id END AS campaign_goal_id,
               CASE WHEN (k.project_id + k.episode_id) % 3 = 1 THEN NULL ELSE k.first_date - 35 END AS measured_start,
               CASE WHEN (k.project_id + k.episode_id) % 3 = 1 THEN NULL ELSE k.last_date - 35 END AS measured_end
        FROM {episode_key} k JOIN {plan_version} v ON k.plan_id = v.plan_id""",
    "plan_project_spots": """
        SELECT w.plan_id, v.plan_version_id, w.project_id, w.week_date, w.units + v.plan_version_id AS unit_count
        FROM (SELECT plan_id, project_id, CAST(date_trunc('week', start_date) AS DATE) AS week_date,
                     CAST(sum(planned_units) AS BIGINT) AS units
              FROM {spot_line} WHERE l_linenumber <= 4
              GROUP BY plan_id, project_id, CAST(date_trunc('week', start_date) AS DATE)) w
        JOIN {plan_version} v ON w.plan_id = v.plan_id""",
    "plan_project_spots_episode": """
        SELECT w.plan_id, v.plan_version_id, w.project_id, w.episode_id, w.week_date, w.units + v.plan_version_id AS unit_count
        FROM (SELECT plan_id, project_id, l_linenumber - 3 AS episode_id, CAST(date_trunc('week', start_date) AS DATE) AS week_date,
                     CAST(sum(planned_units) AS BIGINT) AS units
              FROM {spot_line} WHERE l_linenumber > 4
              GROUP BY plan_id, project_id, l_linenumber, CAST(date_trunc('week', start_date) AS DATE)) w
        JOIN {plan_version} v ON w.plan_id = v.plan_id""",
    "plan_project_spots_episode_map": """
        SELECT plan_id, plan_version_id, project_id, episode_id, week_date, unit_count + 1 AS unit_count, week_date AS episode_start_date,
               week_date + 6 AS episode_end_date, week_date + 2 AS broadcast_date, CAST(week_date AS TIMESTAMP) + INTERVAL '19' HOUR AS episode_start_ts
        FROM {plan_project_spots_episode}""",
    "campaign": """
        SELECT plan_id * 10000000000 + project_id AS campaign_id, project_id, 'Campaign ' || CAST(project_id AS STRING) AS name, plan_id
        FROM {plan_project_key}""",
    "campaign_goal": """
        SELECT plan_id * 100000000000 + project_id * 10 + 1 AS campaign_goal_id, plan_id * 10000000000 + project_id AS campaign_id,
               plan_id, project_id, media_outlet_id, CAST(project_id % 5 + 1 AS INT) AS demo_id,
               CAST(project_id % 12 + 1 AS INT) AS segment_id, CAST(project_id % 2 + 1 AS INT) AS frequency,
               first_date AS start_date, first_date + 2 AS end_date, '06:00:00' AS start_time, '20:30:00' AS end_time
        FROM {plan_project_key}""",
    "campaign_goal_episode": """
        SELECT plan_id * 100000000000 + project_id * 10 + episode_id AS campaign_goal_id, plan_id * 10000000000 + project_id AS campaign_id,
               plan_id, project_id, episode_id, media_outlet_id, CAST(project_id % 5 + 1 AS INT) AS demo_id,
               CAST(project_id % 12 + 1 AS INT) AS segment_id, CAST(project_id % 2 + 1 AS INT) AS frequency,
               first_date AS start_date, first_date + 2 AS end_date, '06:00:00' AS start_time, '20:30:00' AS end_time
        FROM {episode_key}""",
    "stg_episode_json": """
        SELECT k.plan_id AS uid, k.project_id,
               '[{{"PROJECT_ID":' || CAST(k.project_id AS STRING) || ',"EPISODE_NUM":2,"TARGET_GRP":' || CAST(k.project_id % 50 AS STRING)
               || ',"TARGET_SPOT":' || CAST(k.project_id % 30 AS STRING) || ',"START_TS":"' || CAST(k.first_date AS STRING)
               || '","END_TS":"' || CAST(k.last_date AS STRING) || '","EPISODE_START_TS":"' || CAST(k.last_date AS STRING) || ' 20:00:00","chkSelectRow":true}},'
               || '{{"PROJECT_ID":' || CAST(k.project_id AS STRING) || ',"EPISODE_NUM":3,"TARGET_GRP":null,"TARGET_SPOT":'
               || CAST(k.project_id % 70 AS STRING) || ',"START_TS":"' || CAST(k.first_date + 3 AS STRING)
               || '","END_TS":"' || CAST(k.last_date + 3 AS STRING) || '","EPISODE_START_TS":"' || CAST(k.last_date AS STRING) || ' 21:30:00","chkSelectRow":'
               || CASE WHEN k.project_id % 2 = 0 THEN 'true' ELSE 'false' END
               || CASE WHEN k.first_date = k.last_date THEN '}}' ELSE '}}]' END AS episode_dtl_json
        FROM {plan_project_key} k""",
    "episode_json": """
        SELECT s.uid AS plan_id, v.plan_version_id, s.project_id, s.episode_dtl_json
        FROM {stg_episode_json} s JOIN {plan_version} v ON s.uid = v.plan_id""",
    # --- capacity ----------------------------------------------------------------
    "capacity": """
        SELECT o_orderkey + 1 AS capacity_id, plan_type, media_outlet_id, CAST(media_outlet_id * 10 + o_orderkey % 7 + 1 AS INT) AS daypart_id,
               order_date AS start_date, order_date AS end_date, CAST(o_orderkey % 5 + 3 AS BIGINT) AS capacity_per_hour
        FROM {run_line}""",
    "capacity_grp": """
        SELECT o_orderkey + 1 AS capacity_id,
               CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 5 + 1 AS INT) ELSE media_outlet_id % 5 + 1 END AS demo_id,
               price AS grp_capacity
        FROM {run_line}""",
    "capacity_json": """
        SELECT plan_id, media_outlet_id, period_id, '[1, 2, 5]' AS week_keys,
               '{{"1":[{{"DAY_OF_WEEK":"1","DAYPART_ID":"' || CAST(media_outlet_id * 10 + 1 AS STRING) || '","MEDIA_OUTLET_ID":"' || CAST(media_outlet_id AS STRING)
               || '","CAPACITY":' || CAST(period_id % 9 AS STRING) || '}},{{"DAY_OF_WEEK":"6","DAYPART_ID":"' || CAST(media_outlet_id * 10 + 2 AS STRING)
               || '","MEDIA_OUTLET_ID":"' || CAST(media_outlet_id AS STRING) || '","CAPACITY":7}}],'
               || '"5":[{{"DAY_OF_WEEK":"3","DAYPART_ID":"' || CAST(media_outlet_id * 10 + 3 AS STRING) || '","MEDIA_OUTLET_ID":"99","CAPACITY":4}},'
               || '{{"DAY_OF_WEEK":"3","DAYPART_ID":"' || CAST(media_outlet_id * 10 + 3 AS STRING) || '","MEDIA_OUTLET_ID":"' || CAST(media_outlet_id AS STRING)
               || '","CAPACITY":5}}],"6":[]' || CASE WHEN active_yn = 'N' THEN '' ELSE '}}' END AS capacity_json
        FROM {plan}""",
    # --- reach guides --------------------------------------------------------------
    "reach_header": """
        SELECT h.reach_id, h.media_outlet_id, h.media_outlet_id % 5 + 1 AS target_demo_id, c.start_date AS base_start, c.end_date AS base_end
        FROM (SELECT DISTINCT CAST(media_outlet_id AS BIGINT) * 10000 + year(monday) AS reach_id, media_outlet_id,
                     year(monday) * 4 + 4 AS period_id FROM {run_line}) h
        JOIN {cal_period} c ON c.period_type = 'Q' AND c.period_id = h.period_id""",
    "reach_detail": """
        SELECT reach_id, segment_id, week_count, frequency, unit_count, start_date, end_date,
               CAST(10 * unit_count * (10 - frequency) + 37 * segment_id + 100 * week_count AS BIGINT) AS reach,
               CAST(100000 AS BIGINT) AS universe,
               CAST(1000 * unit_count + 11 * segment_id + 7 * week_count AS BIGINT) AS impressions,
               CAST(unit_count + segment_id AS DECIMAL(18,2)) AS cov_grp
        FROM (SELECT DISTINCT CAST(media_outlet_id AS BIGINT) * 10000 + year(start_date) AS reach_id, CAST(l_partkey % 9 + 1 AS INT) AS segment_id,
                     CAST(l_orderkey % 4 + 1 AS INT) AS week_count, CAST(l_partkey % 2 + 1 AS INT) AS frequency,
                     CAST(10 * ceil(planned_units / 5) AS INT) AS unit_count,
                     CASE WHEN l_linenumber % 2 = 0 THEN DATE '1995-01-02' ELSE DATE '1995-02-06' END AS start_date,
                     DATE '1995-02-12' + CAST(l_linenumber % 3 * 7 AS INT) AS end_date
              FROM {spot_line}) x""",
    "reach_request": """
        SELECT k.plan_id AS call_id, k.project_id,
               CASE WHEN k.project_id % 7 = 0 THEN k.media_outlet_id % 25 + 1 ELSE k.media_outlet_id END AS media_outlet_id,
               CASE WHEN k.project_id % 7 = 0 THEN (k.media_outlet_id % 25 + 1) % 5 + 1 ELSE k.media_outlet_id % 5 + 1 END AS demo_id,
               CASE WHEN k.project_id % 8 = 0 THEN NULL ELSE CAST(k.project_id % 12 + 1 AS INT) END AS segment_id,
               CAST(k.project_id % 2 + 1 AS INT) AS frequency,
               CASE CAST((k.project_id + k.plan_id) % 6 AS INT) WHEN 0 THEN 'R' WHEN 1 THEN 'G' WHEN 2 THEN 'S' WHEN 3 THEN 'ER' WHEN 4 THEN 'EG' ELSE 'ES' END AS calc_based_on,
               CAST((k.project_id * 13 + k.plan_id) % 12 AS DECIMAL(18,2)) AS target_reach_pct,
               CAST((k.project_id * 17 + k.plan_id) % 130 AS DECIMAL(18,2)) AS target_grps,
               CAST((k.project_id * 19 + k.plan_id) % 120 AS INT) AS planned_spot,
               k.first_date AS flight_start, k.last_date AS flight_end, q.start_date AS qtr_start
        FROM {plan_project_key} k
        JOIN {plan} p ON p.plan_id = k.plan_id
        JOIN {cal_period} q ON q.period_type = 'Q' AND q.period_id = p.period_id""",
    # --- save staging ----------------------------------------------------------------
    "save_request": """
        SELECT CAST(media_outlet_id AS BIGINT) * 1000000 + (period_id + 1) * 10 + plan_type AS uid, media_outlet_id, period_id + 1 AS period_id,
               plan_type, 'Saved ' || CAST(media_outlet_id AS STRING) || CASE WHEN period_id % 3 = 0 THEN '-v2' ELSE '' END AS map_name,
               CAST(media_outlet_id AS BIGINT) AS user_id, CAST(period_id % 2 AS INT) AS optimization_type
        FROM {plan} WHERE active_yn = 'Y'""",
    "stg_plan_project": """
        SELECT plan_id AS uid, project_id,
               CAST(CASE WHEN project_id % 5 = 0 THEN 0 ELSE project_id % 70 END AS DECIMAL(18,2)) AS target_reach,
               CAST(project_id % 200 AS DECIMAL(18,2)) AS target_grp, CAST(project_id % 33 AS INT) AS planned_spots,
               CAST(project_id % 44 AS DECIMAL(18,2)) AS guide_reach_pct,
               CASE WHEN project_id % 3 = 0 THEN 'Y' ELSE 'N' END AS optimize_yn, CASE WHEN project_id % 4 = 0 THEN 'Y' ELSE 'N' END AS is_dirty,
               CASE WHEN project_id % 5 = 1 THEN NULL ELSE CAST(10 - project_id % 2 AS INT) END AS status_cd,
               CAST(project_id % 40 AS INT) AS display_seq, CAST(project_id % 9 + 1 AS INT) AS priority,
               CASE WHEN project_id % 4 = 0 THEN NULL ELSE CAST(project_id % 4 AS INT) END AS cluster_id,
               CASE WHEN project_id % 3 = 1 THEN NULL ELSE CAST(project_id % 12 + 1 AS INT) END AS segment_id,
               4 AS segment_type_id,
               CAST(CASE project_id % 4 WHEN 0 THEN 31 WHEN 1 THEN 480 WHEN 2 THEN 4 ELSE 8 END AS BIGINT) AS segment_mask,
               CAST(project_id % 2 + 1 AS INT) AS frequency, CAST(project_id % 5 + 1 AS INT) AS demo_id,
               first_date AS on_map_start, last_date AS on_map_end, CAST(project_id % 3 + 1 AS INT) AS phase_type,
               CAST(project_id % 5 AS INT) AS episode_priority, CAST(project_id % 6 AS INT) AS no_of_episode,
               CASE WHEN project_id % 8 = 0 THEN NULL ELSE 'saved ' || CAST(project_id AS STRING) END AS user_comment,
               first_date + 1 AS on_map_premiere, CAST(project_id % 180 AS DECIMAL(18,2)) AS guide_grp, CAST(project_id % 27 AS INT) AS guide_spots,
               CAST(project_id % 4 + 1 AS INT) AS network_target_demo_id, CAST(first_date AS TIMESTAMP) + INTERVAL '5' HOUR AS on_map_start_ts,
               CAST(last_date AS TIMESTAMP) + INTERVAL '22' HOUR AS on_map_end_ts
        FROM {plan_project_key} WHERE project_id IN (SELECT project_id FROM {project} WHERE is_active = 'Y')""",
    "stg_spots": """
        SELECT plan_id AS uid, project_id, CAST(date_trunc('week', start_date) AS DATE) AS week_date,
               CAST(sum(planned_units) AS BIGINT) AS unit_count
        FROM {spot_line} WHERE l_linenumber <= 4
        GROUP BY plan_id, project_id, CAST(date_trunc('week', start_date) AS DATE)""",
    "stg_episode_map": """
        SELECT plan_id AS uid, project_id, l_linenumber - 3 AS episode_id, CAST(date_trunc('week', start_date) AS DATE) AS week_date,
               CAST(sum(planned_units) AS BIGINT) - 20 AS unit_count, min(start_date) AS episode_start_date, max(start_date) AS episode_end_date,
               max(start_date) AS broadcast_date, CAST(max(start_date) AS TIMESTAMP) + INTERVAL '20' HOUR AS episode_start_ts
        FROM {spot_line} WHERE l_linenumber > 4
        GROUP BY plan_id, project_id, l_linenumber, CAST(date_trunc('week', start_date) AS DATE)""",
    "project_reach": """
        SELECT s_suppkey + 1 AS project_id, CAST(s_suppkey % 25 + 1 AS INT) AS media_outlet_id,
               CASE WHEN s_acctbal < 0 THEN NULL WHEN s_suppkey % 2 = 0 THEN 'PLANNED' ELSE 'ACTUAL' END AS reach_type FROM {supplier}""",
    "project_reach_episode": """
        SELECT project_id, media_outlet_id, episode_id, CASE WHEN (project_id + episode_id) % 2 = 0 THEN 'PLANNED' ELSE 'ACTUAL' END AS reach_type
        FROM {episode_key} GROUP BY project_id, media_outlet_id, episode_id""",
    "model_param": """
        SELECT DISTINCT c_nationkey + 1 AS media_outlet_id, 1 AS model_type_id, CAST(c_custkey % 30 + 1 AS INT) AS param_id,
               CAST((c_custkey % 30 + 1) * 10 + c_nationkey AS INT) AS param_value
        FROM {customer}""",
    # --- episode set-up ---------------------------------------------------------------
    "episode_detail": """
        SELECT project_id, episode_id, max(last_date) AS broadcast_date, CAST(project_id % 24 * 3600 + 1800 AS INT) AS air_offset,
               CAST(1800 * (project_id % 4 + 1) AS INT) AS duration, CAST(project_id % 7 + 1 AS INT) AS dow,
               min(first_date) AS pl_start, CAST(project_id % 10 * 3600 AS INT) AS pl_start_offset,
               max(last_date) AS pl_end, CAST(project_id % 20 * 3600 AS INT) AS pl_end_offset,
               CASE WHEN project_id % 3 = 0 THEN NULL ELSE CAST(project_id % 40 AS INT) END AS tgt_spot,
               CAST(project_id % 50 AS DECIMAL(18,2)) AS tgt_grp, 'A' AS status
        FROM {episode_key} GROUP BY project_id, episode_id""",
    "episode_edit": """
        SELECT project_id, episode_id, CASE WHEN project_id % 2 = 0 THEN 'Y' ELSE 'N' END AS is_episode_changed_db,
               CASE WHEN project_id % 3 = 0 THEN 'Y' ELSE 'N' END AS is_episode_att_edited
        FROM {episode_key} GROUP BY project_id, episode_id""",
    "episode_constraint": """
        SELECT project_id, episode_id, CAST(project_id % 3 + 3 AS INT) AS constraint_type_id, project_id AS constraint_key
        FROM {episode_key} GROUP BY project_id, episode_id""",
    "episode_timeband": """
        SELECT s_suppkey + 1 AS constraint_id, 4 AS constraint_type_id, CAST(s_suppkey % 29 * 3600 AS INT) AS start_offset,
               CAST(s_suppkey % 29 * 3600 + 18000 AS INT) AS end_offset, CAST(s_suppkey % 128 AS INT) AS days_mask
        FROM {supplier}""",
    "episode_header": """
        SELECT s_suppkey + 1 AS project_id, DATE '1995-01-02' + CAST(s_suppkey * 37 % 2400 AS INT) AS episode_start_date,
               DATE '1995-03-06' + CAST(s_suppkey * 37 % 2400 AS INT) AS episode_end_date, CAST(s_suppkey % 24 * 3600 AS INT) AS start_offset,
               CAST(s_suppkey % 24 * 3600 + 1800 AS INT) AS end_offset, CAST(s_suppkey % 30 AS INT) AS tgt_spots,
               CAST(s_suppkey % 90 AS DECIMAL(18,2)) AS tgt_grp, CAST(s_suppkey % 128 AS INT) AS dow_mask,
               CASE WHEN s_suppkey % 3 = 0 THEN NULL
                    ELSE CAST(DATE '1995-01-02' + CAST(s_suppkey * 41 % 2400 AS INT) AS TIMESTAMP) END AS map_colour_updated_ts,
               CASE WHEN s_acctbal < 6000 THEN 'Y' ELSE 'N' END AS active_yn
        FROM {supplier}""",
    "blackout": """
        SELECT l_suppkey + 1 AS project_id, CASE l_returnflag WHEN 'R' THEN 'blackout' WHEN 'A' THEN 'preferred' ELSE 'open' END AS kind,
               min(CAST(l_shipdate AS DATE)) AS start_date, max(CAST(l_shipdate AS DATE)) AS end_date
        FROM {lineitem} GROUP BY l_suppkey, l_linenumber, l_returnflag""",
    "recurring_exclusion": """
        SELECT s_suppkey + 1 AS project_id, CAST(s_suppkey % 20 * 3600 AS INT) AS start_offset,
               CAST(s_suppkey % 20 * 3600 + 3600 AS INT) AS end_offset, CAST(s_suppkey % 128 AS INT) AS days_mask,
               CASE WHEN s_acctbal > 2000 THEN 'Y' ELSE 'N' END AS active_yn
        FROM {supplier}""",
}


def referenced(sql: str) -> list[str]:
    """Names used as ``{name}`` in a text, in order of first use."""
    return list(dict.fromkeys(field for _, field, _, _ in Formatter().parse(sql) if field))


def view_sql(name: str, engine: str) -> str:
    return CAL_DAY[engine] if name == "cal_day" else VIEWS[name]


def takes_shuffle(sql: str) -> bool:
    return any(word in sql for word in ("GROUP BY", "DISTINCT", "JOIN ", "UNION"))


def with_views(sql: str) -> str:
    """The SQL check's text: ``sql`` preceded by the views it needs."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in BASE_TABLES or name in order:
            return
        for dep in referenced(view_sql(name, "duckdb")):
            visit(dep)
        order.append(name)

    for name in referenced(sql):
        visit(name)
    plain = {n: n for n in [*BASE_TABLES, "cal_day", *VIEWS]}
    ctes = [f"{n} AS ({view_sql(n, 'duckdb').format(**plain).strip()})" for n in order]
    body = sql.format(**plain).strip()
    if not ctes:
        return body
    if body[:4].upper() == "WITH":
        recursive = body[4:].lstrip().upper().startswith("RECURSIVE")
        rest = body[4:].lstrip()[len("RECURSIVE"):] if recursive else body[4:]
        return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + ",\n" + rest.strip()
    return "WITH " + ",\n".join(ctes) + "\n" + body
