def rounded(num: str, den: str, digits: int) -> str:
    """Exact half-away-from-zero quotient of integers as DECIMAL(18,2)."""
    scale = 10 ** digits
    return (f"CAST(CAST((CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END) * ((2 * abs({num}) * {scale} + ({den})) // (2 * ({den}))) AS DECIMAL(30,0))"
            f" * CAST({1 / scale} AS DECIMAL(3,{digits})) AS DECIMAL(18,2))")


def cents(col: str) -> str:
    return f"CAST(({col}) * 100 AS HUGEINT)"


PROFILE = """prof AS (
    SELECT * FROM (
        SELECT r.call_id, r.project_id, r.media_outlet_id, r.demo_id,
            CASE WHEN p.media_outlet_id <> r.media_outlet_id THEN (SELECT min(s.segment_id) FROM {segment} s WHERE s.mask = coalesce(r.segment_id, p.target_segment))
                 ELSE coalesce(r.segment_id, p.target_segment) END AS segment_id,
            r.frequency, r.calc_based_on, r.target_reach_pct, r.target_grps, r.planned_spot, r.flight_start, r.flight_end, r.qtr_start,
            CAST(greatest(round((datediff('day', r.flight_start, r.flight_end) + 1) / 7, 0), 1) AS INT) AS flight_week_count
        FROM {reach_request} r JOIN {project} p ON p.project_id = r.project_id)
    WHERE NOT coalesce(flight_end < (SELECT start_date FROM {cal_period} WHERE period_type = 'W' AND DATE '1998-06-17' BETWEEN start_date AND end_date), FALSE))"""

PICK = """pick AS (
    SELECT k.media_outlet_id, k.demo_id, k.qtr_start, coalesce(
        (SELECT max(h.reach_id) FROM {reach_header} h JOIN {cal_period} c ON c.period_type = 'Q' AND c.end_date = h.base_end AND c.start_date = h.base_start
          WHERE h.target_demo_id = k.demo_id AND h.media_outlet_id = k.media_outlet_id AND c.end_date = k.last_end),
        (SELECT max(h.reach_id) FROM {reach_header} h WHERE h.target_demo_id = k.demo_id AND h.media_outlet_id = k.media_outlet_id)) AS reach_id
    FROM (SELECT d.media_outlet_id, d.demo_id, d.qtr_start, max(q.end_date) AS last_end FROM (SELECT DISTINCT media_outlet_id, demo_id, qtr_start FROM prof) d
          LEFT JOIN {cal_period} q ON q.period_type = 'Q' AND q.end_date < CASE WHEN d.media_outlet_id = 1 THEN d.qtr_start ELSE d.qtr_start + 1 END
          GROUP BY ALL) k)"""

GUIDED = """guided AS (
    SELECT p.*, k.reach_id, l.aw AS available_weeks, l.au AS available_units,
           CASE WHEN p.calc_based_on IN ('ER', 'EG') THEN 1 ELSE least(p.flight_week_count, l.aw) END AS week_count
    FROM prof p LEFT JOIN pick k ON k.media_outlet_id = p.media_outlet_id AND k.demo_id = p.demo_id AND k.qtr_start = p.qtr_start
    LEFT JOIN (SELECT reach_id, max(week_count) AS aw, max(unit_count) AS au FROM {reach_detail} GROUP BY 1) l ON l.reach_id = k.reach_id)"""

GUIDE = f"""part AS (
    SELECT d.*, c.segment_id AS whole_id FROM {{reach_detail}} d JOIN {{segment_component}} c ON c.component_segment_id = d.segment_id),
    point AS (
        SELECT reach_id, whole_id, week_count, unit_count, max(grp) AS grp FROM (
            SELECT p.reach_id, p.whole_id, p.week_count, p.unit_count, p.start_date, p.end_date, {rounded('CAST(sum(p.impressions) AS HUGEINT) * 100', 'max(u.universe)::HUGEINT', 2)} AS grp
            FROM part p JOIN {{reach_header}} h ON h.reach_id = p.reach_id JOIN {{demo}} u ON u.demo_id = h.target_demo_id WHERE p.frequency = 1 GROUP BY ALL) GROUP BY ALL),
    guide AS (
        SELECT p.reach_id, p.whole_id AS segment_id, p.week_count, p.frequency, p.unit_count, {rounded('CAST(sum(p.reach) AS HUGEINT) * 100', 'CAST(sum(p.universe) AS HUGEINT)', 2)} AS reach_pct,
               {rounded('CAST(sum(p.cov_grp) * 100 AS HUGEINT)', 'CAST(count(*) * 100 AS HUGEINT)', 0)} AS cov_grp, max(g.grp) AS grp
        FROM part p JOIN point g ON g.reach_id = p.reach_id AND g.whole_id = p.whole_id AND g.week_count = p.week_count AND g.unit_count = p.unit_count
        GROUP BY p.reach_id, p.whole_id, p.week_count, p.frequency, p.unit_count)"""

METRIC = "CASE WHEN r.calc_based_on IN ('R', 'ER') THEN g.reach_pct WHEN r.calc_based_on IN ('G', 'EG') THEN g.grp WHEN r.calc_based_on = 'S' THEN g.unit_count::DECIMAL(18,2) END"
TARGET = "CASE WHEN r.calc_based_on IN ('R', 'ER') THEN r.target_reach_pct WHEN r.calc_based_on IN ('G', 'EG') THEN r.target_grps WHEN r.calc_based_on = 'S' THEN r.planned_spot::DECIMAL(18,2) END"
SAME = "g.reach_id = r.reach_id AND g.segment_id = r.segment_id AND g.week_count = r.week_count AND g.frequency = r.frequency"

BRACKETS = f"""edge AS (
    SELECT r.call_id, r.project_id, max(CASE WHEN {METRIC} <= {TARGET} THEN g.unit_count END) AS lo, min(CASE WHEN {METRIC} >= {TARGET} THEN g.unit_count END) AS hi
    FROM guided r JOIN guide g ON {SAME} GROUP BY ALL),
    brackets AS (
        SELECT r.*, coalesce(l.unit_count, 0) AS lower_unit_count, coalesce(l.reach_pct, 0)::DECIMAL(18,2) AS lower_reach_pct, coalesce(l.grp, 0)::DECIMAL(18,2) AS lower_grp,
               coalesce(u.unit_count, 0) AS upper_unit_count, coalesce(u.reach_pct, 0)::DECIMAL(18,2) AS upper_reach_pct, coalesce(u.grp, 0)::DECIMAL(18,2) AS upper_grp,
               t.unit_count AS top_unit_count, t.reach_pct AS top_reach_pct, t.grp AS top_grp
        FROM guided r LEFT JOIN edge e ON e.call_id = r.call_id AND e.project_id = r.project_id
        LEFT JOIN guide l ON {SAME.replace('g.', 'l.')} AND l.unit_count = e.lo
        LEFT JOIN guide u ON {SAME.replace('g.', 'u.')} AND u.unit_count = e.hi
        LEFT JOIN guide t ON {SAME.replace('g.', 't.')} AND t.unit_count = r.available_units)"""

LOW = "CASE WHEN calc_based_on IN ('R', 'ER') THEN lower_reach_pct WHEN calc_based_on IN ('G', 'EG') THEN lower_grp ELSE lower_unit_count::DECIMAL(18,2) END"
HIGH = "CASE WHEN calc_based_on IN ('R', 'ER') THEN upper_reach_pct WHEN calc_based_on IN ('G', 'EG') THEN upper_grp ELSE upper_unit_count::DECIMAL(18,2) END"
WANT = TARGET.replace("r.", "")


def rise(a: str, b: str, digits: int) -> str:
    num = f"(({cents(b)} - {cents(a)}) * ({cents('want')} - {cents('low')}))"
    den = f"(({cents('high')} - {cents('low')}) * 100)"
    return f"(CASE WHEN high = low THEN 0 ELSE {rounded(num, den, digits)} END)"


def by_mode(a: str, b: str) -> str:
    return f"(CASE WHEN calc_based_on IN ('ER', 'EG') THEN {rise(a, b, 0)} ELSE {rise(a, b, 2)} END)"


ESTIMATES = f"""estimates AS (
    SELECT call_id, project_id, media_outlet_id, calc_based_on, flight_start, flight_end, qtr_start, flight_week_count AS asked_weeks, week_count,
        CAST(CASE WHEN calc_based_on = 'ES' THEN NULL WHEN upper_unit_count = 0 THEN top_unit_count WHEN calc_based_on = 'S' THEN planned_spot
             WHEN lower_unit_count = upper_unit_count THEN lower_unit_count WHEN lower_unit_count > upper_unit_count THEN upper_unit_count
             ELSE lower_unit_count + {rise('lower_unit_count', 'upper_unit_count', 0)} END AS BIGINT) AS spot_result,
        CAST(CASE WHEN calc_based_on = 'ES' THEN NULL WHEN upper_unit_count = 0 THEN top_reach_pct WHEN calc_based_on IN ('R', 'ER') THEN target_reach_pct
             WHEN lower_unit_count = upper_unit_count THEN lower_reach_pct ELSE lower_reach_pct + {by_mode('lower_reach_pct', 'upper_reach_pct')} END AS DECIMAL(18,2)) AS reach_pct_result,
        CAST(round(CAST(CASE WHEN calc_based_on = 'ES' THEN NULL WHEN upper_unit_count = 0 THEN top_grp WHEN lower_unit_count = upper_unit_count THEN lower_grp
             WHEN lower_unit_count > upper_unit_count THEN upper_grp ELSE lower_grp + {by_mode('lower_grp', 'upper_grp')} END AS DECIMAL(18,2)), 1) AS DECIMAL(18,1)) AS grps_result
    FROM (SELECT *, {LOW} AS low, {HIGH} AS high, {WANT} AS want FROM brackets))"""

CHAIN = f"{PROFILE}, {PICK}, {GUIDED}, {GUIDE}, {BRACKETS}, {ESTIMATES}"

OVERLAP = """overlap AS (
    SELECT e.call_id, e.project_id, e.calc_based_on, e.qtr_start, e.spot_result, w.start_date AS week_date,
        CAST(7 - CASE WHEN e.flight_start > w.start_date THEN datediff('day', w.start_date, e.flight_start) ELSE 0 END
          - CASE WHEN e.flight_end < w.end_date THEN datediff('day', e.flight_end, w.end_date) ELSE 0 END AS INT) AS days_in_week,
        CAST(datediff('day', CASE WHEN e.flight_start < e.qtr_start THEN e.qtr_start ELSE e.flight_start END, e.flight_end) + 1 AS INT) AS total_days
    FROM estimates e JOIN {cal_period} w ON w.period_type = 'W' AND w.start_date <= e.flight_end
        AND w.end_date >= CASE WHEN e.flight_start < e.qtr_start THEN e.qtr_start ELSE e.flight_start END
    WHERE e.calc_based_on NOT IN ('S', 'ES'))"""

LABEL = "strftime(week_date, '%m/%d') AS week_date, 'Week' || CAST(round(datediff('day', qtr_start, week_date) / 7) + 1 AS INT) AS week_name"

SQL = {
    "flight_profile": f"WITH {PROFILE} SELECT * FROM prof",
    "select_guide": f"WITH {PROFILE}, {PICK} SELECT * FROM pick",
    "guide_limits": "SELECT reach_id, max(week_count) AS available_weeks, max(unit_count) AS available_units FROM {reach_detail} GROUP BY 1",
    "reach_guide": f"WITH {GUIDE} SELECT * FROM guide",
    "reach_brackets": f"WITH {PROFILE}, {PICK}, {GUIDED}, {GUIDE}, {BRACKETS} SELECT * FROM brackets",
    "reach_estimates": f"WITH {CHAIN} SELECT * FROM estimates",
    "week_overlap": f"WITH {CHAIN}, {OVERLAP} SELECT * FROM overlap",
    "distribute_proportional": f"""WITH {CHAIN}, {OVERLAP}
        SELECT call_id, project_id, {LABEL}, CAST(CASE WHEN calc_based_on IN ('ER', 'EG') THEN spot_result
            ELSE greatest(floor(coalesce(spot_result, 0) * days_in_week / total_days), 0) END AS BIGINT) AS unit_count FROM overlap""",
    "distribute_carry": f"""WITH RECURSIVE {CHAIN}, {OVERLAP},
        seq AS (SELECT *, row_number() OVER (PARTITION BY call_id, project_id ORDER BY week_date) AS n FROM overlap),
        walk AS (
            SELECT call_id, project_id, n, week_date, qtr_start, calc_based_on, spot_result,
                   CAST(floor(spot_result * days_in_week / total_days) AS BIGINT) AS share, spot_result AS units_left, total_days AS days_left, days_in_week
            FROM seq WHERE n = 1
            UNION ALL
            SELECT s.call_id, s.project_id, s.n, s.week_date, s.qtr_start, s.calc_based_on, s.spot_result,
                   CAST(floor((w.units_left - w.share) * s.days_in_week / nullif(w.days_left - w.days_in_week, 0)) AS BIGINT),
                   w.units_left - w.share, w.days_left - w.days_in_week, s.days_in_week
            FROM walk w JOIN seq s ON s.call_id = w.call_id AND s.project_id = w.project_id AND s.n = w.n + 1)
        SELECT call_id, project_id, {LABEL}, CASE WHEN calc_based_on IN ('ER', 'EG') THEN spot_result WHEN share < 0 THEN 0 ELSE share END AS unit_count FROM walk""",
}
