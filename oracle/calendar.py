WEEKS = """
    SELECT m.period_id, w.fiscal_qtr, CAST(row_number() OVER (PARTITION BY m.period_id ORDER BY w.end_date) AS INT) AS week_no,
           w.start_date AS week_start, w.end_date AS week_end
    FROM {cal_period} m
    JOIN {cal_period} q ON q.period_type = 'Q' AND q.period_id IN (m.period_id, m.period_id + 1)
    JOIN {cal_period} w ON w.period_type = 'W' AND w.fiscal_qtr = q.name
    WHERE m.period_type = 'Q'"""

SQL = {
    "periods": "SELECT * FROM {cal_period} WHERE period_type = 'Q'",
    "quarter_weeks": WEEKS,
    "week_number": f"""SELECT *, 'WEEK' || week_no AS week_label, 'EP_Wek' || week_no AS episode_week_label
        FROM ({WEEKS})""",
    "adjacent_quarter": """
        SELECT a.period_id, a.name, b.period_id AS other_period_id, b.name AS other_name, b.start_date AS other_start, b.end_date AS other_end
        FROM {cal_period} a JOIN {cal_period} b ON b.period_id = a.period_id + 1
        WHERE a.period_type = 'Q' AND b.period_type = 'Q'""",
    "next_quarter_by_date": """
        SELECT a.period_id, a.name, b.period_id AS next_period_id, b.end_date AS map_end
        FROM {cal_period} a JOIN {cal_period} b ON b.start_date = a.end_date + 1
        WHERE a.period_type = 'Q' AND b.period_type = 'Q'""",
    "quarter_window": """
        SELECT q.* FROM {cal_period} q WHERE q.period_type = 'Q'
        AND q.start_date >= (SELECT start_date FROM {cal_period} WHERE period_type = 'Q' AND DATE '1998-06-17' - 95 BETWEEN start_date AND end_date)
        AND q.end_date <= (SELECT e.end_date FROM {cal_period} e JOIN {cal_period} c ON e.period_id = c.period_id + 4
                           WHERE c.period_type = 'Q' AND DATE '1998-06-17' BETWEEN c.start_date AND c.end_date)""",
}
