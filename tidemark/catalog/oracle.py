"""The same queries as plain SQL for DuckDB, written from the definitions and not from the Spark plans."""

from __future__ import annotations

AS_OF = "DATE '2001-08-02'"
# The stages of the sales funnel, top to bottom.
STAGES = ("Lead Created", "Demo Scheduled", "Proposal Sent", "Contract Signed", "Closed Won")
RULES = ("l_linestatus = 'F'", "l_returnflag IN ('A', 'R')", "l_quantity > 25", "l_discount >= 0.05")
STAGE = "CASE " + " ".join(f"WHEN {' AND '.join(RULES[:n])} THEN {n + 1}" for n in range(4, 0, -1)) + " ELSE 1 END"
STAGE_NAME = "CASE {} " + " ".join(f"WHEN {n} THEN '{name}'" for n, name in enumerate(STAGES, 1)) + " END"


def msum(column: str) -> str:
    """A sum that no order of rows changes. The decimal is far wider than any value in the tables, so nothing is cut.

    It becomes a double by way of its digits, which gives the nearest one.
    """
    return f"CAST(CAST(sum(CAST({column} AS DECIMAL(38,6))) AS VARCHAR) AS DOUBLE)"


def mavg(column: str) -> str:
    return f"({msum(column)} / count({column}))"


def signed_round(value: str, digits: int) -> str:
    """Rounded, with zero for what would be a negative zero."""
    return f"(round({value}, {digits}) + 0.0::DOUBLE)"


def pct(part: str, whole: str, digits: int) -> str:
    return signed_round(f"{part} * 100.0::DOUBLE / nullif({whole}, 0)", digits)


def tier(days: str) -> str:
    return (
        f"CASE WHEN {days} > 90 THEN 'high_risk' WHEN {days} > 60 THEN 'medium_risk' "
        f"WHEN {days} > 30 THEN 'low_risk' ELSE 'active' END"
    )


def days_from(date: str) -> str:
    return f"CAST({AS_OF} - {date} AS INTEGER)"


def month(date: str) -> str:
    return f"CAST(date_trunc('month', {date}) AS DATE)"


# Logical tables by name; a later one may use an earlier one.
TABLES = {
    "transactions": """SELECT o_custkey AS customer_id, o_orderkey AS transaction_id,
        o_orderdate::DATE AS transaction_date, o_totalprice AS amount, o_orderpriority AS product_line,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'open' ELSE 'pending' END AS status FROM orders""",
    "regional": """SELECT t.*, r_name AS region FROM transactions t JOIN customer ON c_custkey = t.customer_id
        JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "extracted": f"""SELECT customer_id, transaction_id, transaction_date, amount, product_line, region
        FROM regional WHERE transaction_date >= {AS_OF} - 365 AND status = 'completed'""",
    "sales": """SELECT s_suppkey AS sales_rep_id, r_name AS region,
        CAST(round(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))), 2) AS DOUBLE) AS revenue
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
        JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""",
    "bands": """SELECT o_orderkey AS sales_rep_id, o_orderpriority AS region,
        CAST(floor(o_totalprice / 10000.0::DOUBLE) AS DOUBLE) AS revenue FROM orders""",
    "monthly": f"SELECT {month('o_orderdate')} AS month, {msum('o_totalprice')} AS revenue FROM orders GROUP BY 1",
    "daily": "SELECT ts::DATE AS event_date, count(DISTINCT user_id) AS daily_active_users FROM events GROUP BY 1",
    "spend": f"""SELECT c_custkey AS customer_id, {msum('o_totalprice')} AS total_spend, c_mktsegment AS segment
        FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_mktsegment""",
    "activity": "SELECT user_id AS customer_id, ts::DATE AS activity_date FROM events",
    "staged_lines": f"SELECT *, l_orderkey AS customer_id, {STAGE} AS stage FROM lineitem",
    "stage_events": f"""SELECT customer_id, n AS stage_order, {STAGE_NAME.format('n')} AS funnel_stage
        FROM staged_lines, range(1, 6) g(n) WHERE n <= stage""",
    "current_stages": f"""SELECT customer_id, {STAGE_NAME.format('stage')} AS stage_name
        FROM staged_lines WHERE l_linenumber = 1""",
    "purchases": "SELECT o_custkey AS customer_id, o_orderdate::DATE AS purchase_date FROM orders",
    "dates": f"""SELECT o_custkey AS customer_id, min(o_orderdate::DATE) AS first_order,
        max(o_orderdate::DATE) AS last_order, {msum('o_totalprice')} AS spend,
        count(DISTINCT date_trunc('month', o_orderdate)) AS order_months FROM orders GROUP BY 1""",
    "people": f"""SELECT d.*, c_name, c_mktsegment, c_acctbal, n_name, c_nationkey,
        CAST(first_order - 2 * c_nationkey AS DATE) AS signup_date,
        CASE WHEN c_acctbal < 2500 THEN 'basic' WHEN c_acctbal < 6000 THEN 'plus' ELSE 'pro' END AS plan_type,
        c_acctbal >= 0 AS is_active, last_order < {AS_OF} - 180 AS is_churned
        FROM dates d JOIN customer ON c_custkey = customer_id JOIN nation ON n_nationkey = c_nationkey""",
    "logins": """SELECT o_custkey AS customer_id, max(o_orderdate::DATE) AS last_login_date FROM orders
        WHERE o_orderstatus = 'O' GROUP BY 1""",
    "done": f"""SELECT o_custkey AS customer_id, max(o_orderdate::DATE) AS last_transaction_date,
        count(*) FILTER (o_orderdate::DATE >= {AS_OF} - 90) AS transactions_last_90d FROM orders
        WHERE o_orderstatus = 'F' GROUP BY 1""",
    "support": """SELECT user_id AS customer_id, count(*) AS support_tickets_last_90d,
        count(*) FILTER (value > 100) AS open_support_tickets FROM events WHERE event_type = 'error' GROUP BY 1""",
    "features": """SELECT user_id AS customer_id, count(DISTINCT event_type) AS features_used_last_30d
        FROM events WHERE value > 150 GROUP BY 1""",
    "billing": f"""SELECT o_custkey AS customer_id, count(*) AS failed_payments_last_6m,
        count(*) FILTER (o_totalprice > 400000) AS billing_disputes,
        count(*) FILTER (o_orderdate::DATE >= {AS_OF} - 90) AS failed_payments_last_90d
        FROM orders WHERE o_orderstatus = 'P' GROUP BY 1""",
    "login_extract": f"""SELECT o_custkey AS customer_id, max(o_orderdate::DATE) AS last_login_date,
        count(*) AS total_logins_90d FROM orders WHERE o_orderdate::DATE >= {AS_OF} - 90 GROUP BY 1""",
    "raw_events": """SELECT user_id AS customer_id, event_type, value AS event_value,
        CAST(event_id AS VARCHAR) AS session_id,
        CASE WHEN event_type IN ('view', 'click') THEN 'web' ELSE 'mobile' END AS platform,
        strftime(ts, '%Y-%m-%d') AS event_date,
        CASE r_name WHEN 'AMERICA' THEN 'US' WHEN 'EUROPE' THEN 'EU' ELSE 'APAC' END AS region
        FROM events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey""",
}
USES = {
    "regional": ["transactions"],
    "extracted": ["transactions", "regional"],
    "stage_events": ["staged_lines"],
    "current_stages": ["staged_lines"],
    "people": ["dates"],
}


def given(*names: str, also: str = "") -> str:
    wanted = {need for name in names for need in (name, *USES.get(name, ()))}
    parts = [f"{name} AS ({sql})" for name, sql in TABLES.items() if name in wanted]
    return "WITH " + ", ".join(parts + ([also] if also else []))


def ranks(table: str) -> str:
    return f"""SELECT *, rank() OVER (PARTITION BY region ORDER BY revenue DESC) AS rank,
        dense_rank() OVER (PARTITION BY region ORDER BY revenue DESC) AS dense_rank,
        row_number() OVER (PARTITION BY region ORDER BY revenue DESC, sales_rep_id) AS row_num FROM {table}"""


def running(key: str) -> str:
    return f"""CAST(sum(CAST(amount AS DECIMAL(18,4))) OVER (PARTITION BY {key}
        ORDER BY transaction_date, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)"""


def ends(key: str) -> str:
    return f"""SELECT user_id AS customer_id, ts::DATE AS event_date, event_type,
        first_value(ts::DATE) OVER w AS first_event_date, last_value(ts::DATE) OVER w AS last_event_date
        FROM events WINDOW w AS (PARTITION BY {key} ORDER BY ts::DATE NULLS FIRST
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""


QUARTILES = (
    given(
        "spend",
        also="""placed AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY total_spend, customer_id) AS rn,
            count(*) OVER (PARTITION BY segment) AS n FROM spend),
        medians AS (SELECT segment, (min(total_spend) + max(total_spend)) / 2 AS m FROM placed
            WHERE rn IN ((n + 1) // 2, (n + 2) // 2) GROUP BY segment)""",
    )
    + """ SELECT customer_id, total_spend,
        CAST(ntile(4) OVER (ORDER BY total_spend DESC, customer_id) AS INTEGER) AS spend_quartile,
        m AS median_spend_by_segment FROM spend s JOIN medians d ON s.segment IS NOT DISTINCT FROM d.segment"""
)


def streaks(rows: str) -> str:
    return (
        given("activity")
        + f""", numbered AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY activity_date) AS rn
            FROM ({rows})),
        islands AS (SELECT *, activity_date - CAST(rn AS INTEGER) AS grp FROM numbered)
        SELECT customer_id, min(activity_date) AS streak_start, max(activity_date) AS streak_end,
            count(*) AS streak_length_days FROM islands GROUP BY customer_id, grp"""
    )


def listed(rows: str) -> str:
    names = ", ".join(f"('{name}', {place})" for place, name in enumerate(STAGES, 1))
    return f"""counted AS (SELECT stage, stage_order, count(DISTINCT customer_id) AS users
            FROM (VALUES {names}) v(stage, stage_order) LEFT JOIN ({rows}) r ON r.stage_name = v.stage GROUP BY ALL),
        linked AS (SELECT *, lag(users) OVER (ORDER BY stage_order) AS prev_users,
            first(users) OVER (ORDER BY stage_order) AS top FROM counted)
        SELECT stage, stage_order, users, prev_users,
            CASE WHEN stage_order = 1 THEN 100.0::DOUBLE ELSE {pct('users', 'prev_users', 1)} END AS conversion_pct,
            CASE WHEN stage_order = 1 THEN 0.0::DOUBLE
                ELSE {signed_round('100 - ' + pct('users', 'prev_users', 1), 1)} END AS drop_off_pct,
            {pct('users', 'top', 1)} AS pct_of_total FROM linked"""


def retention(rows: str) -> str:
    """Long-form retention from rows of (customer_id, purchase_date)."""
    return f"""born AS (SELECT customer_id, {month('min(purchase_date)')} AS cohort_month FROM ({rows}) GROUP BY 1),
        active AS (SELECT cohort_month, CAST(datediff('month', cohort_month, purchase_date) AS INTEGER) AS period,
            count(DISTINCT customer_id) AS active_customers
            FROM ({rows}) JOIN born USING (customer_id) GROUP BY ALL),
        kept AS (SELECT *, {pct('active_customers',
            'first(active_customers) OVER (PARTITION BY cohort_month ORDER BY period)', 1)} AS retention_pct FROM active)"""


def long_form(rows: str, key: str, items: dict[str, str], **labels: str) -> str:
    """SELECTs that give (label, key, item, value) for each named figure of each row."""
    named = "".join(f"'{text}' AS {label}, " for label, text in labels.items())
    return " UNION ALL ".join(
        f"SELECT {named}CAST({key} AS VARCHAR) AS key, '{name}' AS item, CAST({column} AS DOUBLE) AS value FROM ({rows})"
        for name, column in items.items()
    )


def same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


def cells(key: str = "cohort_month", **labels: str) -> str:
    named = "".join(f"'{text}' AS {label}, " for label, text in labels.items())
    return f"SELECT {named}CAST({key} AS VARCHAR) AS key, 'period_' || period AS item, retention_pct AS value FROM kept"


def ntile_rfm(best_high: bool) -> str:
    def tiles(order: str) -> str:
        tile = f"CAST(ntile(5) OVER (ORDER BY {order}, customer_id) AS INTEGER)"
        return f"6 - {tile}" if best_high else tile

    return (
        given("transactions")
        + f""", raw AS (SELECT customer_id, {days_from('max(transaction_date)')} AS recency_days,
            count(DISTINCT transaction_id) AS frequency, {msum('amount')} AS monetary FROM transactions
            WHERE transaction_date >= {AS_OF} - 365 GROUP BY 1),
        scored AS (SELECT *, {tiles('recency_days ASC NULLS FIRST')} AS r_score,
            {tiles('frequency DESC NULLS LAST')} AS f_score, {tiles('monetary DESC NULLS LAST')} AS m_score FROM raw)
        SELECT customer_id, recency_days, frequency, round(monetary, 2) AS monetary, r_score, f_score, m_score,
            r_score + f_score + m_score AS rfm_total,
            CASE WHEN r_score + f_score + m_score >= 13 THEN 'Champions'
                WHEN r_score + f_score + m_score >= 10 THEN 'Loyal'
                WHEN r_score + f_score + m_score >= 7 THEN 'At Risk' ELSE 'Churned / Lost' END AS customer_segment
        FROM scored"""
    )


def quantile_rfm(rows: str) -> str:
    bins = " ".join(f"WHEN 5 * recency_days <= e{part} THEN {6 - part}" for part in range(1, 5))
    edges = ", ".join(
        f"""max(5 * v) FILTER (i = {part} * (n - 1) // 5)
            + (max(v) FILTER (i = least({part} * (n - 1) // 5 + 1, n - 1)) - max(v) FILTER (i = {part} * (n - 1) // 5))
            * max({part} * (n - 1) % 5) AS e{part}"""
        for part in range(1, 5)
    )
    return f"""raw AS (SELECT customer_id, {days_from('max(transaction_date)')} AS recency_days,
            count(transaction_date) AS frequency, coalesce({msum('amount')}, 0) AS monetary FROM ({rows})
            WHERE customer_id IS NOT NULL GROUP BY 1),
        edges AS (SELECT {edges} FROM (SELECT recency_days AS v, count(*) OVER () AS n,
            row_number() OVER (ORDER BY recency_days) - 1 AS i FROM raw)),
        ranked AS (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY frequency, customer_id) AS fr,
            row_number() OVER (ORDER BY monetary, customer_id) AS mr FROM raw),
        scored AS (SELECT customer_id, recency_days, frequency, monetary, CASE {bins} ELSE 1 END AS r_score,
            CAST(greatest(1, ((fr - 1) * 5 + n - 2) // (n - 1)) AS INTEGER) AS f_score,
            CAST(greatest(1, ((mr - 1) * 5 + n - 2) // (n - 1)) AS INTEGER) AS m_score FROM ranked, edges),
        segmented AS (SELECT *, r_score + f_score + m_score AS rfm_total,
            CASE WHEN r_score + f_score + m_score > 12 THEN 'Champion' WHEN r_score + f_score + m_score > 9 THEN 'Loyal'
                WHEN r_score + f_score + m_score > 6 THEN 'At Risk' ELSE 'Lost' END AS rfm_segment FROM scored)"""


RISK_REPORT = f"""SELECT p.customer_id, c_name AS account_name, n_name AS csm_owner, plan_type, c_acctbal AS mrr,
        signup_date, {days_from('last_login_date')} AS days_since_login, open_support_tickets, failed_payments_last_90d,
        {tier(days_from('last_login_date'))} AS churn_risk_tier
    FROM people p LEFT JOIN logins USING (customer_id) LEFT JOIN support USING (customer_id)
        LEFT JOIN billing USING (customer_id)
    WHERE is_active AND {tier(days_from('last_login_date'))} IN ('high_risk', 'medium_risk')"""

WEEKLY = f"""weekly AS (SELECT o_orderdate::DATE - CAST(dayofweek(o_orderdate) AS INTEGER) AS week_start,
        count(DISTINCT o_custkey) AS active_customers, {msum('o_totalprice')} AS revenue, count(DISTINCT o_orderkey) AS total_orders,
        {mavg('o_totalprice')} AS average FROM orders WHERE o_orderdate::DATE >= {AS_OF} - 84 GROUP BY 1)"""

SEGMENTS = f"""SELECT c_mktsegment AS segment, plan_type, count(DISTINCT customer_id) AS total_customers,
        round({msum('c_acctbal')}, 2) AS total_mrr, round({mavg('c_acctbal')}, 2) AS avg_mrr,
        round(avg({days_from('signup_date')}), 0) AS avg_tenure_days,
        {pct('count(*) FILTER (is_churned)', 'count(*)', 2)} AS churn_rate_pct,
        round({mavg('spend')}, 2) AS avg_ltv FROM people GROUP BY ALL"""

EVENT_ROWS = given("raw_events") + " SELECT * FROM raw_events WHERE event_date >= '2024-01-01'"
REVENUE_ROWS = given("monthly") + " SELECT strftime(month, '{}') AS month, revenue FROM monthly"
PAYMENTS = given("transactions") + " SELECT transaction_id, status, amount FROM transactions"
TEXT_AMOUNT = "CASE WHEN product_line NOT IN ('5-LOW', '2-HIGH') THEN coalesce(amount, 0) ELSE 0.0::DOUBLE END AS amount"
PARTS = """year(transaction_date)::INTEGER AS transaction_date_year, month(transaction_date)::INTEGER AS transaction_date_month,
    quarter(transaction_date)::INTEGER AS transaction_date_quarter, weekofyear(transaction_date)::INTEGER AS transaction_date_week,
    day(transaction_date)::INTEGER AS transaction_date_day, dayname(transaction_date) AS transaction_date_weekday"""
EXTRACTED_AS_PURCHASES = "SELECT customer_id, transaction_date AS purchase_date FROM extracted"
SPEND_BY_SEGMENT = f"""SELECT c_custkey AS customer_id, c_mktsegment AS segment, {msum('o_totalprice')} AS {{}}
    FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL"""


def _all() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["w1_running_total"] = given("transactions") + f""" SELECT customer_id, transaction_date, amount,
        {running('customer_id')} AS running_total FROM transactions"""
    sql["w1_running_total_hot"] = given("transactions") + f""" SELECT product_line, transaction_id, transaction_date,
        amount, {running('product_line')} AS running_total FROM transactions"""
    sql["w2_rankings"] = given("sales") + " " + ranks("sales")
    sql["w2_rankings_hot"] = given("bands") + " " + ranks("bands")
    sql["w2_top_3_per_region"] = given("sales") + """ SELECT *, CAST(row_number() OVER (PARTITION BY region
        ORDER BY revenue DESC, sales_rep_id) AS INTEGER) AS row_num FROM sales QUALIFY row_num <= 3"""
    before = "lag(revenue) OVER (ORDER BY month)"
    growth = signed_round(f"(revenue - {before}) / nullif({before}, 0) * 100", 2)
    sql["w3_period_over_period"] = given("monthly") + f""" SELECT month, revenue,
        lag(revenue) OVER (ORDER BY month) AS prev_month_revenue, lead(revenue) OVER (ORDER BY month) AS next_month_revenue,
        {growth} AS mom_growth_pct FROM monthly"""
    sql["w4_moving_average"] = given("daily") + """ SELECT *, round(avg(daily_active_users) OVER (ORDER BY event_date
        ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 0) AS rolling_7day_avg FROM daily"""
    sql["w5_first_and_last"] = ends("user_id")
    sql["w5_first_and_last_hot"] = ends("event_type")
    sql["w6_spend_quartiles"] = sql["w6_spend_quartiles_sliced"] = QUARTILES
    sql["w7_activity_streaks"] = streaks("SELECT DISTINCT * FROM activity")
    sql["w7_activity_streaks_every_row"] = streaks("FROM activity")

    sql["f1_stage_conversion"] = given("stage_events") + f""", counted AS (SELECT funnel_stage, stage_order,
        count(DISTINCT customer_id) AS users_at_stage FROM stage_events GROUP BY ALL)
        SELECT funnel_stage, users_at_stage,
            {pct('users_at_stage', 'first(users_at_stage) OVER (ORDER BY stage_order)', 1)} AS pct_of_top_of_funnel
        FROM counted"""
    sql["f2_stage_drop_off"] = given("stage_events") + f""", counted AS (SELECT funnel_stage, stage_order,
        count(DISTINCT customer_id) AS users FROM stage_events GROUP BY ALL),
        linked AS (SELECT *, lag(users) OVER (ORDER BY stage_order) AS prev_stage_users FROM counted)
        SELECT funnel_stage, users, prev_stage_users,
            {pct('(prev_stage_users - users)', 'prev_stage_users', 1)} AS drop_off_pct FROM linked"""
    sql["f3_time_in_stage"] = """WITH spent AS (SELECT l_returnflag AS stage_name,
            CAST(l_shipdate::DATE - o_orderdate::DATE AS INTEGER) AS days FROM lineitem JOIN orders
            ON l_orderkey = o_orderkey WHERE l_shipdate::DATE >= o_orderdate::DATE AND l_linestatus = 'F'),
        placed AS (SELECT *, row_number() OVER (PARTITION BY stage_name ORDER BY days) AS rn,
            count(*) OVER (PARTITION BY stage_name) AS n FROM spent)
        SELECT stage_name, round(avg(days), 1) AS avg_days, min(days) AS min_days, max(days) AS max_days,
            min(days) FILTER (rn * 2 >= n) AS median_days, min(days) FILTER (rn * 10 >= n * 9) AS p90_days
        FROM placed GROUP BY 1"""
    sql["f3_bucketed_times"] = """WITH spent AS (SELECT l_returnflag AS stage_name,
            (l_shipdate::DATE - o_orderdate::DATE) * 86400 AS v FROM lineitem JOIN orders
            ON l_orderkey = o_orderkey WHERE l_shipdate::DATE >= o_orderdate::DATE AND l_linestatus = 'F'),
        cut AS (SELECT stage_name, v, CASE WHEN v < 256 THEN 1 ELSE CAST(pow(2, floor(log2(v)) - 7) AS BIGINT) END AS width FROM spent),
        placed AS (SELECT stage_name, v // width * width AS low, v // width * width + width - 1 AS high,
            row_number() OVER (PARTITION BY stage_name ORDER BY v) AS rn, count(*) OVER (PARTITION BY stage_name) AS n FROM cut)
        SELECT stage_name, n, min(low) FILTER (rn * 2 >= n) AS median_low, min(high) FILTER (rn * 2 >= n) AS median_high,
            min(low) FILTER (rn * 10 >= n * 9) AS p90_low, min(high) FILTER (rn * 10 >= n * 9) AS p90_high FROM placed GROUP BY stage_name, n"""
    reached = {"leads": 1, "demos": 2, "proposals": 3, "closed": 4}
    counts = ", ".join(
        f"count(DISTINCT CASE WHEN stage >= {n} THEN customer_id END) AS {name}" for name, n in reached.items()
    )
    sql["f4_conversion_by_segment"] = given("staged_lines") + f""", counted AS (SELECT c_mktsegment AS segment, {counts}
        FROM staged_lines JOIN orders ON o_orderkey = customer_id JOIN customer ON c_custkey = o_custkey GROUP BY 1)
        SELECT *, {pct('closed', 'leads', 1)} AS overall_conversion_pct FROM counted"""
    sql["f5_touch_attribution"] = """WITH touches AS (SELECT event_type AS channel,
            row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS f,
            row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS l FROM events
            WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 200))
        SELECT channel, count(*) FILTER (f = 1) AS first_touch_conversions,
            count(*) FILTER (l = 1) AS last_touch_conversions FROM touches GROUP BY 1"""
    sql["f6_listed_funnel"] = given("current_stages", also=listed("FROM current_stages"))
    sql["c5_transform_funnel"] = sql["f6_listed_funnel"]

    sql["k1_monthly_retention"] = given("purchases", also=retention("FROM purchases")) + " FROM kept"
    sql["k1_incremental_retention"] = sql["k1_monthly_retention"]
    sql["k2_cutover_retention"] = given("people") + f""", status AS (SELECT customer_id,
        last_order >= {AS_OF} - 180 AS seen FROM dates WHERE last_order >= {AS_OF} - 730),
        grouped AS (SELECT customer_id, CASE WHEN signup_date < DATE '1995-07-01' THEN 'pre_migration'
            ELSE 'post_migration' END AS cohort_type FROM people),
        counted AS (SELECT cohort_type, count(DISTINCT customer_id) AS total_customers,
            count(DISTINCT CASE WHEN seen THEN customer_id END) AS active_customers
            FROM grouped LEFT JOIN status USING (customer_id) GROUP BY 1)
        SELECT *, {pct('active_customers', 'total_customers', 1)} AS retention_pct FROM counted"""
    sql["k3_adoption_cohorts"] = given("people") + f""", adopted AS (SELECT o_custkey AS customer_id,
        min(o_orderdate::DATE) AS d FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
        placed AS (SELECT *, CASE WHEN d IS NULL THEN 'never_adopted' WHEN d - signup_date <= 30 THEN 'early_adopter'
            ELSE 'late_adopter' END AS adoption_segment FROM people LEFT JOIN adopted USING (customer_id))
        SELECT adoption_segment, count(DISTINCT customer_id) AS customers, round({mavg('spend')}, 2) AS avg_ltv,
            round(avg({days_from('signup_date')}), 0) AS avg_tenure_days,
            {pct('count(DISTINCT CASE WHEN is_churned THEN customer_id END)', 'count(DISTINCT customer_id)', 1)} AS churn_pct
        FROM placed GROUP BY 1"""
    sql["k4_billing_cohorts"] = given("people") + f""" SELECT CASE WHEN c_nationkey < 13 THEN 'monthly' ELSE 'annual' END
        AS billing_cycle, {month('signup_date')} AS cohort_month, count(DISTINCT customer_id) AS cohort_size,
        round(avg(order_months), 1) AS avg_months_active,
        {pct('count(*) FILTER (is_churned)', 'count(*)', 1)} AS churn_rate_pct FROM people GROUP BY ALL"""
    dated = "FROM purchases WHERE purchase_date IS NOT NULL"
    sql["k5_retention_matrix"] = given("purchases", also=retention(dated)) + " " + cells()
    sql["c5_transform_cohorts"] = given("extracted", also=retention(EXTRACTED_AS_PURCHASES)) + " " + cells()
    windows = ", ".join(
        f"count(DISTINCT customer_id) FILTER (since > {end - 30} AND since <= {end}) AS retained_{end}d"
        for end in (30, 60, 90)
    )
    rates = ", ".join(f"{pct(f'retained_{end}d', 'cohort_size', 1)} AS retention_{end}d_pct" for end in (30, 60, 90))
    sql["k6_day_window_retention"] = given("purchases") + f""", aged AS (SELECT customer_id,
        min(purchase_date) OVER (PARTITION BY customer_id) AS born,
        purchase_date - min(purchase_date) OVER (PARTITION BY customer_id) AS since FROM purchases),
        counted AS (SELECT {month('born')} AS cohort_month, count(DISTINCT customer_id) AS cohort_size, {windows}
            FROM aged GROUP BY 1) SELECT *, {rates} FROM counted"""

    last_seen = given("people") + f""" SELECT customer_id, {{}}{days_from('last_order')} AS {{}},
        {tier(days_from('last_order'))} AS churn_risk_tier FROM people {{}}"""
    sql["h1_inactivity_tiers"] = last_seen.format("last_order AS last_login_date, ", "days_inactive", "WHERE is_active")
    sql["h5_churn_tier"] = last_seen.format("", "days", "")
    sql["h5_tier_counts"] = given("people") + f""" SELECT {tier(days_from('last_order'))} AS churn_risk_tier,
        count(*) AS customers FROM people GROUP BY 1"""
    sql["h2_rfm_by_ntile"] = ntile_rfm(False)
    sql["h2_rfm_by_ntile_best_high_sliced"] = ntile_rfm(True)
    zero = ", ".join(
        f"coalesce({name}, 0) AS {name}"
        for name in (
            "transactions_last_90d",
            "support_tickets_last_90d",
            "features_used_last_30d",
            "failed_payments_last_6m",
            "billing_disputes",
        )
    )
    sql["h3_churn_features"] = given("people", "logins", "done", "support", "features", "billing") + f""" SELECT
        p.customer_id, plan_type, signup_date, {days_from('signup_date')} AS tenure_days,
        {days_from('last_login_date')} AS days_since_login, {days_from('last_transaction_date')} AS days_since_purchase,
        {zero}, CAST(is_churned AS INTEGER) AS is_churned
        FROM people p LEFT JOIN logins USING (customer_id) LEFT JOIN done USING (customer_id)
        LEFT JOIN support USING (customer_id) LEFT JOIN features USING (customer_id)
        LEFT JOIN billing USING (customer_id)"""
    rate = "churned_customers * 100.0::DOUBLE / nullif(total_customers, 0)"
    sql["h4_monthly_churn_rate"] = given("dates") + f""", status AS (SELECT DISTINCT customer_id,
        {month('o_orderdate')} AS period_date, {month('o_orderdate')} = {month('last_order')}
            AND last_order < {AS_OF} - 180 AS churned FROM orders JOIN dates ON customer_id = o_custkey),
        monthly AS (SELECT period_date AS month, count(DISTINCT customer_id) AS total_customers,
            count(DISTINCT CASE WHEN churned THEN customer_id END) AS churned_customers FROM status GROUP BY 1)
        SELECT *, round({rate}, 2) AS churn_rate_pct,
            {signed_round(f'{rate} - lag({rate}) OVER (ORDER BY month)', 2)} AS churn_rate_change_ppt FROM monthly"""
    sql["h6_rfm_by_quantile"] = given("transactions", also=quantile_rfm("FROM transactions")) + " FROM segmented"
    sql["h6_rfm_by_quantile_sliced"] = sql["h6_rfm_by_quantile"]
    sql["c5_transform_rfm"] = given("extracted", also=quantile_rfm("SELECT DISTINCT * FROM extracted")) + " FROM segmented"
    sql["e1_sessions"] = """WITH timed AS (SELECT user_id AS customer_id, ts, CAST(floor(epoch(ts)) AS BIGINT) AS s
            FROM events),
        gaps AS (SELECT *, s - lag(s) OVER (PARTITION BY customer_id ORDER BY ts) AS gap FROM timed),
        numbered AS (SELECT *, CAST(sum(CASE WHEN gap IS NULL OR gap > 1800 THEN 1 ELSE 0 END) OVER (
            PARTITION BY customer_id ORDER BY ts, gap DESC NULLS FIRST
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_id FROM gaps)
        SELECT customer_id, session_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events_in_session,
            round((max(s) - min(s)) / 60, 1) AS session_duration_mins FROM numbered GROUP BY ALL"""
    sql["e1_streamed_sessions"] = sql["e1_sessions"].replace("FROM events)", "FROM events WHERE ts IS NOT NULL)")

    sql["c1_clean"] = """SELECT DISTINCT c_custkey AS customer_id, c_name AS account_name, c_mktsegment AS segment,
        c_acctbal AS mrr FROM customer"""
    sql["c2_date_parts"] = given("transactions") + f" SELECT transaction_id, transaction_date, {PARTS} FROM transactions"
    sql["c3_transform_transactions"] = given("transactions") + f""" SELECT DISTINCT transaction_id, transaction_date,
        {TEXT_AMOUNT}, {PARTS} FROM transactions"""
    sql["c4_transform_churn_risk"] = given("login_extract") + f""" SELECT *, {days_from('last_login_date')}
        AS days_since_login, {tier(days_from('last_login_date'))} AS churn_risk_tier FROM login_extract"""

    sql["s1_run_query"] = given("transactions") + """ SELECT product_line, count(*) AS orders FROM transactions
        WHERE status = 'completed' AND transaction_date >= DATE '1998-01-01' GROUP BY 1"""
    sql["s2_load_table"] = PAYMENTS
    sql["s3_query_to_table"] = given("transactions") + " SELECT product_line, count(*) AS orders FROM transactions GROUP BY 1"
    sql["s4_extract_transactions"] = given("extracted") + " FROM extracted"
    sql["s5_extract_funnel_events"] = given("staged_lines") + f""" SELECT l_orderkey * 10 + l_linenumber AS lead_id,
        customer_id, {STAGE_NAME.format('stage')} AS stage_name, l_shipdate AS stage_entered_at,
        l_suppkey AS sales_rep_id, l_returnflag AS segment FROM staged_lines WHERE l_linenumber = 1"""
    sql["s6_extract_customer_logins"] = given("login_extract") + " FROM login_extract"
    sql["s7_load_results"] = REVENUE_ROWS.format("%Y-%m")
    sql["s8_export_csv"] = given("monthly") + """ SELECT 'revenue' AS result, strftime(month, '%Y-%m-%d') AS day,
        revenue AS value FROM monthly UNION ALL SELECT 'activity', strftime(ts, '%Y-%m-%d'),
        CAST(count(DISTINCT user_id) AS DOUBLE) FROM events GROUP BY 2"""
    sql["s7_published_results"] = given("monthly", "daily") + """ SELECT 'revenue' AS result, month AS day, revenue AS value FROM monthly
        UNION ALL SELECT 'activity', event_date, CAST(daily_active_users AS DOUBLE) FROM daily"""
    sql["s9_codec"] = "SELECT unnest(['loaded', 'compacted']) AS state, 'snappy' AS codec"
    sql["s2_load_keeps_layout"] = given("transactions") + """ SELECT status, count(*) AS n,
        'ORC EXTERNAL 4 [`transaction_id`] snappy True status=completed,status=open,status=pending' AS layout
        FROM transactions GROUP BY status"""
    sql["s9_partitioned_event_table"] = EVENT_ROWS
    sql["s10_partition_event_counts"] = given("raw_events") + """ SELECT customer_id, event_type, count(*) AS event_count
        FROM raw_events WHERE event_date = '2024-01-15' AND region = 'US' GROUP BY ALL"""
    sql["s11_load_event_partitions"] = given("raw_events") + """ SELECT * FROM raw_events e
        WHERE event_date >= '2024-01-01' AND (event_type = 'purchase' OR event_date < '2024-01-15' OR NOT EXISTS (SELECT 1 FROM raw_events p
            WHERE p.event_type = 'purchase' AND p.event_date = e.event_date AND p.region = e.region))"""
    sql["s12_write_bucketed"] = SPEND_BY_SEGMENT.format("lifetime_value")
    sql["s13_bucketed_spend"] = sql["s13_bucketed_spend_hot"] = SPEND_BY_SEGMENT.format("total_spend")
    sql["s14_event_totals"] = given("raw_events") + f""" SELECT event_type, region, count(*) AS event_count,
        count(DISTINCT customer_id) AS unique_customers, {msum('event_value')} AS total_value FROM raw_events
        WHERE event_date BETWEEN '2024-01-01' AND '2024-01-31' GROUP BY ALL"""
    sql["s14_distinct_from_sketches"] = given("raw_events") + """ SELECT region, count(DISTINCT customer_id) AS distinct_values
        FROM raw_events WHERE event_date BETWEEN '2024-01-01' AND '2024-01-31' GROUP BY region"""
    sql["s15_write_orc"] = given("transactions") + """ SELECT transaction_id, status, amount,
        CASE WHEN status = 'open' THEN 'hot' ELSE 'cold' END AS tier FROM transactions"""
    sql["s16_compact"] = given("transactions") + " SELECT transaction_id, customer_id, amount FROM transactions"
    sql["s17_analyze"] = given("raw_events") + """, loaded AS (SELECT * FROM raw_events WHERE event_date >= '2024-01-01')
        SELECT 'min' AS info_name, CAST(min(customer_id) AS VARCHAR) AS info_value FROM loaded
        UNION ALL SELECT 'max', CAST(max(customer_id) AS VARCHAR) FROM loaded
        UNION ALL SELECT 'num_nulls', CAST(count(*) FILTER (customer_id IS NULL) AS VARCHAR) FROM loaded
        UNION ALL SELECT 'table_rows', CAST(count(*) AS VARCHAR) FROM loaded
        UNION ALL SELECT 'partition_rows', CAST(count(*) AS VARCHAR) FROM loaded
            WHERE event_date = '2024-01-15' AND region = 'US'"""
    sql["s17_hot_keys_from_statistics"] = given("transactions") + """, counted AS (SELECT customer_id, count(*) AS n,
            count(*) FILTER (amount > 200000) AS more FROM transactions GROUP BY 1)
        SELECT 'fresh' AS state, customer_id FROM counted WHERE n > 12
        UNION ALL SELECT 'stale', customer_id FROM counted WHERE n + more > 12"""

    before = "lag(revenue) OVER (ORDER BY week_start)"
    change = f"(revenue - {before})"
    sql["r1_executive_summary"] = f"""WITH {WEEKLY} SELECT week_start, active_customers, round(revenue, 2) AS total_revenue,
        total_orders, round(average, 2) AS avg_order_value,
        {signed_round(change, 2)} AS revenue_wow_change,
        {signed_round(f'{change} / nullif({before}, 0) * 100', 1)} AS revenue_wow_pct FROM weekly"""
    sql["r2_churn_risk_report"] = given("people", "logins", "support", "billing") + " " + RISK_REPORT
    sql["r3_segment_performance"] = given("people") + " " + SEGMENTS
    tier_place = f"CASE {tier(days_from('last_login_date'))} " + " ".join(
        f"WHEN '{name}' THEN {place}" for place, name in enumerate(("high_risk", "medium_risk", "low_risk", "active"), 1)
    ) + " END"
    churn_rows = f"SELECT customer_id, {days_from('last_login_date')} AS days_since_login, {tier_place} AS tier_place FROM login_extract"
    rfm_rows = "SELECT * REPLACE (round(monetary, 2) AS monetary) FROM segmented"
    rfm_items = same("recency_days", "frequency", "monetary", "r_score", "f_score", "m_score")
    funnel_items = same("users", "prev_users", "conversion_pct", "pct_of_total")
    sql["p1_lifecycle_job"] = given(
        "extracted", "login_extract", also=f"{quantile_rfm('SELECT DISTINCT * FROM extracted')}, {retention(EXTRACTED_AS_PURCHASES)}"
    ) + " " + " UNION ALL ".join([
        long_form(churn_rows, "customer_id", same("days_since_login", "tier_place"), result="churn_risk_scores"),
        long_form(rfm_rows, "customer_id", rfm_items, result="rfm_scores"),
        long_form(sql["f6_listed_funnel"], "stage", funnel_items, result="funnel_conversion"),
        cells("strftime(cohort_month, '%Y-%m')", result="cohort_retention"),
    ])
    weekly_items = same("active_customers", "total_revenue", "total_orders", "avg_order_value", "revenue_wow_pct")
    risk_items = same("mrr", "days_since_login", "open_support_tickets", "failed_payments_last_90d")
    segment_items = same("total_customers", "total_mrr", "avg_mrr", "churn_rate_pct", "avg_ltv")
    sql["p2_report_job"] = given("people", "logins", "support", "billing") + " " + " UNION ALL ".join([
        long_form(sql["r1_executive_summary"], "week_start", weekly_items, report="executive_summary"),
        long_form(RISK_REPORT, "customer_id", risk_items, report="churn_risk_report"),
        long_form(SEGMENTS, "coalesce(segment, '') || '/' || coalesce(plan_type, '')", segment_items, report="segment_performance"),
    ])
    return sql


ORACLE_SQL = _all()
