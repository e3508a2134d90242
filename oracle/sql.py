"""DuckDB statements that state the expected result of each registered query.

Written independently of the Spark code: money is whole cents, ratios are integer
divisions rounded half up, point-in-time features are literal joins of every date to
every earlier fact. Columns are cast at the end to the portable types the Spark side
is shown in: BIGINT, DOUBLE, VARCHAR (dates too) and BOOLEAN.
"""

from __future__ import annotations


def ratio(num: str, den: str, digits: int) -> str:
    scale = 10 ** digits
    return (f"(CASE WHEN ({den}) = 0 THEN NULL ELSE (CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END) * "
            f"CAST((2 * abs(CAST(({num}) AS HUGEINT)) * {scale} + ({den})) // (2 * CAST(({den}) AS HUGEINT)) AS DOUBLE)"
            f" / {scale} END)")


def mean(cents: str, count: str, digits: int = 2) -> str:
    return ratio(cents, f"100 * ({count})", digits)


def pct(part: str, whole: str, digits: int = 2) -> str:
    return ratio(f"100 * ({part})", whole, digits)


def growth(now: str, before: str, digits: int = 2) -> str:
    return ratio(f"100 * (({now}) - ({before}))", before, digits)


def money(cents: str, name: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100 AS {name}"


def big(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {name or expr}"


def day(expr: str, name: str | None = None) -> str:
    return f"CAST(CAST({expr} AS DATE) AS VARCHAR) AS {name or expr}"


STAMP = "'2025-01-01 00:00:00'"

CTES = {
    "l_customers": """SELECT c_custkey AS customer_id, c_name AS name, CAST(NULL AS VARCHAR) AS address,
        CAST(c_nationkey AS BIGINT) AS nation_key, CAST(NULL AS VARCHAR) AS phone, c_acctbal AS account_balance,
        c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS notes FROM customer""",
    "l_orders": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
        o_totalprice AS order_amount, CAST(round(o_totalprice * 100) AS BIGINT) AS amount_c,
        CAST(o_orderdate AS DATE) AS order_date, o_orderpriority AS priority, CAST(NULL AS VARCHAR) AS sales_clerk,
        CAST(NULL AS BIGINT) AS ship_priority, CAST(NULL AS VARCHAR) AS notes FROM orders""",
    "l_items": """SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS supplier_id,
        CAST(l_linenumber AS BIGINT) AS line_number, l_orderkey || '-' || l_linenumber AS order_item_id,
        l_quantity AS quantity, CAST(round(l_quantity * 100) AS BIGINT) AS quantity_c,
        CASE WHEN l_quantity <> 0 THEN l_extendedprice / l_quantity END AS unit_price,
        CAST(round(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) * 100 AS BIGINT)
            AS line_total_c,
        l_discount AS discount_rate, l_returnflag AS return_flag, l_linestatus AS line_status,
        CAST(l_shipdate AS DATE) AS ship_date FROM lineitem""",
    "l_products": """SELECT p_partkey AS product_id, p_name AS product_name, CAST(NULL AS VARCHAR) AS manufacturer,
        p_brand AS brand, string_split(p_type, ' ')[-1] AS category, p_type AS full_type,
        CAST(p_size AS BIGINT) AS product_size, CAST(NULL AS VARCHAR) AS container_type,
        p_retailprice AS unit_price, CAST(NULL AS VARCHAR) AS notes FROM part""",
    "l_reps": """SELECT s_suppkey AS rep_id, s_name AS name, CAST(NULL AS VARCHAR) AS address,
        CAST(s_nationkey AS BIGINT) AS nation_key, CAST(NULL AS VARCHAR) AS phone, s_acctbal AS account_balance,
        abs(CAST(round(s_acctbal * 100) AS BIGINT)) * 100 AS quota_c, 'Active' AS status,
        CAST(NULL AS VARCHAR) AS notes FROM supplier""",
    "l_territories": """SELECT CAST(n_nationkey AS BIGINT) AS territory_id, n_name AS territory_name,
        CAST(r_regionkey AS BIGINT) AS region_id, r_name AS region, CAST(NULL AS VARCHAR) AS manager_id
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "s_customers": """SELECT customer_id, name, address, nation_key, phone, account_balance,
        upper(trim(segment)) AS segment, notes FROM
        (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY name DESC) AS rn FROM l_customers
         WHERE customer_id IS NOT NULL) WHERE rn = 1""",
    "s_territories": """SELECT territory_id, trim(territory_name) AS territory_name, region_id,
        upper(trim(region)) AS region, manager_id FROM l_territories
        WHERE territory_id IS NOT NULL AND territory_name IS NOT NULL""",
    "s_products": """SELECT product_id, product_name, manufacturer, brand,
        upper(trim(coalesce(nullif(category, ''), 'UNKNOWN'))) AS category, full_type, product_size,
        container_type, unit_price, notes FROM
        (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY product_name DESC) AS rn FROM l_products
         WHERE product_id IS NOT NULL AND unit_price > 0) WHERE rn = 1""",
    "s_reps": """SELECT rep_id, name, address, nation_key, phone, account_balance,
        CASE WHEN quota_c < 0 THEN 0 ELSE quota_c END AS quota_c, coalesce(status, 'Active') AS status, notes FROM
        (SELECT *, row_number() OVER (PARTITION BY rep_id ORDER BY name DESC) AS rn FROM l_reps
         WHERE rep_id IS NOT NULL) WHERE rn = 1""",
    "s_orders": """SELECT order_id, customer_id, CASE status WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Fulfilled'
        WHEN 'P' THEN 'Processing' ELSE 'Unknown' END AS status, order_amount, amount_c, order_date, priority,
        sales_clerk, ship_priority, notes FROM l_orders
        WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_date <= DATE '2025-01-01' AND amount_c > 0
          AND customer_id IN (SELECT customer_id FROM s_customers)""",
    "s_items": """SELECT * FROM l_items WHERE order_item_id IS NOT NULL AND order_id IS NOT NULL
        AND product_id IS NOT NULL AND quantity > 0 AND unit_price > 0 AND line_total_c > 0
        AND abs(quantity * unit_price * (1 - coalesce(discount_rate, 0)) - line_total_c / 100.0) < 1.0
        AND order_id IN (SELECT order_id FROM s_orders) AND product_id IN (SELECT product_id FROM s_products)""",
    "fact": """SELECT i.order_item_id AS order_item_key, o.order_id, o.customer_id, i.product_id,
        i.supplier_id AS rep_id, c.nation_key AS territory_id, o.order_date AS date_key, i.quantity_c, i.quantity,
        CAST(round(i.unit_price * 100000000) AS BIGINT) AS unit_price_e8, i.discount_rate,
        i.line_total_c AS revenue_c, o.amount_c AS order_total_c, o.status AS order_status, i.return_flag,
        i.line_status FROM s_items i JOIN s_orders o ON i.order_id = o.order_id
        JOIN s_customers c ON o.customer_id = c.customer_id""",
    # The fixed calendar, made to cover the orders.
    "days": """SELECT least(TIMESTAMP '1992-01-01', min(o_orderdate)) AS first_day,
        greatest(TIMESTAMP '2000-01-01', max(o_orderdate)) AS last_day FROM orders""",
    "d_dates": """SELECT CAST(d AS DATE) AS date_key, year(d) AS year, month(d) AS month, quarter(d) AS quarter,
        strftime(d, '%B') AS month_name, strftime(d, '%Y-%m') AS year_month,
        CAST(date_trunc('month', d) AS DATE) AS month_start
        FROM (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d FROM days)""",
    "d_reps": """SELECT r.rep_id, r.name, r.nation_key, t.territory_name, t.region, r.quota_c, r.status
        FROM s_reps r LEFT JOIN s_territories t ON r.nation_key = t.territory_id""",
    "d_customers": """SELECT c.customer_id, c.name, c.address, c.nation_key, t.territory_name, t.region, c.phone,
        c.account_balance, c.segment, count(DISTINCT o.order_id) AS lifetime_order_count,
        coalesce(sum(o.amount_c), 0) AS lifetime_c, min(o.order_date) AS first_order_date,
        max(o.order_date) AS last_order_date,
        date_diff('day', min(o.order_date), max(o.order_date)) AS customer_tenure_days
        FROM s_customers c LEFT JOIN s_orders o ON c.customer_id = o.customer_id
        LEFT JOIN s_territories t ON c.nation_key = t.territory_id GROUP BY ALL""",
    "monthly": """SELECT d.year, d.month, d.month_name, d.year_month, d.quarter, t.territory_id, t.territory_name,
        t.region, count(DISTINCT f.order_id) AS total_orders, count(DISTINCT f.customer_id) AS unique_customers,
        count(f.order_item_key) AS total_line_items, sum(f.revenue_c) AS revenue_c, """
        + mean("sum(f.revenue_c)", "count(f.revenue_c)") + " AS avg_line_item_value, "
        + mean("sum(f.order_total_c)", "count(DISTINCT f.order_id)") + """ AS avg_order_value,
        max(f.order_total_c) AS max_c, min(f.order_total_c) AS min_c
        FROM fact f JOIN d_dates d ON f.date_key = d.date_key JOIN s_territories t ON f.territory_id = t.territory_id
        GROUP BY ALL""",
    "newest": "SELECT max(order_date) AS newest FROM s_orders",
    "clv": """SELECT c.*, date_diff('day', c.last_order_date, n.newest) AS recency_days,
        CASE WHEN p >= 0.75 THEN 'High-Value' WHEN p >= 0.50 THEN 'Medium-Value' WHEN p >= 0.25 THEN 'Low-Value'
             ELSE 'Minimal-Value' END AS value_segment,
        CASE WHEN date_diff('day', c.last_order_date, n.newest) > 365 THEN 'Churned'
             WHEN date_diff('day', c.last_order_date, n.newest) > 180 THEN 'At-Risk'
             WHEN date_diff('day', c.last_order_date, n.newest) > 90 THEN 'Dormant' ELSE 'Active' END
             AS engagement_status
        FROM (SELECT *, percent_rank() OVER (ORDER BY lifetime_c) AS p FROM d_customers) c, newest n""",
    "perf": """SELECT p.product_id, p.product_name, p.category, p.manufacturer, p.brand, p.unit_price,
        count(DISTINCT f.order_id) AS total_orders, CAST(round(sum(f.quantity_c) / 100.0) AS BIGINT) AS total_units_sold,
        sum(f.revenue_c) AS revenue_c, """ + mean("sum(f.revenue_c)", "count(*)") + " AS avg_revenue_per_line, "
        + mean("sum(f.quantity_c)", "count(DISTINCT f.order_id)") + """ AS avg_units_per_order,
        count(CASE WHEN f.return_flag = 'R' THEN 1 END) AS returned_items, """
        + pct("count(CASE WHEN f.return_flag = 'R' THEN 1 END)", "count(*)") + """ AS return_rate_pct,
        dense_rank() OVER (ORDER BY sum(f.revenue_c) DESC) AS revenue_rank,
        dense_rank() OVER (ORDER BY sum(f.quantity_c) DESC) AS volume_rank,
        CASE WHEN dense_rank() OVER (ORDER BY sum(f.revenue_c) DESC) <= 20 THEN 'Top 20'
             WHEN dense_rank() OVER (ORDER BY sum(f.revenue_c) DESC) <= 100 THEN 'Top 100' ELSE 'Long Tail' END
             AS product_flag
        FROM fact f JOIN s_products p ON f.product_id = p.product_id
        GROUP BY p.product_id, p.product_name, p.category, p.manufacturer, p.brand, p.unit_price""",
    "score": """SELECT r.rep_id, r.name, r.territory_name, r.region, r.quota_c,
        count(DISTINCT f.customer_id) AS unique_customers, count(DISTINCT f.order_id) AS total_orders,
        sum(f.revenue_c) AS revenue_c, """ + mean("sum(f.revenue_c)", "count(*)") + """ AS avg_revenue_per_line,
        max(f.order_total_c) AS largest_c, """ + ratio("sum(f.revenue_c)", "r.quota_c", 4)
        + " AS quota_attainment_ratio, " + pct("sum(f.revenue_c)", "r.quota_c", 1) + """ AS quota_attainment_pct,
        CAST(round(sum(f.quantity_c) / 100.0) AS BIGINT) AS total_units_sold,
        CASE WHEN r.quota_c = 0 THEN 'At Risk' WHEN sum(f.revenue_c) >= r.quota_c THEN 'Exceeds Quota'
             WHEN sum(f.revenue_c) * 10 >= r.quota_c * 8 THEN 'On Track'
             WHEN sum(f.revenue_c) * 10 >= r.quota_c * 5 THEN 'Below Target' ELSE 'At Risk' END AS performance_status
        FROM fact f JOIN d_reps r ON f.rep_id = r.rep_id GROUP BY r.rep_id, r.name, r.territory_name, r.region, r.quota_c""",
    "rfm": """SELECT customer_id, date_diff('day', max(date_key), (SELECT newest FROM newest)) AS recency_days,
        count(DISTINCT order_id) AS frequency, sum(revenue_c) AS monetary_c FROM fact GROUP BY customer_id""",
    "seg": """SELECT s.customer_id, c.name, c.segment, c.territory_name, c.region, s.recency_days, s.frequency,
        s.monetary_c, r AS r_score, f AS f_score, m AS m_score, r + f + m AS rfm_total_score,
        CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'VIP' WHEN r >= 3 AND f >= 3 THEN 'Loyal'
             WHEN r >= 4 AND f <= 2 THEN 'New Customer' WHEN r <= 2 AND m >= 4 THEN 'At-Risk High-Value'
             WHEN r <= 2 AND f <= 2 THEN 'Churned' ELSE 'Growing' END AS customer_segment
        FROM (SELECT *, ntile(5) OVER (ORDER BY recency_days ASC, customer_id) AS r,
              ntile(5) OVER (ORDER BY frequency DESC, customer_id) AS f,
              ntile(5) OVER (ORDER BY monetary_c DESC, customer_id) AS m FROM rfm) s
        JOIN d_customers c ON s.customer_id = c.customer_id""",
    "rep_month": """SELECT *, lag(revenue_c) OVER (PARTITION BY rep_id ORDER BY year, month) AS prev_c FROM (
        SELECT d.year, d.month, d.month_name, d.year_month, d.quarter, r.rep_id, r.name AS rep_name,
        r.territory_name, r.region, r.quota_c, count(DISTINCT f.customer_id) AS unique_customers,
        count(DISTINCT f.order_id) AS orders_closed, sum(f.revenue_c) AS revenue_c, count(*) AS n
        FROM fact f JOIN d_dates d ON f.date_key = d.date_key JOIN d_reps r ON f.rep_id = r.rep_id GROUP BY ALL)""",
    "rep_product": "SELECT *, " + mean("revenue_c", "n") + " AS avg_revenue_per_line, "
        + ratio("revenue_c", "quota_c", 4) + " AS quota_attainment_ratio, "
        + pct("revenue_c", "quota_c", 1) + " AS quota_attainment_pct, "
        + growth("revenue_c", "prev_c") + """ AS mom_growth_pct,
        CASE WHEN quota_c = 0 THEN 'At Risk' WHEN revenue_c >= quota_c THEN 'Exceeds Quota'
             WHEN revenue_c * 10 >= quota_c * 8 THEN 'On Track'
             WHEN revenue_c * 10 >= quota_c * 5 THEN 'Below Target' ELSE 'At Risk' END AS performance_status
        FROM rep_month""",
    "spend": """SELECT f.customer_id, d.year_month, CAST(sum(f.revenue_c) AS BIGINT) AS spend_c FROM fact f
        JOIN d_dates d ON f.date_key = d.date_key GROUP BY ALL""",
    "spend_stats": "SELECT customer_id, count(*) AS months_active, CAST(round(100 * "
        + mean("sum(spend_c)", "count(*)") + """) AS BIGINT) AS avg_c,
        CAST(floor(sqrt(CAST(count(*) * sum(CAST(spend_c AS HUGEINT) * spend_c) - sum(spend_c) * sum(spend_c) AS DOUBLE))
             / count(*) + 0.5) AS BIGINT) AS std_c FROM spend GROUP BY customer_id""",
    "forecast": """SELECT s.customer_id, c.name, c.segment, c.territory_name, c.region, c.lifetime_c, s.months_active,
        s.avg_c, s.avg_c * 12 AS projected_c, greatest((s.avg_c - s.std_c) * 12, 0) AS conservative_c,
        (s.avg_c + s.std_c) * 12 AS optimistic_c, s.std_c,
        CASE WHEN s.avg_c = 0 THEN 'Inactive' WHEN s.avg_c < 500000 THEN 'Low' WHEN s.avg_c < 2000000 THEN 'Medium'
             ELSE 'High' END AS forecast_tier
        FROM spend_stats s JOIN d_customers c ON s.customer_id = c.customer_id""",
    "cohort_base": """SELECT c.customer_id, CAST(date_trunc('month', c.first_order_date) AS DATE) AS cohort_month,
        date_diff('month', date_trunc('month', c.first_order_date), date_trunc('month', o.order_date))
            AS months_since_acquisition, o.amount_c
        FROM d_customers c JOIN s_orders o ON c.customer_id = o.customer_id WHERE c.first_order_date IS NOT NULL""",
    "cohort": """SELECT b.cohort_month, s.cohort_size, b.months_since_acquisition,
        count(DISTINCT b.customer_id) AS active_customers, """
        + pct("count(DISTINCT b.customer_id)", "s.cohort_size") + " AS retention_pct, sum(b.amount_c) AS revenue_c, "
        + mean("sum(b.amount_c)", "s.cohort_size") + """ AS ltv_per_acquiree
        FROM cohort_base b JOIN (SELECT cohort_month, count(DISTINCT customer_id) AS cohort_size FROM cohort_base
             WHERE months_since_acquisition = 0 GROUP BY cohort_month) s ON b.cohort_month = s.cohort_month
        GROUP BY b.cohort_month, s.cohort_size, b.months_since_acquisition""",
    "prod_month": """SELECT d.year, d.month, d.month_name, d.year_month, d.quarter, p.product_id, p.product_name,
        p.category, p.manufacturer, p.brand, count(DISTINCT f.order_id) AS total_orders,
        CAST(round(sum(f.quantity_c) / 100.0) AS BIGINT) AS total_units_sold, sum(f.revenue_c) AS revenue_c, """
        + ratio("sum(f.unit_price_e8)", "100000000 * count(*)", 2) + """ AS avg_unit_price,
        count(CASE WHEN f.return_flag = 'R' THEN 1 END) AS returned_items, """
        + pct("count(CASE WHEN f.return_flag = 'R' THEN 1 END)", "count(*)") + """ AS return_rate_pct
        FROM fact f JOIN s_products p ON f.product_id = p.product_id JOIN d_dates d ON f.date_key = d.date_key
        GROUP BY ALL""",
    "analytics": "SELECT *, " + growth("revenue_c", "prev_c") + """ AS mom_growth_pct,
        CASE WHEN revenue_rank <= 50 AND return_rate_pct < 5 THEN 'Star'
             WHEN (revenue_c - prev_c) * 100 > prev_c * 10 THEN 'Growth'
             WHEN return_rate_pct >= 10 THEN 'Underperforming' ELSE 'Stable' END AS performance_tier
        FROM (SELECT *, dense_rank() OVER (PARTITION BY year, month ORDER BY revenue_c DESC) AS revenue_rank,
              lag(revenue_c) OVER (PARTITION BY product_id ORDER BY year, month) AS prev_c FROM prod_month)""",
}


def _features(step: str) -> dict[str, str]:
    """The feature tables as literal joins of each date to all earlier facts."""
    return {
        "spine": f"""SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 {step})) AS DATE) AS d FROM days""",
        "fact_days": """SELECT product_id, date_key, sum(revenue_c) AS revenue_c, sum(quantity_c) AS quantity_c,
            count(DISTINCT CASE WHEN return_flag = 'R' THEN order_item_key END) AS returned,
            count(DISTINCT order_item_key) AS items FROM fact GROUP BY product_id, date_key""",
        "f_rfm_raw": """SELECT c.customer_id, s.d AS observation_date, strftime(s.d, '%Y-%m') AS valid_from,
            date_diff('day', max(f.date_key), s.d) AS recency_days,
            count(DISTINCT CASE WHEN f.date_key >= CAST(s.d - INTERVAL 12 MONTH AS DATE) THEN f.order_id END) AS frequency_12m,
            coalesce(sum(CASE WHEN f.date_key >= CAST(s.d - INTERVAL 12 MONTH AS DATE) THEN f.revenue_c END), 0)
                AS monetary_c
            FROM s_customers c CROSS JOIN spine s
            LEFT JOIN fact f ON f.customer_id = c.customer_id AND f.date_key <= s.d GROUP BY c.customer_id, s.d""",
        "f_rfm": """SELECT customer_id, observation_date, valid_from, recency_days, frequency_12m, monetary_c,
            r AS recency_score, f AS frequency_score, m AS monetary_score, r + f + m AS rfm_composite_score,
            CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'VIP' WHEN r >= 3 AND f >= 3 THEN 'Loyal'
                 WHEN r >= 4 AND f <= 2 THEN 'At-Risk' WHEN r <= 2 AND f <= 2 THEN 'Inactive' ELSE 'Engaged' END
                 AS estimated_segment
            FROM (SELECT *,
              ntile(5) OVER (PARTITION BY valid_from ORDER BY recency_days ASC NULLS LAST, customer_id, observation_date) AS r,
              ntile(5) OVER (PARTITION BY valid_from ORDER BY frequency_12m DESC, customer_id, observation_date) AS f,
              ntile(5) OVER (PARTITION BY valid_from ORDER BY monetary_c DESC, customer_id, observation_date) AS m
              FROM f_rfm_raw) WHERE recency_days IS NOT NULL""",
        "f_eng": """SELECT c.customer_id, s.d AS observation_date,
            date_diff('day', c.last_order_date, s.d) AS days_since_last_purchase,
            CASE WHEN date_diff('day', c.last_order_date, s.d) <= 30 THEN 'Active'
                 WHEN date_diff('day', c.last_order_date, s.d) <= 90 THEN 'Dormant'
                 WHEN date_diff('day', c.last_order_date, s.d) <= 180 THEN 'At-Risk' ELSE 'Churned' END
                 AS engagement_status, c.lifetime_c, c.lifetime_order_count, """
            + mean("c.lifetime_c", "c.lifetime_order_count") + " AS avg_order_value, c.customer_tenure_days, "
            + mean("c.lifetime_c", "c.customer_tenure_days", 4) + """ AS lifetime_value_per_day
            FROM d_customers c CROSS JOIN spine s WHERE s.d >= c.first_order_date""",
        "f_prod": """SELECT product_id, observation_date, revenue_c, revenue_12m_c, units_c, units_12m_c,
            total_returned_items, """ + pct("total_returned_items", "items") + """ AS return_rate_pct,
            dense_rank() OVER (PARTITION BY observation_date ORDER BY revenue_c DESC) AS revenue_rank FROM (
            SELECT p.product_id, s.d AS observation_date, coalesce(sum(f.revenue_c), 0) AS revenue_c,
            coalesce(sum(CASE WHEN f.date_key > CAST(s.d - INTERVAL 12 MONTH AS DATE) THEN f.revenue_c END), 0) AS revenue_12m_c,
            coalesce(sum(f.quantity_c), 0) AS units_c,
            coalesce(sum(CASE WHEN f.date_key > CAST(s.d - INTERVAL 12 MONTH AS DATE) THEN f.quantity_c END), 0) AS units_12m_c,
            coalesce(sum(f.returned), 0) AS total_returned_items, coalesce(sum(f.items), 0) AS items
            FROM s_products p CROSS JOIN spine s
            LEFT JOIN fact_days f ON f.product_id = p.product_id AND f.date_key <= s.d GROUP BY p.product_id, s.d)""",
        "f_rep": """SELECT *, """ + ratio("ytd_c", "quota_c", 4) + " AS quota_attainment_ratio, "
            + pct("ytd_c", "quota_c", 1) + """ AS quota_attainment_pct FROM (
            SELECT r.rep_id, s.d AS observation_date, r.quota_c,
            coalesce(sum(CASE WHEN year(f.date_key) = year(s.d) THEN f.revenue_c END), 0) AS ytd_c,
            coalesce(sum(f.revenue_c), 0) AS cumulative_c,
            count(DISTINCT CASE WHEN year(f.date_key) = year(s.d) THEN f.order_id END) AS ytd_orders,
            count(DISTINCT CASE WHEN year(f.date_key) = year(s.d) THEN f.customer_id END) AS ytd_customer_count
            FROM d_reps r CROSS JOIN spine s LEFT JOIN fact f ON f.rep_id = r.rep_id AND f.date_key <= s.d
            GROUP BY r.rep_id, s.d, r.quota_c)""",
        "t_customers": """SELECT r.customer_id, r.observation_date, r.recency_days, r.frequency_12m, r.monetary_c,
            r.rfm_composite_score, r.estimated_segment AS rfm_segment, e.days_since_last_purchase,
            e.engagement_status, e.lifetime_c, e.lifetime_order_count, e.avg_order_value, e.lifetime_value_per_day,
            c.segment AS source_segment, c.region
            FROM f_rfm r JOIN f_eng e ON r.customer_id = e.customer_id AND r.observation_date = e.observation_date
            JOIN d_customers c ON r.customer_id = c.customer_id""",
        "t_products": """SELECT f.*, p.category, p.manufacturer, p.unit_price FROM f_prod f
            JOIN s_products p ON f.product_id = p.product_id""",
    }


def statement(select: str, step: str = "DAY") -> str:
    """The select with every table expression in front of it; unused ones are not evaluated."""
    ctes = {**CTES, **_features(step)}
    needed, pending = [], [select]
    import re
    while pending:
        text = pending.pop()
        for name in ctes:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.append(name)
                pending.append(ctes[name])
    parts = ",\n".join(f"{name} AS ({ctes[name]})" for name in ctes if name in needed)
    return f"WITH {parts}\n{select}" if parts else select


# Final column lists, shared by several statements.
CUSTOMER = ("customer_id, name, address, nation_key, phone, account_balance, segment, notes")
ORDER = (f"order_id, customer_id, status, order_amount, {day('order_date')}, priority, sales_clerk, "
         "ship_priority, notes")
ITEM = (f"order_item_id, order_id, product_id, supplier_id, line_number, quantity, unit_price, "
        f"{money('line_total_c', 'line_total')}, discount_rate, return_flag, line_status, {day('ship_date')}, "
        "CAST(NULL AS VARCHAR) AS commit_date, CAST(NULL AS VARCHAR) AS receipt_date, CAST(NULL AS VARCHAR) AS ship_mode")
PRODUCT = ("product_id, product_name, manufacturer, brand, category, full_type, product_size, container_type, "
           "unit_price, notes")
REP = f"rep_id, name, address, nation_key, phone, account_balance, {money('quota_c', 'quota')}, status, notes"
TERRITORY = "territory_id, territory_name, region_id, region, manager_id"
MONTH = f"{big('year')}, {big('month')}, month_name, year_month, {big('quarter')}"
SLA_COLUMNS = "product_name, owner, refresh_frequency, last_refreshed_at, hours_since_refresh, age_unit, sla_status, current_row_count"
RFM = (f"customer_id, {day('observation_date')}, valid_from, {big('recency_days')}, {big('frequency_12m')}, "
       f"{money('monetary_c', 'monetary_12m')}, {big('recency_score')}, {big('frequency_score')}, "
       f"{big('monetary_score')}, {big('rfm_composite_score')}, estimated_segment")
PRODUCT_FEATURES = (
    f"product_id, {day('observation_date')}, {money('revenue_c', 'cumulative_revenue')}, "
    f"{money('revenue_12m_c', 'revenue_12m')}, {money('units_c', 'cumulative_units_sold')}, "
    f"{money('units_12m_c', 'units_sold_12m')}, {big('total_returned_items')}, return_rate_pct, {big('revenue_rank')}")
REP_FEATURES = (
    f"rep_id, {day('observation_date')}, {money('quota_c', 'quota')}, {money('ytd_c', 'ytd_revenue')}, "
    f"{money('cumulative_c', 'cumulative_revenue')}, {big('ytd_orders')}, quota_attainment_ratio, "
    f"quota_attainment_pct, {big('ytd_customer_count')}")
TRAINING_CUSTOMERS = (
    f"customer_id, {day('observation_date')}, {big('recency_days')}, {big('frequency_12m')}, "
    f"{money('monetary_c', 'monetary_12m')}, {big('rfm_composite_score')}, rfm_segment, "
    f"{big('days_since_last_purchase')}, engagement_status, {money('lifetime_c', 'lifetime_value')}, "
    f"{big('lifetime_order_count')}, avg_order_value, lifetime_value_per_day, source_segment, region")
COHORT = (f"{day('cohort_month')}, {big('cohort_size')}, {big('months_since_acquisition')}, "
          f"{big('active_customers')}, retention_pct, {money('revenue_c', 'cohort_revenue')}, ltv_per_acquiree")
ANALYTICS = (
    f"{MONTH}, product_id, product_name, category, manufacturer, brand, {big('total_orders')}, total_units_sold, "
    f"{money('revenue_c', 'total_revenue')}, avg_unit_price, {big('returned_items')}, return_rate_pct, "
    f"{big('revenue_rank')}, {money('prev_c', 'prev_month_revenue')}, mom_growth_pct, performance_tier")
CLV = (f"customer_id, name, segment, territory_name, region, {money('lifetime_c', 'lifetime_value')}, "
       f"{big('lifetime_order_count')}, {day('first_order_date')}, {day('last_order_date')}, "
       f"{big('customer_tenure_days')}, {big('recency_days')}, value_segment, engagement_status")
SEGMENTATION = (f"customer_id, name, segment, territory_name, region, {big('recency_days')}, {big('frequency')}, "
                f"{money('monetary_c', 'monetary')}, {big('r_score')}, {big('f_score')}, {big('m_score')}, "
                f"{big('rfm_total_score')}, customer_segment")
