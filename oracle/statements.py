"""Expected result of each named query, as DuckDB SQL over the given tables."""

from __future__ import annotations

from oracle.sql import (ANALYTICS, CLV, COHORT, CTES, CUSTOMER, ITEM, MONTH, ORDER, PRODUCT, PRODUCT_FEATURES, REP,
                        REP_FEATURES, RFM, SEGMENTATION, TERRITORY, TRAINING_CUSTOMERS, big, day, growth, mean, money,
                        pct, statement)

S: dict[str, str] = {}


def add(name: str, select: str, step: str = "DAY") -> None:
    S[name] = statement(select, step)


def rows(table: str, name: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {table}"


# --- landing and bronze
LANDING = {"customers": ("l_customers", CUSTOMER, "customer_id"), "orders": ("l_orders", ORDER, "order_id"),
           "order_items": ("l_items", ITEM, "order_id, line_number"), "products": ("l_products", PRODUCT, "product_id"),
           "sales_reps": ("l_reps", REP, "rep_id"), "territories": ("l_territories", TERRITORY, "territory_id")}
# Rows with equal keys are numbered by their remaining columns, in table order.
ITEM_TIES = ("product_id, supplier_id, order_item_id, quantity, unit_price, line_total_c, discount_rate, return_flag, "
             "line_status, ship_date")
for _name, (_table, _columns, _order) in LANDING.items():
    add(f"landing_{_name}", f"SELECT {_columns} FROM {_table}")
    _ties = f", {ITEM_TIES}" if _name == "order_items" else ""
    add(f"bronze_{_name}", f"""SELECT {_columns}, '2025-01-01 00:00:00' AS _loaded_at,
        'LANDING.{_name.upper()}' AS _source_table, row_number() OVER (ORDER BY {_order}{_ties}) AS _row_number
        FROM {_table}""")
S["bronze_orders_ranged"] = S["bronze_orders"]
S["bronze_orders_stored"] = S["bronze_orders"]
add("landing_counts", " UNION ALL ".join(rows(t, n.upper()) for n, (t, _, _) in LANDING.items()))


def _nulls(table: str, column: str, source: str, test: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
            f"{big(f'coalesce(sum(CASE WHEN {test} THEN 1 ELSE 0 END), 0)', 'null_count')}, "
            f"count(*) AS total_rows FROM {source}")


add("landing_null_profile", " UNION ALL ".join([
    _nulls("CUSTOMERS", "CUSTOMER_ID", "l_customers", "customer_id IS NULL"),
    _nulls("ORDERS", "ORDER_ID", "l_orders", "order_id IS NULL"),
    _nulls("ORDERS", "CUSTOMER_ID", "l_orders", "customer_id IS NULL"),
    _nulls("ORDERS", "ORDER_DATE", "l_orders", "order_date IS NULL"),
    _nulls("ORDER_ITEMS", "ORDER_ITEM_ID", "l_items", "order_item_id IS NULL"),
    _nulls("ORDER_ITEMS", "QUANTITY", "l_items", "quantity IS NULL OR quantity <= 0"),
    _nulls("PRODUCTS", "PRODUCT_ID", "l_products", "product_id IS NULL")]))
add("landing_order_span", f"""SELECT {day('min(order_date)', 'earliest_order')}, {day('max(order_date)', 'latest_order')},
    date_diff('year', min(order_date), max(order_date)) AS years_covered FROM l_orders""")
add("landing_revenue_profile", f"""SELECT count(DISTINCT customer_id) AS unique_customers,
    count(DISTINCT order_id) AS total_orders, {money('sum(amount_c)', 'total_revenue')},
    {mean('sum(amount_c)', 'count(*)')} AS avg_order_value, {money('min(amount_c)', 'min_order')},
    {money('max(amount_c)', 'max_order')} FROM l_orders""")
add("landing_segments", "SELECT segment, count(*) AS customers FROM l_customers GROUP BY segment")
add("landing_regions", "SELECT region, count(*) AS territory_count FROM l_territories GROUP BY region")


def _share(table: str, column: str, name: str) -> str:
    return (f"SELECT {column}, n AS {name}, {pct('n', 'total', 1)} AS pct FROM (SELECT {column}, count(*) AS n, "
            f"sum(count(*)) OVER () AS total FROM {table} GROUP BY {column})")


add("landing_status_share", _share("l_orders", "status", "count"))
add("bronze_parity", " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{n.upper()}' AS table_name, count(*) AS row_count FROM {t}"
    for layer in ("LANDING", "BRONZE") for n, (t, _, _) in LANDING.items()))
add("bronze_load_profile", """SELECT '2025-01-01 00:00:00' AS _loaded_at, 'LANDING.ORDERS' AS _source_table,
    count(*) AS rows FROM l_orders""")

# --- silver
add("silver_customers", f"SELECT {CUSTOMER} FROM s_customers")
add("silver_territories", f"SELECT {TERRITORY} FROM s_territories")
add("silver_products", f"SELECT {PRODUCT} FROM s_products")
add("silver_sales_reps", f"SELECT {REP} FROM s_reps")
add("silver_sales_reps_with_territory", f"""SELECT r.rep_id, r.name, r.address, r.nation_key, r.phone, r.account_balance,
    {money('r.quota_c', 'quota')}, r.status, r.notes, t.territory_name, t.region
    FROM s_reps r LEFT JOIN s_territories t ON r.nation_key = t.territory_id""")
add("silver_orders", f"SELECT {ORDER} FROM s_orders")
add("silver_orders_as_of", f"SELECT {ORDER} FROM s_orders WHERE order_date <= DATE '1999-01-01'")
add("silver_order_items", f"SELECT {ITEM} FROM s_items")
add("silver_unique_items", f"""SELECT {ITEM} FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY
    order_id DESC, product_id DESC, supplier_id DESC, line_number DESC, quantity DESC, unit_price DESC,
    line_total_c DESC, discount_rate DESC, return_flag DESC, line_status DESC, ship_date DESC) AS rn FROM s_items)
    WHERE rn = 1""")
add("silver_status_share", _share("s_orders", "status", "orders"))
add("silver_segments", "SELECT segment, count(*) AS customers FROM s_customers GROUP BY segment")
S["silver_customers_latest"] = S["silver_customers"]

# --- silver over damaged landing tables
DAMAGED = {
    "x_items": """SELECT * REPLACE (CASE WHEN discount_rate = 0 THEN 0.0 ELSE quantity END AS quantity,
        CASE WHEN line_number = 7 THEN -unit_price ELSE unit_price END AS unit_price,
        CASE WHEN discount_rate = 0.01 THEN 0 WHEN discount_rate = 0.02 THEN line_total_c + 500 ELSE line_total_c END
            AS line_total_c,
        CASE WHEN line_number = 6 AND return_flag = 'A' THEN NULL ELSE order_item_id END AS order_item_id,
        CASE WHEN line_number = 6 AND return_flag = 'N' THEN NULL ELSE order_id END AS order_id,
        CASE WHEN line_number = 5 AND return_flag = 'N' THEN NULL ELSE product_id END AS product_id) FROM l_items""",
    "x_products": """SELECT * REPLACE (CASE WHEN product_size > 45 THEN 0.0 ELSE unit_price END AS unit_price,
        CASE WHEN category = 'PROMO' THEN '' ELSE category END AS category) FROM l_products""",
    "x_good_products": """SELECT * REPLACE (upper(trim(coalesce(nullif(category, ''), 'UNKNOWN'))) AS category)
        FROM x_products WHERE unit_price > 0""",
    "x_reps": """SELECT * REPLACE (CASE WHEN nation_key = 1 THEN 0 WHEN nation_key <> 2 THEN quota_c END AS quota_c,
        'Active' AS status) FROM l_reps""",
    "x_orders": "SELECT * FROM s_orders WHERE order_date <= DATE '1999-01-01'",
    "x_checked": """SELECT *, CASE WHEN order_item_id IS NULL THEN 'NULL ORDER_ITEM_ID (Completeness)'
        WHEN order_id IS NULL THEN 'NULL ORDER_ID (Completeness)'
        WHEN quantity IS NULL OR quantity <= 0 THEN 'Invalid QUANTITY <= 0 (Validity)'
        WHEN unit_price IS NULL OR unit_price <= 0 THEN 'Invalid UNIT_PRICE <= 0 (Validity)'
        WHEN line_total_c IS NULL OR line_total_c <= 0 THEN 'Invalid LINE_TOTAL <= 0 (Validity)'
        WHEN abs(quantity * unit_price * (1 - coalesce(discount_rate, 0)) - line_total_c / 100.0) >= 1.0
            THEN 'Math check failed: qty * unit_price * (1-discount) != line_total (Validity)'
        WHEN order_id NOT IN (SELECT order_id FROM x_orders) THEN 'ORDER_ID not in Silver orders (Accuracy)'
        WHEN product_id IS NULL THEN 'NULL PRODUCT_ID (Completeness)'
        WHEN product_id NOT IN (SELECT product_id FROM x_good_products)
            THEN 'PRODUCT_ID not in Silver products (Accuracy)' END AS rejection_reason FROM x_items""",
    "x_log": """SELECT 'silver.customers' AS target_table, 'Completeness + Uniqueness' AS dq_dimension,
            'NULL CUSTOMER_ID removed; duplicates deduped' AS check_description, 0.9 AS warn_below,
            (SELECT count(*) FROM l_customers) AS total, (SELECT count(*) FROM s_customers) AS passed, 0 AS failed
        UNION ALL SELECT 'silver.orders', 'Completeness + Timeliness + Validity + Accuracy',
            'NULLs removed, future dates filtered, amount > 0, FK to customers checked', 0.95,
            (SELECT count(*) FROM l_orders), (SELECT count(*) FROM x_orders),
            (SELECT count(*) FROM l_orders) - (SELECT count(*) FROM x_orders)
        UNION ALL SELECT 'silver.order_items', 'All 6 DAMA Dimensions',
            'NULLs, qty/price validity, math check, FK accuracy checks applied', 0.9,
            (SELECT count(*) FROM x_items), (SELECT count(*) FROM x_checked WHERE rejection_reason IS NULL),
            (SELECT count(*) FROM x_checked WHERE rejection_reason IS NOT NULL)""",
}
LOG = f"""target_table, dq_dimension, check_description, passed AS records_passed, failed AS records_failed,
    {pct('passed', 'total')} AS pass_rate_pct, CASE WHEN passed < warn_below * total THEN 'WARN' ELSE 'PASS' END AS status,
    '2025-01-01 00:00:00' AS log_timestamp"""
REJECTED = f"""order_item_id, order_id, product_id, quantity, unit_price, {money('line_total_c', 'line_total')},
    rejection_reason"""
FLOW = f"""table_name, bronze_count, silver_count, bronze_count - silver_count AS rows_filtered,
    {pct('silver_count', 'bronze_count')} AS pass_rate_pct"""


def damaged(name: str, select: str) -> None:
    text = ", ".join(f"{n} AS ({q})" for n, q in DAMAGED.items())
    full = statement(f"SELECT * FROM placeholder WHERE '{' '.join(CTES)}' = ''")
    head = full[:full.rindex("\nSELECT * FROM placeholder")]
    S[name] = f"{head},\n{text}\n{select}"


def _flow(pairs: dict[str, tuple[str, str]]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, (SELECT count(*) FROM {b}) AS bronze_count, (SELECT count(*) FROM {s}) AS silver_count"
        for n, (b, s) in pairs.items())
    return f"SELECT {FLOW} FROM ({parts})"


damaged("damaged_silver_customers", f"SELECT {CUSTOMER} FROM s_customers")
damaged("damaged_silver_products", f"SELECT {PRODUCT} FROM x_good_products")
damaged("damaged_silver_sales_reps", f"SELECT {REP} FROM x_reps")
damaged("damaged_accepted_items", f"SELECT {ITEM} FROM x_checked WHERE rejection_reason IS NULL")
damaged("damaged_rejected_items", f"SELECT {REJECTED} FROM x_checked WHERE rejection_reason IS NOT NULL")
damaged("damaged_rejected_by_key", f"""SELECT * REPLACE (CASE WHEN rejection_reason = 'NULL PRODUCT_ID (Completeness)'
    THEN 'Unknown rejection reason' ELSE rejection_reason END AS rejection_reason) FROM (
    SELECT {REJECTED} FROM x_checked WHERE order_item_id NOT IN
    (SELECT order_item_id FROM x_checked WHERE rejection_reason IS NULL))""")
damaged("damaged_rejection_summary", """SELECT rejection_reason, count(*) AS rejected_rows FROM x_checked
    WHERE rejection_reason IS NOT NULL GROUP BY rejection_reason""")
damaged("damaged_row_flow", _flow({
    "customers": ("l_customers", "s_customers"), "orders": ("l_orders", "x_orders"),
    "order_items": ("x_items", "(SELECT 1 FROM x_checked WHERE rejection_reason IS NULL)"),
    "products": ("x_products", "x_good_products"), "sales_reps": ("l_reps", "x_reps"),
    "territories": ("l_territories", "s_territories")}))
damaged("damaged_quality_log", f"SELECT {LOG} FROM x_log")
_BAD_VALUES = "quantity <= 0 OR unit_price <= 0 OR line_total_c <= 0"
_BAD_MATH = "abs(quantity * unit_price * (1 - coalesce(discount_rate, 0)) - line_total_c / 100.0) >= 1.0"


def check(name: str, source: str, where: str, value: str = "failed_rows") -> str:
    return f"SELECT '{name}' AS check_name, count(*) AS {value} FROM {source} WHERE {where}"


damaged("damaged_raw_checks", " UNION ALL ".join([
    check("orders non-positive amount", "l_orders", "amount_c <= 0"),
    check("order_items non-positive qty/price/total", "x_items", _BAD_VALUES),
    check("order_items line total math mismatch", "x_items", _BAD_MATH),
    check("orders future-dated rows", "l_orders", "order_date > DATE '1999-01-01'"),
    check("orders orphan customer_id", "l_orders o LEFT JOIN s_customers c ON o.customer_id = c.customer_id",
          "c.customer_id IS NULL"),
    check("order_items orphan order_id", "x_items i LEFT JOIN l_orders o ON i.order_id = o.order_id",
          "o.order_id IS NULL"),
    check("order_items orphan product_id", "x_items i LEFT JOIN x_good_products p ON i.product_id = p.product_id",
          "p.product_id IS NULL"),
    check("customers.customer_id nulls", "l_customers", "customer_id IS NULL"),
    check("orders.customer_id/order_id/date nulls", "l_orders",
          "order_id IS NULL OR customer_id IS NULL OR order_date IS NULL"),
    check("order_items critical nulls", "x_items", "order_item_id IS NULL OR order_id IS NULL OR product_id IS NULL"),
    check("orders invalid normalized status", "l_orders", "status NOT IN ('Open', 'Fulfilled', 'Processing', 'Unknown')"),
    check("customers segment not upper-trimmed", "(SELECT ' ' || lower(segment) || ' ' AS segment FROM l_customers)",
          "segment <> upper(trim(segment))"),
    check("territories region not upper-trimmed", "l_territories", "region <> upper(trim(region))")]))

# --- quality
add("quality_completeness", " UNION ALL ".join([
    check("customers.customer_id nulls", "s_customers", "customer_id IS NULL"),
    check("orders.customer_id/order_id/date nulls", "s_orders",
          "order_id IS NULL OR customer_id IS NULL OR order_date IS NULL"),
    check("order_items critical nulls", "s_items", "order_item_id IS NULL OR order_id IS NULL OR product_id IS NULL")]))
add("quality_uniqueness", " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, count(*) AS duplicate_keys FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)"
    for n, t, k in (("customers duplicate customer_id", "s_customers", "customer_id"),
                    ("orders duplicate order_id", "s_orders", "order_id"),
                    ("order_items duplicate order_item_id", "s_items", "order_item_id"))))
add("quality_timeliness", check("orders future-dated rows", "l_orders", "order_date > DATE '1999-01-01'"))
add("quality_validity", " UNION ALL ".join([
    check("orders non-positive amount", "s_orders", "amount_c <= 0"),
    check("order_items non-positive qty/price/total", "s_items", _BAD_VALUES),
    check("order_items line total math mismatch", "s_items", _BAD_MATH)]))
add("quality_accuracy", " UNION ALL ".join([
    check("orders orphan customer_id", "s_orders o LEFT JOIN s_customers c ON o.customer_id = c.customer_id",
          "c.customer_id IS NULL"),
    check("order_items orphan order_id", "s_items i LEFT JOIN s_orders o ON i.order_id = o.order_id", "o.order_id IS NULL"),
    check("order_items orphan product_id", "s_items i LEFT JOIN s_products p ON i.product_id = p.product_id",
          "p.product_id IS NULL")]))
add("quality_consistency", " UNION ALL ".join([
    check("orders invalid normalized status", "s_orders", "status NOT IN ('Open', 'Fulfilled', 'Processing', 'Unknown')"),
    check("customers segment not upper-trimmed", "s_customers", "segment <> upper(trim(segment))"),
    check("territories region not upper-trimmed", "s_territories", "region <> upper(trim(region))")]))
add("quality_row_flow", _flow({
    "customers": ("l_customers", "s_customers"), "orders": ("l_orders", "s_orders"),
    "order_items": ("l_items", "s_items"), "products": ("l_products", "s_products"),
    "sales_reps": ("l_reps", "s_reps"), "territories": ("l_territories", "s_territories")}))
QUALITY_LOG = f"""SELECT {LOG} FROM (
    SELECT 'silver.customers' AS target_table, 'Completeness + Uniqueness' AS dq_dimension,
        'NULL CUSTOMER_ID removed; duplicates deduped' AS check_description, 0.9 AS warn_below,
        (SELECT count(*) FROM l_customers) AS total, (SELECT count(*) FROM s_customers) AS passed,
        (SELECT count(*) FROM l_customers) - (SELECT count(*) FROM s_customers) AS failed
    UNION ALL SELECT 'silver.orders', 'Completeness + Timeliness + Validity + Accuracy',
        'NULLs removed, future dates filtered, amount > 0, FK to customers checked', 0.95,
        (SELECT count(*) FROM l_orders), (SELECT count(*) FROM s_orders),
        (SELECT count(*) FROM l_orders) - (SELECT count(*) FROM s_orders)
    UNION ALL SELECT 'silver.order_items', 'All 6 DAMA Dimensions',
        'NULLs, qty/price validity, math check, FK accuracy checks applied', 0.9,
        (SELECT count(*) FROM l_items), (SELECT count(*) FROM s_items),
        (SELECT count(*) FROM l_items) - (SELECT count(*) FROM s_items))"""
add("quality_log", QUALITY_LOG)
S["quality_log_built"], S["quality_row_flow_built"] = S["quality_log"], S["quality_row_flow"]
add("quality_reconcile", f"""SELECT 'Silver total revenue' AS source, {money('sum(line_total_c)', 'total_revenue')} FROM s_items
    UNION ALL SELECT 'Gold fact_orders revenue', {money('sum(revenue_c)', 'total_revenue')} FROM fact""")
_OUT = "date_key < (SELECT first_day FROM days) OR date_key > (SELECT last_day FROM days)"
add("quality_calendar_loss", f"""SELECT {big(f'sum(CASE WHEN {_OUT} THEN 1 ELSE 0 END)', 'lines_outside')},
    {money(f'sum(CASE WHEN {_OUT} THEN revenue_c ELSE 0 END)', 'revenue_outside')}, count(*) AS lines,
    {money('sum(revenue_c)', 'revenue')} FROM fact""")
add("quality_orders_in_month", """SELECT count(*) AS orders_in_month, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'SKIP' END AS status
    FROM s_orders WHERE date_trunc('month', order_date) = DATE '1999-01-01'""")
add("quality_revenue_variance", """SELECT CAST(gap AS DOUBLE) / 100 AS variance, gap <= 5000 AS within_tolerance FROM (
    SELECT abs((SELECT sum(amount_c) FROM s_orders WHERE month(order_date) = 6)
             - (SELECT sum(revenue_c) FROM rep_month WHERE month = 6)) AS gap)""")
add("quality_active_rep_drop", f"""SELECT a AS active_reps, p AS previous_active_reps, {pct('p - a', 'p')} AS drop_pct,
    CASE WHEN {pct('p - a', 'p')} > 10 THEN 'FAIL' ELSE 'PASS' END AS status FROM (
    SELECT count(CASE WHEN nation_key >= 5 AND status = 'Active' THEN 1 END) AS a,
           count(CASE WHEN status = 'Active' THEN 1 END) AS p FROM s_reps)""")
add("quality_no_shrink", """SELECT n AS row_count, o AS previous_row_count, CASE WHEN n < o THEN 'FAIL' ELSE 'PASS' END AS status
    FROM (SELECT count(CASE WHEN year < 1999 THEN 1 END) AS n, count(*) AS o FROM monthly)""")
add("quality_forecast_outliers", """SELECT positive_forecasts, outliers, p99, CASE WHEN p99 > 500000
    OR positive_forecasts < 100 THEN 'ALERT' ELSE 'PASS' END AS status FROM (
    SELECT count(CASE WHEN projected_c > 0 THEN 1 END) AS positive_forecasts,
    count(CASE WHEN projected_c > 100000000 THEN 1 END) AS outliers,
    round(quantile_cont(CAST(projected_c AS DOUBLE) / 100, 0.99), 4) AS p99 FROM forecast)""")
S["quality_forecast_outliers_ranged"] = S["quality_forecast_outliers"]
JOB = """SELECT 'silver_status_validation' AS job_name, 'SUCCESS' AS status, 'Validation succeeded: ' ||
    string_agg(status || '=' || n, ', ' ORDER BY status || '=' || n) AS message FROM (
    SELECT o.status, count(*) AS n FROM s_orders o JOIN s_items i ON o.order_id = i.order_id GROUP BY o.status)"""
add("quality_status_join", JOB)

# --- gold
add("gold_calendar_activity", f"""SELECT {day('d.date_key', 'date_key')}, d.year, d.month, d.quarter,
    week(d.date_key) AS week_of_year, dayofyear(d.date_key) AS day_of_year, day(d.date_key) AS day_of_month,
    strftime(d.date_key, '%a') AS day_name, d.month_name, d.year_month, dayofweek(d.date_key) NOT IN (0, 6) AS is_weekday,
    count(o.order_id) AS orders FROM d_dates d LEFT JOIN s_orders o ON d.date_key = o.order_date GROUP BY ALL""")
add("gold_dim_territories", f"SELECT {TERRITORY} FROM s_territories")
add("gold_dim_products", """SELECT product_id, product_name, manufacturer, brand, category, full_type, product_size,
    container_type, unit_price FROM s_products""")
add("gold_dim_sales_reps", f"""SELECT rep_id, name, nation_key, territory_name, region, {money('quota_c', 'quota')}, status
    FROM d_reps""")
add("gold_dim_customers", f"""SELECT customer_id, name, address, nation_key, territory_name, region, phone,
    account_balance, segment, lifetime_order_count, {money('lifetime_c', 'lifetime_value')}, {day('first_order_date')},
    {day('last_order_date')}, customer_tenure_days FROM d_customers""")
add("gold_fact_orders", f"""SELECT order_item_key, order_id, customer_id, product_id, rep_id, territory_id, {day('date_key')},
    quantity, CAST(unit_price_e8 AS DOUBLE) / 100000000 AS unit_price, CAST(discount_rate AS DOUBLE) AS discount_rate,
    {money('revenue_c', 'revenue')}, {money('order_total_c', 'order_total')}, order_status, return_flag, line_status,
    CAST(NULL AS VARCHAR) AS ship_mode FROM fact""")
S["gold_fact_orders_checked"] = S["gold_fact_orders"]
add("gold_monthly_sales_summary", f"""SELECT {MONTH}, territory_id, territory_name, region, total_orders, unique_customers,
    total_line_items, {money('revenue_c', 'total_revenue')}, avg_line_item_value, avg_order_value, avg_order_value_dedup,
    {money('max_c', 'max_order_value')}, {money('min_c', 'min_order_value')} FROM monthly JOIN (
    SELECT ym, territory, {mean('sum(total_c)', 'count(*)')} AS avg_order_value_dedup FROM (
        SELECT DISTINCT strftime(date_key, '%Y-%m') AS ym, territory_id AS territory, order_id, order_total_c AS total_c
        FROM fact) GROUP BY ALL) ON ym = year_month AND territory = territory_id""")
add("gold_customer_lifetime_value", f"SELECT {CLV} FROM clv")
PERF = f"""product_id, product_name, category, manufacturer, brand, unit_price, total_orders, total_units_sold,
    {money('revenue_c', 'total_revenue')}, avg_revenue_per_line, avg_units_per_order, returned_items, return_rate_pct,
    revenue_rank, volume_rank, product_flag"""
add("gold_product_performance", f"SELECT {PERF} FROM perf")
SCORE = f"""rep_id, name, territory_name, region, {money('quota_c', 'quota')}, unique_customers, total_orders,
    {money('revenue_c', 'total_revenue')}, avg_revenue_per_line, {money('largest_c', 'largest_order')},
    quota_attainment_ratio, quota_attainment_pct, total_units_sold, performance_status"""
add("gold_sales_rep_scorecard", f"SELECT {SCORE} FROM score")
add("gold_customer_segmentation", f"SELECT {SEGMENTATION} FROM seg")
for _n in ("customer_lifetime_value", "product_performance", "customer_segmentation"):
    S[f"gold_{_n}_ranged"] = S[f"gold_{_n}"]
add("gold_customer_segmentation_best5", f"""SELECT {SEGMENTATION} FROM (SELECT * REPLACE (
    CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'VIP' WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal'
         WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customer' WHEN r_score <= 2 AND m_score >= 4 THEN 'At-Risk High-Value'
         WHEN r_score <= 2 AND f_score <= 2 THEN 'Churned' ELSE 'Growing' END AS customer_segment,
    r_score + f_score + m_score AS rfm_total_score) FROM
    (SELECT * REPLACE (6 - r_score AS r_score, 6 - f_score AS f_score, 6 - m_score AS m_score) FROM seg))""")
add("gold_counts", " UNION ALL ".join(rows(t, n) for n, t in (
    ("dim_customers", "d_customers"), ("dim_products", "s_products"), ("dim_sales_reps", "d_reps"),
    ("dim_territories", "s_territories"), ("fact_orders", "fact"), ("monthly_sales_summary", "monthly"),
    ("sales_rep_scorecard", "score"), ("customer_segmentation", "seg"))))
S["gold_counts_built"] = S["gold_counts"]
add("gold_quarterly_revenue", f"""SELECT {big('year')}, {big('quarter')}, {money('sum(revenue_c)', 'quarterly_revenue')}
    FROM monthly GROUP BY year, quarter""")
S["gold_quarterly_revenue_all_dates"] = S["gold_quarterly_revenue"]
S["gold_quarterly_revenue_fixed_calendar"] = S["gold_quarterly_revenue"].replace(
    "greatest(TIMESTAMP '2000-01-01', max(o_orderdate))", "TIMESTAMP '2000-01-01'")
add("gold_top_customers", f"""SELECT customer_id, name, segment, {money('lifetime_c', 'lifetime_value')}, engagement_status,
    value_segment FROM clv ORDER BY lifetime_c DESC, customer_id LIMIT 10""")
add("gold_segment_share", _share("seg", "customer_segment", "customers"))

# --- data products
REP_PRODUCT = f"""{MONTH}, rep_id, rep_name, territory_name, region, {money('quota_c', 'quota')}, unique_customers,
    orders_closed, {money('revenue_c', 'revenue_generated')}, avg_revenue_per_line, quota_attainment_ratio,
    quota_attainment_pct, {money('prev_c', 'prev_month_revenue')}, mom_growth_pct, performance_status"""
add("product_sales_rep_monthly", f"SELECT {REP_PRODUCT} FROM rep_product")
add("product_top_reps", f"""SELECT {big('year')}, {big('month')}, rep_name, territory_name, {money('revenue_c', 'revenue_generated')},
    quota_attainment_pct, performance_status FROM rep_product WHERE year = (SELECT max(year) FROM rep_product)
    ORDER BY revenue_c DESC, rep_id, month LIMIT 10""")
FORECAST = f"""customer_id, name, segment, territory_name, region, {money('lifetime_c', 'lifetime_value')}, months_active,
    {money('avg_c', 'avg_monthly_revenue')}, {money('projected_c', 'projected_12month_revenue')},
    {money('conservative_c', 'conservative_forecast')}, {money('optimistic_c', 'optimistic_forecast')},
    {money('std_c', 'revenue_volatility')}, forecast_tier"""
add("product_revenue_forecast", f"SELECT {FORECAST} FROM forecast")
add("product_revenue_forecast_by_span", f"""SELECT customer_id, name, segment, {money('lifetime_c', 'lifetime_value')},
    months_active, {money('a', 'avg_monthly_revenue')}, {money('a * 12', 'projected_12month_revenue')},
    CAST((a * 12 * 95 + 50) // 100 AS DOUBLE) / 100 AS conservative_forecast,
    CAST((a * 12 * 105 + 50) // 100 AS DOUBLE) / 100 AS optimistic_forecast,
    CASE WHEN a IS NULL THEN 'Inactive' WHEN a < 10000 THEN 'Low' WHEN a < 50000 THEN 'Medium' ELSE 'High' END AS forecast_tier
    FROM (SELECT *, (2 * lifetime_c + months_active) // (2 * months_active) AS a FROM (
        SELECT *, date_diff('month', first_order_date, last_order_date) + 1 AS months_active FROM d_customers))""")
add("product_top_forecasts", f"""SELECT customer_id, name, segment, {money('projected_c', 'projected_12month_revenue')},
    {money('conservative_c', 'conservative_forecast')}, {money('optimistic_c', 'optimistic_forecast')}, forecast_tier
    FROM forecast ORDER BY projected_c DESC, customer_id LIMIT 10""")
add("product_acquisition_cohort", f"SELECT {COHORT} FROM cohort")
add("product_acquisition_cohort_cells", f"""SELECT {day('cohort_month')}, months_since_acquisition + 1 AS months_since_acquisition,
    count(DISTINCT customer_id) AS cohort_size, count(DISTINCT customer_id) AS active_customers,
    CAST(100 AS DOUBLE) AS retention_pct, {money('sum(amount_c)', 'cohort_revenue')},
    {mean('sum(amount_c)', 'count(DISTINCT customer_id)')} AS ltv_per_acquiree
    FROM cohort_base GROUP BY cohort_month, months_since_acquisition""")
add("product_first_cohort", f"""SELECT {COHORT} FROM cohort WHERE cohort_month = (SELECT min(cohort_month) FROM cohort)
    ORDER BY cohort.months_since_acquisition LIMIT 12""")
add("product_performance_analytics", f"SELECT {ANALYTICS} FROM analytics")
S["product_performance_analytics_ranged"] = S["product_performance_analytics"]
add("product_tier_distribution", f"""SELECT performance_tier, count(*) AS product_months,
    {mean('sum(revenue_c)', 'count(*)')} AS avg_revenue,
    {mean('sum(CAST(round(return_rate_pct * 100) AS BIGINT))', 'count(*)')} AS avg_return_rate
    FROM analytics GROUP BY performance_tier""")
add("product_growth_leaders", f"""SELECT year_month, product_name, category, {money('revenue_c', 'total_revenue')},
    {money('prev_c', 'prev_month_revenue')}, mom_growth_pct FROM analytics WHERE mom_growth_pct IS NOT NULL
    ORDER BY mom_growth_pct DESC, product_id, year_month LIMIT 10""")
add("product_top_products", f"""SELECT {big('year')}, {big('month')}, month_name, product_id, product_name, category,
    {money('revenue_c', 'total_revenue')}, total_units_sold, return_rate_pct, {big('revenue_rank')}, performance_tier
    FROM analytics ORDER BY analytics.year DESC, analytics.month DESC, analytics.revenue_rank, product_id LIMIT 10""")

# --- governance and reports
_PRODUCTS = {
    "sales_rep_monthly_performance": ("Sales Operations", "Daily", "HOUR", 3, "2025-01-01 09:00:00", "PASS", "PASS",
                                      "rep_month", "Monthly KPIs for each sales rep."),
    "customer_revenue_forecast": ("Finance", "Monthly", "DAY", 40, "2024-11-22 12:00:00", "WARN", "FAIL", "forecast",
                                  "12-month revenue projections per customer with confidence range."),
    "customer_acquisition_cohort": ("Marketing", "Weekly", "HOUR", 300, "2024-12-20 00:00:00", "FAIL", "FAIL", "cohort",
                                    "Customer retention and LTV by acquisition cohort month."),
    "product_performance_analytics": ("Product", "Weekly", "HOUR", 200, "2024-12-24 04:00:00", "WARN", "FAIL", "prod_month",
                                      "Monthly product performance metrics with revenue ranking, return rates, and growth trends."),
}


def _sla(names=tuple(_PRODUCTS), strict: bool = False) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS product_name, '{p[0]}' AS owner, '{p[1]}' AS refresh_frequency, '{p[4]}' AS last_refreshed_at,
        CAST({p[3]} AS BIGINT) AS hours_since_refresh, '{p[2]}' AS age_unit, '{p[6] if strict else p[5]}' AS sla_status,
        count(*) AS current_row_count FROM {p[7]}""" for n, p in _PRODUCTS.items() if n in names)


add("governance_sla_status", _sla())
add("governance_sla_status_three", _sla(tuple(_PRODUCTS)[:3]))
add("governance_sla_status_strict", _sla(strict=True))
VALIDATION = """SELECT 'task_validate_sales_rep_monthly_performance' AS task_name,
        'sales_rep_monthly_performance' AS product_name, '2025-01-01 12:00:00' AS executed_at,
        CASE WHEN o >= 100 AND r > 0 THEN 'PASS' ELSE 'FAIL' END AS result_status,
        CASE WHEN o >= 100 AND r > 0 THEN 'VALIDATION PASSED' ELSE 'VALIDATION FAILED' END || chr(10) ||
        CASE WHEN o >= 100 THEN 'PASS: Silver orders has ' || o || ' rows'
             ELSE 'FAIL: Silver orders has ' || o || ' rows (min 100 required)' END || chr(10) ||
        CASE WHEN r > 0 THEN 'PASS: ' || r || ' active sales reps' ELSE 'FAIL: No active sales reps found' END AS result_message
    FROM (SELECT (SELECT count(*) FROM s_orders) AS o, (SELECT count(*) FROM s_reps WHERE status = 'Active') AS r)
    UNION ALL SELECT 'task_validate_customer_revenue_forecast', 'customer_revenue_forecast', '2025-01-01 12:00:00',
        CASE WHEN c >= 1000 THEN 'PASS' ELSE 'FAIL' END,
        CASE WHEN c >= 1000 THEN 'VALIDATION PASSED' || chr(10) || 'PASS: dim_customers has ' || c || ' rows'
             ELSE 'VALIDATION FAILED' || chr(10) || 'FAIL: dim_customers has only ' || c || ' rows (min 1000 required)' END
    FROM (SELECT count(*) AS c FROM d_customers)
    UNION ALL SELECT 'task_validate_' || p, p, '2025-01-01 12:00:00', 'PASS', 'VALIDATION PASSED' || chr(10) || 'NO_RULES'
    FROM (VALUES ('customer_acquisition_cohort'), ('product_performance_analytics')) t(p)"""
add("governance_validation", VALIDATION)
_ITEMS = ("landing", "CUSTOMERS, ORDERS, ORDER_ITEMS, PRODUCTS, SALES_REPS, TERRITORIES")


def _gates(stale: bool) -> str:
    failing = 3 if stale else 0
    min_of = lambda *t: "least(" + ", ".join(f"(SELECT count(*) FROM {x})" for x in t) + ")"
    gates = [
        ("A1", "LANDING required tables present", "'6'", "6", "TRUE",
         "'Required LANDING tables: CUSTOMERS, ORDERS, ORDER_ITEMS, PRODUCTS, SALES_REPS, TERRITORIES'"),
        ("A2", "LANDING row counts non-zero", f"'MIN=' || {min_of(*[t for t, _, _ in LANDING.values()])}", "MIN > 0",
         f"{min_of(*[t for t, _, _ in LANDING.values()])} > 0", "'All core LANDING tables must contain data'"),
        ("B4", "Job telemetry present", "'1'", ">= 1", "TRUE", "'Expected at least one row in job_runs'"),
        ("B5", "Monitoring task success rate (7d)", f"CASE WHEN (SELECT count(*) FROM d_customers) >= 1000 "
         f"AND (SELECT count(*) FROM s_orders) >= 100 THEN '100.00' ELSE '75.00' END", ">= 95",
         "(SELECT count(*) FROM d_customers) >= 1000 AND (SELECT count(*) FROM s_orders) >= 100",
         "'Success rate over last 7 days from MONITORING.task_run_audit'"),
        ("C1", "DQ log populated", "'3'", ">= 1", "TRUE", "'Expected DQ check records in monitoring log'"),
        ("C2", "Silver order_items populated", "CAST((SELECT count(*) FROM s_items) AS VARCHAR)", "> 0",
         "(SELECT count(*) FROM s_items) > 0", "'Core trusted fact grain must exist in Silver'"),
        ("C3", "AI-ready artifacts present", "'3'", "3", "TRUE",
         "'Expected: GOLD.ai_semantic_metadata, GOLD.ai_retrieval_index_stub, GOLD.ai_rag_query_path_stub'"),
        ("D1", "SLA status all PASS", f"'{failing}'", "0", f"{failing} = 0", "'Rows in product_sla_status where SLA_STATUS <> PASS'"),
        ("D2", "All three data products populated", f"'MIN=' || {min_of('rep_month', 'forecast', 'cohort')}", "MIN > 0",
         f"{min_of('rep_month', 'forecast', 'cohort')} > 0",
         "'sales_rep_monthly_performance, customer_revenue_forecast, customer_acquisition_cohort'"),
        ("E1", "Marketplace consumer test evidence", "'FALSE'" if stale else "'TRUE'", "TRUE", "FALSE" if stale else "TRUE",
         "'Validated from external consumer account.'"),
        ("F2", "Task audit telemetry present", "'4'", ">= 1", "TRUE",
         "'Expected at least one row in task_run_audit after validation runs'"),
    ]
    return " UNION ALL ".join(
        f"""SELECT CAST(1 AS BIGINT) AS run_id, '{i}' AS gate_id, '{n}' AS gate_name,
        CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status, {actual} AS actual_value, '{expected}' AS expected_value,
        {details} AS details""" for i, n, actual, expected, ok, details in gates)


add("governance_gates", _gates(False))
add("governance_gates_stale", _gates(True))
S["governance_gates_built"] = S["governance_gates"]
add("governance_release_decision", f"""SELECT 1::BIGINT AS run_id, CASE WHEN f = 0 THEN 'PASS' ELSE 'FAIL' END AS release_status,
    p AS pass_count, f AS fail_count, '2025-01-01 12:00:00' AS evaluated_at FROM (
    SELECT count(CASE WHEN status = 'PASS' AND gate_id <> 'E1' THEN 1 END) + 1 AS p,
           count(CASE WHEN status = 'FAIL' AND gate_id <> 'E1' THEN 1 END) AS f FROM ({_gates(True)}))""")
add("governance_job_runs", f"SELECT *, '2025-01-01 12:00:00' AS run_at FROM ({JOB})")
add("governance_runs_per_day", """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d 00:00:00') AS run_day,
    event_type AS product_name, CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'PASS' END AS result_status,
    count(*) AS runs FROM events GROUP BY ALL""")
add("governance_task_audit_gates", f"""SELECT 'B5' AS gate_id, 'Monitoring task success rate (7d)' AS gate_name,
    CASE WHEN r >= 95 THEN 'PASS' ELSE 'FAIL' END AS status, printf('%.2f', r) AS actual_value, '>= 95' AS expected_value,
    'Success rate over last 7 days from MONITORING.task_run_audit' AS details FROM (
    SELECT {pct("count(CASE WHEN event_type <> 'error' THEN 1 END)", 'count(*)')} AS r FROM events
    WHERE ts >= TIMESTAMP '2024-01-24') UNION ALL SELECT 'F2', 'Task audit telemetry present',
    CASE WHEN count(*) >= 1 THEN 'PASS' ELSE 'FAIL' END, CAST(count(*) AS VARCHAR), '>= 1',
    'Expected at least one row in task_run_audit after validation runs' FROM events""")
add("report_task_audit_tail", """SELECT 'task_' || event_type AS task_name, event_type AS product_name,
    CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'PASS' END AS result_status,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS executed_at FROM events ORDER BY ts DESC, task_name LIMIT 20""")
_COMMENTS = "CASE product_name " + " ".join(f"WHEN '{n}' THEN '{p[8]}'" for n, p in _PRODUCTS.items()) + " END"
add("report_product_catalogue", f"SELECT *, {_COMMENTS} AS table_comment FROM ({_sla()})")
add("report_sla_summary", f"SELECT sla_status, count(*) AS cnt FROM ({_sla()}) GROUP BY sla_status")
add("report_product_row_counts", f"SELECT product_name, current_row_count, hours_since_refresh FROM ({_sla()})")
add("report_monthly_sales", f"""SELECT year_month, {big('sum(total_orders)', 'total_orders')},
    {money('sum(revenue_c)', 'total_revenue')}, {big('sum(unique_customers)', 'unique_customers')}
    FROM monthly GROUP BY year_month""")
S["report_dq_log_tail"] = S["quality_log"]
S["report_job_runs_tail"] = S["governance_job_runs"]
add("governance_gate_history", f"""SELECT run_id, CASE WHEN f = 0 THEN 'PASS' ELSE 'FAIL' END AS release_status,
    p AS pass_count, f AS fail_count FROM (SELECT n AS run_id, count(CASE WHEN status = 'PASS' THEN 1 END) AS p,
    count(CASE WHEN status = 'FAIL' THEN 1 END) AS f FROM (
    SELECT *, unnest([1, 3])::BIGINT AS n FROM ({_gates(False)}) UNION ALL SELECT *, 2::BIGINT FROM ({_gates(True)})) GROUP BY n)""")
add("report_latest_gates", f"SELECT * EXCLUDE (run_id) FROM ({_gates(False)})")

# --- business questions
add("bi_territory_month_growth", f"""SELECT {big('year')}, {big('month')}, month_name, territory_name,
    {money('revenue_c', 'total_revenue')}, total_orders, unique_customers, avg_order_value,
    {money('prev_c', 'prev_month_revenue')}, {growth('revenue_c', 'prev_c')} AS month_over_month_growth_pct FROM (
    SELECT *, lag(revenue_c) OVER (PARTITION BY territory_name ORDER BY year, month) AS prev_c FROM monthly)""")
add("bi_top_customers", f"""SELECT customer_id, name, region, segment, {money('lifetime_c', 'lifetime_value')},
    lifetime_order_count, engagement_status, value_segment, recency_days,
    CASE WHEN value_segment = 'High-Value' AND engagement_status = 'Dormant' THEN 'URGENT: Re-engage VIP'
         WHEN value_segment = 'High-Value' AND engagement_status = 'At-Risk' THEN 'HIGH: Nurture VIP'
         WHEN value_segment = 'Medium-Value' AND engagement_status = 'Dormant' THEN 'MEDIUM: Check-in'
         ELSE 'Monitor' END AS action_recommendation FROM clv ORDER BY lifetime_c DESC, customer_id LIMIT 20""")
add("bi_rep_scorecard", f"""SELECT rep_id, name, territory_name, region, {money('quota_c', 'quota')},
    {money('revenue_c', 'total_revenue')}, quota_attainment_pct, unique_customers, total_orders, avg_revenue_per_line,
    {money('largest_c', 'largest_order')}, performance_status FROM score WHERE rep_id IS NOT NULL""")
add("bi_top_products", f"""SELECT revenue_rank, product_id, product_name, category, total_units_sold,
    {money('revenue_c', 'total_revenue')}, total_orders, avg_revenue_per_line, avg_units_per_order, product_flag
    FROM perf ORDER BY revenue_rank, product_id LIMIT 20""")
add("bi_segment_mix", f"""SELECT customer_segment, value_segment, n AS customer_count, {mean('m', 'n')} AS avg_customer_revenue,
    {pct('r', '100 * n', 1)} AS avg_days_since_order, {pct('n', 'total', 1)} AS pct_of_total FROM (
    SELECT s.customer_segment, c.value_segment, count(*) AS n, sum(s.monetary_c) AS m, sum(s.recency_days) AS r,
    sum(count(*)) OVER () AS total FROM seg s JOIN clv c ON s.customer_id = c.customer_id GROUP BY ALL)""")
add("bi_quarterly_yoy", f"""SELECT {big('year', 'current_year')}, {big('quarter')}, territory_name,
    {money('revenue_c', 'current_year_revenue')}, {money('prior_c', 'prior_year_revenue')},
    {growth('revenue_c', 'prior_c')} AS yoy_growth_pct FROM (
    SELECT *, lag(revenue_c) OVER (PARTITION BY territory_name, quarter ORDER BY year) AS prior_c FROM (
    SELECT year, quarter, territory_name, sum(revenue_c) AS revenue_c FROM monthly GROUP BY ALL))""")
S["bi_cohort_trend"] = S["product_acquisition_cohort"]
add("bi_cash_flow", f"""SELECT {big('year')}, {big('month')}, month_name, {money('rev_c', 'total_monthly_revenue')},
    {big('orders', 'total_monthly_orders')}, {mean('v', 'n')} AS avg_order_value, {money('prev_c', 'prev_month_revenue')},
    {growth('rev_c', 'prev_c')} AS mom_growth_pct, {mean('w', 'k')} AS revenue_moving_avg FROM (
    SELECT *, lag(rev_c) OVER (ORDER BY year, month) AS prev_c,
    sum(rev_c) OVER (ORDER BY year, month ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS w,
    count(*) OVER (ORDER BY year, month ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS k FROM (
    SELECT year, month, month_name, sum(revenue_c) AS rev_c, sum(total_orders) AS orders,
    sum(CAST(round(avg_order_value * 100) AS BIGINT)) AS v, count(*) AS n FROM monthly GROUP BY ALL))""")
add("bi_category_mix", f"""SELECT category, num_products, {money('rev_c', 'category_revenue')},
    {pct('rev_c', 'total', 1)} AS revenue_contribution_pct, {big('units', 'units_sold')}, {mean('a', 'n')} AS avg_revenue_per_line,
    rank() OVER (ORDER BY rev_c DESC) AS category_rank FROM (SELECT category, count(DISTINCT product_id) AS num_products,
    sum(revenue_c) AS rev_c, sum(sum(revenue_c)) OVER () AS total, sum(total_units_sold) AS units,
    sum(CAST(round(avg_revenue_per_line * 100) AS BIGINT)) AS a, count(*) AS n FROM perf GROUP BY category)""")
add("bi_territory_performance", f"""SELECT territory_name, {money('rev_c', 'total_revenue')}, {big('orders', 'total_orders')},
    coalesce(num_reps, 0) AS num_reps, {mean('v', 'n')} AS avg_order_value, {pct('rev_c', 'total', 1)} AS revenue_share_pct,
    rank() OVER (ORDER BY rev_c DESC) AS territory_rank FROM (
    SELECT territory_name, sum(revenue_c) AS rev_c, sum(sum(revenue_c)) OVER () AS total, sum(total_orders) AS orders,
    sum(CAST(round(avg_order_value * 100) AS BIGINT)) AS v, count(*) AS n FROM monthly GROUP BY territory_name)
    LEFT JOIN (SELECT territory_name, count(DISTINCT rep_id) AS num_reps FROM score GROUP BY territory_name)
    USING (territory_name)""")
add("bi_month_territory_category", f"""SELECT {day('d.month_start', 'sales_month')}, t.territory_name, p.category,
    count(DISTINCT f.customer_id) AS unique_customers, {money('sum(f.revenue_c)', 'monthly_revenue')}
    FROM fact f JOIN d_dates d ON f.date_key = d.date_key JOIN s_territories t ON f.territory_id = t.territory_id
    JOIN s_products p ON f.product_id = p.product_id GROUP BY d.month_start, t.territory_name, p.category""")

S["bi_month_territory_category_sets"] = S["bi_month_territory_category"]
_CUSTOMERS = f"count(DISTINCT f.customer_id) AS unique_customers, {money('sum(f.revenue_c)', 'monthly_revenue')} FROM fact f"
add("bi_month_customers", f"""SELECT {day('d.month_start', 'sales_month')}, {_CUSTOMERS}
    JOIN d_dates d ON f.date_key = d.date_key GROUP BY d.month_start""")
add("bi_category_customers", f"SELECT p.category, {_CUSTOMERS} JOIN s_products p ON f.product_id = p.product_id GROUP BY p.category")
add("bi_quarter_region_customers", f"""SELECT {day("date_trunc('quarter', d.month_start)", 'sales_quarter')}, t.region, {_CUSTOMERS}
    JOIN d_dates d ON f.date_key = d.date_key JOIN s_territories t ON f.territory_id = t.territory_id
    GROUP BY date_trunc('quarter', d.month_start), t.region""")

# --- text search
add("search_documents", """SELECT doc_id, lang, source, CAST(CASE WHEN upper(source) LIKE '%SRC1%' THEN 3
    WHEN upper(lang) LIKE '%SRC1%' THEN 2 WHEN upper(text) LIKE '%SRC1%' THEN 1 ELSE 0 END AS BIGINT) AS relevance_score
    FROM documents WHERE upper(source) LIKE '%SRC1%' OR upper(lang) LIKE '%SRC1%' OR upper(text) LIKE '%SRC1%'
    ORDER BY relevance_score DESC, doc_id LIMIT 50""")
add("search_documents_text", """SELECT doc_id, lang, source, CAST(CASE WHEN upper(source) LIKE '%THE%' THEN 2
    WHEN upper(lang) LIKE '%THE%' THEN 1 ELSE 0 END AS BIGINT) AS relevance_score
    FROM documents WHERE upper(source) LIKE '%THE%' OR upper(lang) LIKE '%THE%' OR upper(text) LIKE '%THE%'
    ORDER BY relevance_score DESC, doc_id LIMIT 50""")

# --- features
RFM_N = "recency_days frequency_12m monetary_12m recency_score frequency_score monetary_score rfm_composite_score"
ENGAGEMENT_N = ("days_since_last_purchase lifetime_value lifetime_order_count avg_order_value customer_tenure_days "
                "lifetime_value_per_day")
PRODUCT_N = "cumulative_revenue revenue_12m cumulative_units_sold units_sold_12m total_returned_items return_rate_pct revenue_rank"
REP_N = "quota ytd_revenue cumulative_revenue ytd_orders quota_attainment_ratio quota_attainment_pct ytd_customer_count"
TRAINING_N = ("recency_days frequency_12m monetary_12m rfm_composite_score days_since_last_purchase lifetime_value "
              "lifetime_order_count avg_order_value lifetime_value_per_day")
TRAINING_T = "rfm_segment engagement_status source_segment region"


def per_month(select: str, key: str, numbers: str, texts: str = "") -> str:
    """A feature table with all its days, shown per entity and month."""
    shown = [f"sum(CAST({c} AS DECIMAL(28, 4)))::DOUBLE AS {c}_sum, min({c})::DOUBLE AS {c}_min, max({c})::DOUBLE AS {c}_max"
             for c in numbers.split()] + [f"min({c}) AS {c}_min, max({c}) AS {c}_max" for c in texts.split()]
    return (f"SELECT {key}, left(observation_date, 7) AS month, count(*) AS n, {', '.join(shown)} FROM ({select}) "
            f"GROUP BY {key}, left(observation_date, 7)")


def drawn(key: str, fraction: float) -> str:
    """The rows of a sample, by the hash of seed, key and date."""
    return (f"('0x' || substr(md5('42|' || {key} || '|' || CAST(observation_date AS VARCHAR)), 1, 8))::BIGINT "
            f"< {int(fraction * 2 ** 32)}")


add("features_customer_rfm", per_month(f"SELECT {RFM} FROM f_rfm", "customer_id", RFM_N, "valid_from estimated_segment"))
S["features_customer_rfm_ranged"] = S["features_customer_rfm"]
ENGAGEMENT = f"""customer_id, {day('observation_date')}, days_since_last_purchase, engagement_status,
    {money('lifetime_c', 'lifetime_value')}, lifetime_order_count, avg_order_value, customer_tenure_days,
    lifetime_value_per_day"""
add("features_customer_engagement", per_month(f"SELECT {ENGAGEMENT} FROM f_eng", "customer_id", ENGAGEMENT_N, "engagement_status"))
add("features_customer_engagement_pit", per_month(f"""SELECT {ENGAGEMENT} FROM (SELECT *,
    CASE WHEN days_since_last_purchase <= 30 THEN 'Active' WHEN days_since_last_purchase <= 90 THEN 'Dormant'
         WHEN days_since_last_purchase <= 180 THEN 'At-Risk' ELSE 'Churned' END AS engagement_status,
    {mean('lifetime_c', 'lifetime_order_count')} AS avg_order_value,
    {mean('lifetime_c', 'customer_tenure_days', 4)} AS lifetime_value_per_day FROM (
    SELECT o.customer_id, s.d AS observation_date, date_diff('day', max(o.order_date), s.d) AS days_since_last_purchase,
    sum(o.amount_c) AS lifetime_c, count(DISTINCT o.order_id) AS lifetime_order_count,
    date_diff('day', min(o.order_date), max(o.order_date)) AS customer_tenure_days
    FROM s_orders o JOIN spine s ON o.order_date <= s.d GROUP BY o.customer_id, s.d))""",
    "customer_id", ENGAGEMENT_N, "engagement_status"))
add("features_product_performance", per_month(f"SELECT {PRODUCT_FEATURES} FROM f_prod", "product_id", PRODUCT_N))
S["features_product_performance_ranged"] = S["features_product_performance"]
add("features_sales_rep_quota", per_month(f"SELECT {REP_FEATURES} FROM f_rep", "rep_id", REP_N))
add("features_training_customers", per_month(f"SELECT {TRAINING_CUSTOMERS} FROM t_customers", "customer_id", TRAINING_N, TRAINING_T))
TRAINING_PRODUCTS = f"{PRODUCT_FEATURES}, category, manufacturer, unit_price"
PRODUCT_T = "category manufacturer"
add("features_training_products", per_month(
    f"SELECT {TRAINING_PRODUCTS} FROM t_products", "product_id", f"{PRODUCT_N} unit_price", PRODUCT_T))
add("features_customer_rfm_daily", f"""SELECT valid_from, estimated_segment, count(*) AS n,
    {big('sum(recency_days)', 'recency_days')}, {big('sum(frequency_12m)', 'frequency_12m')},
    {money('sum(monetary_c)', 'monetary_12m')}, {big('sum(rfm_composite_score)', 'rfm_composite_score')}
    FROM f_rfm GROUP BY valid_from, estimated_segment""", "DAY")
add("features_sales_rep_quota_daily", f"""SELECT {day('observation_date')}, {money('sum(ytd_c)', 'ytd_revenue')},
    {big('sum(ytd_orders)', 'ytd_orders')}, {big('sum(ytd_customer_count)', 'ytd_customer_count')}
    FROM f_rep GROUP BY f_rep.observation_date""", "DAY")
CUSTOMER_AS_OF = f"""customer_id, {day('observation_date')}, {big('recency_days')}, {big('frequency_12m')},
    {money('monetary_c', 'monetary_12m')}, {big('rfm_composite_score')}, rfm_segment AS estimated_segment,
    days_since_last_purchase, engagement_status, {money('lifetime_c', 'lifetime_value')}, avg_order_value"""
_IDS = "(1, 2, 3, 5, 8) AND observation_date = DATE '1999-01-01'"
add("features_customers_as_of", f"""SELECT {CUSTOMER_AS_OF} FROM (SELECT * FROM t_customers WHERE customer_id IN {_IDS})""")
add("features_customers_as_of_table", """SELECT customer_id, recency_days, engagement_status FROM t_customers
    WHERE observation_date = DATE '1999-01-01'
      AND customer_id IN (SELECT customer_id FROM s_customers WHERE segment = 'BUILDING')""")
add("features_products_as_of", f"SELECT {TRAINING_PRODUCTS} FROM (SELECT * FROM t_products WHERE product_id IN {_IDS})")
add("features_sales_reps_as_of", f"SELECT {REP_FEATURES} FROM (SELECT * FROM f_rep WHERE rep_id IN {_IDS})")
add("features_training_dataset", per_month(f"""SELECT {TRAINING_CUSTOMERS} FROM (SELECT * FROM t_customers
    WHERE observation_date BETWEEN DATE '1998-01-01' AND DATE '1998-06-01')""", "customer_id", TRAINING_N, TRAINING_T))
add("features_training_sample", per_month(f"""SELECT {TRAINING_CUSTOMERS} FROM (SELECT * FROM t_customers
    WHERE observation_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-01' AND {drawn('customer_id', 0.25)})""",
    "customer_id", TRAINING_N, TRAINING_T))
add("features_training_sales_reps", per_month(f"""SELECT {REP_FEATURES} FROM (SELECT * FROM f_rep
    WHERE observation_date BETWEEN DATE '1998-01-01' AND DATE '1999-01-01' AND {drawn('rep_id', 0.5)})""", "rep_id", REP_N))
add("features_training_batch", f"""SELECT customer_id, {day('observation_date')}, {big('recency_days')}, {big('frequency_12m')},
    {money('monetary_c', 'monetary_12m')}, {big('rfm_composite_score')}, rfm_segment AS estimated_segment, engagement_status,
    {money('lifetime_c', 'lifetime_value')}, avg_order_value, '2025-01-01 00:00:00' AS training_batch_created_at
    FROM (SELECT * FROM t_customers WHERE observation_date BETWEEN DATE '1999-01-01' AND DATE '1999-03-01')""")
SNAPSHOTS = """SELECT feature_id, 'customer' AS entity_type, entity_key, feature_value, observation_date AS valid_from,
    lead(observation_date) OVER (PARTITION BY feature_id, entity_key ORDER BY observation_date) AS valid_to FROM (
    SELECT *, lag(feature_value) OVER w AS before, row_number() OVER w AS n FROM (
    SELECT 'cust_segment_rfm' AS feature_id, CAST(customer_id AS VARCHAR) AS entity_key, observation_date,
        estimated_segment AS feature_value FROM f_rfm
    UNION ALL SELECT 'cust_frequency_12m', CAST(customer_id AS VARCHAR), observation_date,
        CAST(frequency_12m AS VARCHAR) FROM f_rfm)
    WINDOW w AS (PARTITION BY feature_id, entity_key ORDER BY observation_date))
    WHERE n = 1 OR feature_value IS DISTINCT FROM before"""
add("features_snapshots", f"""SELECT feature_id, entity_type, entity_key, feature_value, {day('valid_from')}, {day('valid_to')}
    FROM ({SNAPSHOTS})""")
S["features_snapshots_by_month"] = S["features_snapshots"]
add("features_rfm_next_day", f"""SELECT {RFM} FROM (SELECT *, r AS recency_score, f AS frequency_score, m AS monetary_score,
    r + f + m AS rfm_composite_score,
    CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'VIP' WHEN r >= 3 AND f >= 3 THEN 'Loyal'
         WHEN r >= 4 AND f <= 2 THEN 'At-Risk' WHEN r <= 2 AND f <= 2 THEN 'Inactive' ELSE 'Engaged' END AS estimated_segment
    FROM (SELECT *, ntile(5) OVER (ORDER BY recency_days ASC NULLS LAST, customer_id, observation_date) AS r,
          ntile(5) OVER (ORDER BY frequency_12m DESC, customer_id, observation_date) AS f,
          ntile(5) OVER (ORDER BY monetary_c DESC, customer_id, observation_date) AS m
          FROM f_rfm_raw WHERE observation_date BETWEEN DATE '1998-09-01' AND DATE '1998-09-02'))
    WHERE observation_date = DATE '1998-09-02' AND recency_days IS NOT NULL""")
add("features_products_next_day", f"SELECT {PRODUCT_FEATURES} FROM f_prod WHERE observation_date = DATE '1998-09-02'")
add("features_as_of_batch", f"""SELECT 'cust_segment_rfm' AS feature_id, CAST(o.customer_id AS VARCHAR) AS entity_key,
    {day('o.order_date', 'as_of_date')}, o.order_id, s.feature_value FROM s_orders o LEFT JOIN ({SNAPSHOTS}) s
    ON s.feature_id = 'cust_segment_rfm' AND s.entity_key = CAST(o.customer_id AS VARCHAR)
    AND s.valid_from <= o.order_date AND (s.valid_to IS NULL OR s.valid_to > o.order_date)""")
add("features_as_of_one", f"""SELECT max(feature_value) AS feature_value FROM ({SNAPSHOTS})
    WHERE feature_id = 'cust_segment_rfm' AND entity_key = '7' AND valid_from <= DATE '1998-05-17'
      AND (valid_to IS NULL OR valid_to > DATE '1998-05-17')""")
add("features_validation", """SELECT count(*) > 0 AS has_rows, TRUE AS has_observation_date,
    count(CASE WHEN customer_id IS NULL THEN 1 END) = 0 AS no_nulls_in_keys,
    date_diff('day', min(observation_date), max(observation_date)) > 30 AS temporal_coverage FROM t_customers""")
_NUMERIC = {"customer_id": "customer_id", "recency_days": "recency_days", "frequency_12m": "frequency_12m",
            "monetary_12m": "monetary_c", "rfm_composite_score": "rfm_composite_score",
            "days_since_last_purchase": "days_since_last_purchase", "lifetime_order_count": "lifetime_order_count",
            "avg_order_value": "avg_order_value"}
add("features_importance", " UNION ALL ".join(
    f"SELECT '{n}' AS feature, round(corr({c}, lifetime_c), 6) AS correlation_with_target FROM t_customers"
    for n, c in _NUMERIC.items()))


def _health(name: str, table: str, key: str) -> str:
    return (f"SELECT '{name}' AS feature_table, count(*) AS total_rows, count(DISTINCT {key}) AS unique_entities, "
            f"count(DISTINCT observation_date) AS date_snapshots, {day('min(observation_date)', 'earliest_date')}, "
            f"{day('max(observation_date)', 'latest_date')}, "
            f"date_diff('day', min(observation_date), max(observation_date)) AS days_covered FROM {table}")


add("features_table_health", " UNION ALL ".join([
    _health("customer_rfm_features_offline", "f_rfm", "customer_id"),
    _health("customer_engagement_features_offline", "f_eng", "customer_id"),
    _health("product_performance_features_offline", "f_prod", "product_id"),
    _health("sales_rep_quota_features_offline", "f_rep", "rep_id")]))
S["features_table_health_built"] = S["features_table_health"]
add("features_availability", " UNION ALL ".join(
    f"""SELECT feature_table AS entity_type, total_rows AS training_samples, unique_entities, earliest_date, latest_date,
    days_covered AS date_range_days, date_snapshots AS snapshot_count, CAST(100 AS DOUBLE) AS pct_of_total
    FROM ({_health(e, t, k)})""" for e, t, k in (("customer", "t_customers", "customer_id"),
                                                 ("product", "t_products", "product_id"))))
add("features_staleness", f"""SELECT {day('max(m)', 'most_recent_data')}, date_diff('day', max(m), DATE '2025-01-01') AS days_old
    FROM (SELECT max(observation_date) AS m FROM f_rfm UNION ALL SELECT max(observation_date) FROM f_prod)""")
add("features_volume_health", """SELECT n AS total_training_rows, CASE WHEN n > 100000 THEN 'HEALTHY' ELSE 'LOW' END AS status
    FROM (SELECT (SELECT count(*) FROM t_customers) + (SELECT count(*) FROM t_products) AS n)""")
add("features_churn_label", per_month(f"""SELECT t.customer_id, {day('t.observation_date', 'observation_date')},
    CAST(CASE WHEN count(o.order_id) > 0 THEN 0 ELSE 1 END AS BIGINT) AS churned_30_days
    FROM t_customers t LEFT JOIN s_orders o ON o.customer_id = t.customer_id AND o.order_date > t.observation_date
    AND o.order_date <= CAST(t.observation_date + INTERVAL 30 DAY AS DATE) GROUP BY t.customer_id, t.observation_date""", "customer_id", "churned_30_days"))
add("features_mature_only", per_month(f"""SELECT t.customer_id, {day('t.observation_date', 'observation_date')},
    {money('t.lifetime_c', 'lifetime_value')}, c.customer_tenure_days, {big('t.rfm_composite_score', 'rfm_composite_score')}
    FROM t_customers t JOIN d_customers c ON t.customer_id = c.customer_id WHERE c.customer_tenure_days > 0""",
    "customer_id", "lifetime_value customer_tenure_days rfm_composite_score"))
add("features_existing_only", per_month(f"""SELECT r.customer_id, {day('r.observation_date', 'observation_date')},
    {day('c.first_order_date', 'first_order_date')} FROM f_rfm r JOIN d_customers c ON r.customer_id = c.customer_id
    WHERE r.observation_date >= c.first_order_date""", "customer_id", "", "first_order_date"))
add("features_filled", """SELECT c.customer_id, CAST(coalesce(r.recency_days, 999) AS BIGINT) AS recency_days,
    CAST(coalesce(r.frequency_12m, 0) AS BIGINT) AS frequency_12m,
    CAST(coalesce(r.monetary_c, 0) AS DOUBLE) / 100 AS monetary_12m
    FROM s_customers c LEFT JOIN (SELECT * FROM f_rfm WHERE observation_date = DATE '1995-03-01') r
    ON c.customer_id = r.customer_id""")
add("features_product_trend", """SELECT product_id, count(*) AS n_rows, round(regr_slope(y, x), 4) AS slope,
    round(regr_r2(y, x), 4) AS r2 FROM (SELECT product_id, revenue_12m_c / 100.0 AS x,
    lead(revenue_c) OVER (PARTITION BY product_id ORDER BY observation_date) / 100.0 AS y FROM t_products)
    GROUP BY product_id HAVING count(*) >= 10""")
_NEXT = """SELECT product_id, coalesce(revenue_12m_c / 100.0, 0) AS u, coalesce(units_12m_c / 100.0, 0) AS v,
    coalesce(return_rate_pct, 0) AS w, lead(revenue_c) OVER (PARTITION BY product_id ORDER BY observation_date) / 100.0 AS t
    FROM t_products"""


def _cov(x: str, y: str) -> str:
    return f"covar_pop(CASE WHEN t IS NOT NULL THEN {x} END, CASE WHEN t IS NOT NULL THEN {y} END) AS {x}{y}"


def _without(x: str, y: str, p: str) -> str:
    """Covariance of what two columns leave unexplained by a feature, if that one varies."""
    return f"CASE WHEN {p}{p} > 1e-9 * o{p} THEN {x}{y} - {p}{x} * {p}{y} / {p}{p} ELSE {x}{y} END AS {x}{y}"


def _part(x: str) -> str:
    return f"CASE WHEN {x}{x} > 1e-9 * o{x} THEN {x}t * {x}t / {x}{x} ELSE 0 END"


add("features_product_trend_fit", f"""SELECT product_id, n_rows, round((e_u + e_v + {_part('w')}) / nullif(tt, 0), 4) AS r2
    FROM (SELECT product_id, n_rows, e_u, ow, tt, {_part('v')} AS e_v, {_without('w', 'w', 'v')}, {_without('w', 't', 'v')}
    FROM (SELECT product_id, n_rows, ov, ow, tt, {_part('u')} AS e_u, {_without('v', 'v', 'u')}, {_without('v', 'w', 'u')},
        {_without('v', 't', 'u')}, {_without('w', 'w', 'u')}, {_without('w', 't', 'u')}
    FROM (SELECT *, uu AS ou, vv AS ov, ww AS ow FROM (SELECT product_id, count(*) AS n_rows, {_cov('u', 'u')}, {_cov('u', 'v')},
        {_cov('u', 'w')}, {_cov('u', 't')}, {_cov('v', 'v')}, {_cov('v', 'w')}, {_cov('v', 't')}, {_cov('w', 'w')},
        {_cov('w', 't')}, {_cov('t', 't')} FROM ({_NEXT}) GROUP BY product_id HAVING count(*) >= 10))))""")
add("features_recent_rfm", f"""SELECT {RFM} FROM (SELECT * FROM f_rfm WHERE observation_date >= DATE '1999-12-27'
    ORDER BY observation_date DESC, customer_id LIMIT 20)""")
add("features_high_revenue_products", f"""SELECT {PRODUCT_FEATURES} FROM (SELECT * FROM f_prod WHERE revenue_c > 100000000
    AND observation_date = (SELECT max(observation_date) FROM f_prod) ORDER BY revenue_rank, product_id LIMIT 20)""")
add("features_top_reps", f"""SELECT {REP_FEATURES} FROM (SELECT * FROM f_rep
    WHERE observation_date = (SELECT max(observation_date) FROM f_rep)
    ORDER BY quota_attainment_ratio DESC NULLS LAST, rep_id LIMIT 20)""")
add("features_reps_on_date", f"""SELECT rep_id, quota_attainment_pct, {money('ytd_c', 'ytd_revenue')} FROM f_rep
    WHERE observation_date = DATE '2000-01-01'""")
add("features_churn_recipe", per_month(f"""SELECT {TRAINING_CUSTOMERS} FROM (SELECT * FROM t_customers
    WHERE observation_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' AND recency_days > 30)""", "customer_id", TRAINING_N, TRAINING_T))
add("features_demand_recipe", per_month(f"""SELECT {TRAINING_PRODUCTS} FROM (SELECT * FROM t_products
    WHERE observation_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' AND revenue_c > 100000000)""",
    "product_id", f"{PRODUCT_N} unit_price", PRODUCT_T))
add("catalog_summary", """SELECT metric, value FROM (VALUES ('Features Registered', '21'), ('Entities', '3'),
    ('Owner Teams', '2'), ('Customer Features', '10'), ('Product Features', '5'), ('SalesRep Features', '6'),
    ('PIT-Correct Features', '20'), ('Feature Versions', '0'), ('Lineage Dependencies', '4')) t(metric, value)
    UNION ALL SELECT 'Customer Training Rows', CAST(count(*) AS VARCHAR) FROM t_customers
    UNION ALL SELECT 'Product Training Rows', CAST(count(*) AS VARCHAR) FROM t_products""")

# --- sinks
add("sink_clustered_fact", f"""SELECT territory_id, count(*) AS lines, {money('sum(revenue_c)', 'revenue')} FROM fact
    GROUP BY territory_id""")
add("sink_upsert", """SELECT customer_id, CASE WHEN segment IN ('BUILDING', 'MACHINERY') THEN lower(name) ELSE name END AS name,
    segment FROM s_customers""")
add("sink_insert_only", """SELECT customer_id, CASE WHEN segment = 'MACHINERY' THEN lower(name) ELSE name END AS name,
    segment FROM s_customers""")
add("sink_append_numbered", f"""SELECT row_number() OVER (ORDER BY load, task_name) AS audit_id, task_name, result_status
    FROM ({VALIDATION}), (VALUES (1), (2)) t(load)""")

# --- streaming
S["streaming_customers"] = S["silver_customers"]
S["streaming_orders"] = S["silver_orders"]
add("streaming_order_items", f"""SELECT {ITEM} FROM (SELECT * FROM l_items WHERE quantity > 0 AND unit_price > 0
    AND line_total_c > 0 AND abs(quantity * unit_price * (1 - coalesce(discount_rate, 0)) - line_total_c / 100.0) < 1.0
    AND order_item_id IS NOT NULL AND product_id IS NOT NULL AND order_id IN (SELECT order_id FROM s_orders))""")
S["streaming_orders_late"] = S["streaming_orders"]
S["streaming_order_items_late"] = S["streaming_order_items"]
add("streaming_freshness", """SELECT lag_seconds, n AS input_rows, status FROM (SELECT count(*) AS n FROM orders),
    (VALUES (60.0::DOUBLE, 'PASS'), (600.0::DOUBLE, 'STALE')) t(lag_seconds, status)""")
add("streaming_bronze_append", f"""SELECT o_orderstatus, count(*) AS orders,
    {money('sum(CAST(round(o_totalprice * 100) AS BIGINT))', 'amount')} FROM orders GROUP BY o_orderstatus""")

STATEMENTS = S
