"""DuckDB SQL of the queries in ``extended``: the plain definition of each, over
whole windows, inequality joins and recomputation, which Spark's side avoids."""

from __future__ import annotations

from .operators.resampling import poisson_thresholds
from .sources.roles import with_roles


def _money(expr: str) -> str:
    return f"ROUND(CAST({expr} AS DOUBLE), 2)"


_WEIGHT = " + ".join(f"CASE WHEN h >= {t} THEN 1 ELSE 0 END" for t in poisson_thresholds())

SQL: dict[str, str] = {
    "purchase_last_visit": with_roles("""
SELECT p.event_id, p.customer_id, p.event_ts, v.event_id AS visit_id, v.event_ts AS visit_ts
FROM r_events p LEFT JOIN r_events v
  ON v.customer_id = p.customer_id AND v.event_type = 'visit' AND v.event_ts <= p.event_ts
 AND v.event_ts >= p.event_ts - INTERVAL 12 HOUR
WHERE p.event_type = 'purchase'
QUALIFY ROW_NUMBER() OVER (PARTITION BY p.event_id ORDER BY v.event_ts DESC NULLS LAST, v.event_id DESC) = 1""", "r_events"),

    "order_last_finished": with_roles("""
SELECT o.order_id, o.customer_id, o.order_ts, f.event_id AS finished_id, f.event_ts AS finished_ts
FROM r_orders o LEFT JOIN r_order_events f
  ON f.customer_id = o.customer_id AND f.event_type = 'visit'
 AND f.event_ts BETWEEN o.order_ts - INTERVAL 90 DAY AND o.order_ts
QUALIFY ROW_NUMBER() OVER (PARTITION BY o.order_id ORDER BY f.event_ts DESC NULLS LAST, f.event_id DESC) = 1""",
                                      "r_orders", "r_order_events"),

    "purchase_touches": with_roles("""
SELECT p.event_id, COUNT(*) FILTER (WHERE x.event_type = 'click') AS clicks, COUNT(*) FILTER (WHERE x.event_type = 'error') AS errors
FROM r_events p JOIN r_events x ON x.customer_id = p.customer_id AND x.event_type IN ('click', 'error')
 AND x.event_ts >= p.event_ts - INTERVAL 6 HOUR AND x.event_ts <= p.event_ts + INTERVAL 1 HOUR
WHERE p.event_type = 'purchase' GROUP BY p.event_id""", "r_events"),

    # every start, the first signup after it, the first purchase after that
    "ordered_funnel_levels": with_roles("""
, people AS (
    SELECT DISTINCT customer_id FROM r_events
    WHERE customer_id IS NOT NULL AND event_ts IS NOT NULL AND event_type IN ('visit', 'signup', 'purchase')
), runs AS (
    SELECT a.customer_id, a.event_ts AS started, MIN(b.event_ts) AS second
    FROM r_events a LEFT JOIN r_events b ON b.customer_id = a.customer_id AND b.event_type = 'signup'
     AND b.event_ts >= a.event_ts AND b.event_ts <= a.event_ts + INTERVAL 12 HOUR
    WHERE a.event_type = 'visit' GROUP BY ALL
), levels AS (
    SELECT r.customer_id, CASE WHEN COUNT(c.event_id) > 0 THEN 3 WHEN COUNT(r.second) > 0 THEN 2 ELSE 1 END AS level
    FROM runs r LEFT JOIN r_events c ON c.customer_id = r.customer_id AND c.event_type = 'purchase'
     AND c.event_ts >= r.second AND c.event_ts <= r.started + INTERVAL 12 HOUR
    GROUP BY r.customer_id
)
SELECT customer_id, CAST(COALESCE(level, 0) AS INTEGER) AS level FROM people LEFT JOIN levels USING (customer_id)""", "r_events"),

    "ordered_order_funnel": with_roles("""
, runs AS (
    SELECT a.customer_id, a.event_ts AS started, MIN(b.event_ts) AS second
    FROM r_order_events a LEFT JOIN r_order_events b ON b.customer_id = a.customer_id AND b.event_type = 'signup'
     AND b.event_ts >= a.event_ts AND b.event_ts <= a.event_ts + INTERVAL 180 DAY
    WHERE a.event_type = 'visit' AND a.customer_id IS NOT NULL AND a.event_ts IS NOT NULL GROUP BY ALL
), levels AS (
    SELECT r.customer_id, COUNT(r.second) > 0 AS two, COUNT(c.event_id) > 0 AS three
    FROM runs r LEFT JOIN r_order_events c ON c.customer_id = r.customer_id AND c.event_type = 'purchase'
     AND c.event_ts >= r.second AND c.event_ts <= r.started + INTERVAL 180 DAY
    GROUP BY r.customer_id
), n AS (SELECT COUNT(*) AS visit, COUNT_IF(two) AS signup, COUNT_IF(three) AS purchase FROM levels)
SELECT visit, signup, purchase, ROUND(signup / NULLIF(visit, 0), 6) AS visit_to_signup,
       ROUND(purchase / NULLIF(signup, 0), 6) AS signup_to_purchase, ROUND(purchase / NULLIF(visit, 0), 6) AS visit_to_purchase
FROM n""", "r_order_events"),

    "sketch_months": with_roles("""
SELECT CAST(date_trunc('month', order_ts) AS DATE) AS month, COUNT(*) AS orders, COUNT(DISTINCT customer_id) AS customers,
       TRUE AS customers_in_bound, TRUE AS p50_in_bound, TRUE AS p90_in_bound
FROM r_orders GROUP BY 1""", "r_orders"),

    "sketch_range": with_roles("""
SELECT '1997-1998' AS period, COUNT(*) AS orders, COUNT(DISTINCT customer_id) AS customers,
       TRUE AS customers_in_bound, TRUE AS p50_in_bound, TRUE AS p90_in_bound
FROM r_orders WHERE year(order_ts) BETWEEN 1997 AND 1998""", "r_orders"),

    "revenue_cube": with_roles(f"""
SELECT p.category, c.country, CAST(date_trunc('month', o.order_ts) AS DATE) AS month,
       {_money('SUM(i.qty * i.unit_price_usd)')} AS revenue, COUNT(*) AS lines,
       COUNT(DISTINCT o.customer_id) AS customers,
       CAST(GROUPING(p.category, c.country, CAST(date_trunc('month', o.order_ts) AS DATE)) AS INTEGER) AS level
FROM r_order_items i JOIN r_products p USING (product_id) JOIN r_orders o USING (order_id)
JOIN r_customers c ON c.customer_id = o.customer_id
GROUP BY CUBE (p.category, c.country, CAST(date_trunc('month', o.order_ts) AS DATE))""",
                               "r_order_items", "r_products", "r_orders", "r_customers"),

    "revenue_rollup": with_roles(f"""
SELECT c.country, CAST(date_trunc('month', o.order_ts) AS DATE) AS month,
       {_money('SUM(i.qty * i.unit_price_usd)')} AS revenue, COUNT(DISTINCT o.customer_id) AS customers,
       CAST(GROUPING(c.country, CAST(date_trunc('month', o.order_ts) AS DATE)) AS INTEGER) AS level
FROM r_order_items i JOIN r_products p USING (product_id) JOIN r_orders o USING (order_id)
JOIN r_customers c ON c.customer_id = o.customer_id
GROUP BY ROLLUP (c.country, CAST(date_trunc('month', o.order_ts) AS DATE)) HAVING COUNT(DISTINCT o.customer_id) >= 10""",
                                 "r_order_items", "r_products", "r_orders", "r_customers"),

    "trailing_revenue": with_roles(f"""
SELECT DISTINCT order_ts, {_money('SUM(revenue_usd) OVER (PARTITION BY order_ts)')} AS revenue_usd,
       {_money('SUM(revenue_usd) OVER w')} AS trailing_revenue_usd, COUNT(*) OVER w AS trailing_rows
FROM r_orders WHERE order_ts IS NOT NULL
WINDOW w AS (ORDER BY order_ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)""", "r_orders"),

    "trailing_event_count": with_roles("""
SELECT DISTINCT customer_id, event_ts, COUNT(*) OVER (PARTITION BY customer_id, event_ts) AS n,
       COUNT(*) OVER w AS trailing_n, COUNT(*) OVER w AS trailing_rows
FROM r_events WHERE event_ts IS NOT NULL
WINDOW w AS (PARTITION BY customer_id ORDER BY event_ts RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW)""", "r_events"),

    "customer_trailing_orders": with_roles(f"""
SELECT order_id, customer_id, order_ts, {_money('revenue_usd')} AS revenue_usd, COUNT(*) OVER w AS orders_90d,
       {_money('SUM(revenue_usd) OVER w')} AS revenue_90d, {_money('MAX(revenue_usd) OVER w')} AS largest_90d
FROM r_orders WHERE order_ts IS NOT NULL
WINDOW w AS (PARTITION BY customer_id ORDER BY order_ts RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW)""", "r_orders"),

    "customer_sessions": with_roles("""
, gaps AS (
    SELECT customer_id, event_ts, event_ts - LAG(event_ts) OVER (PARTITION BY customer_id ORDER BY event_ts) AS gap
    FROM r_events WHERE customer_id IS NOT NULL AND event_ts IS NOT NULL
), numbered AS (
    SELECT customer_id, event_ts, SUM(CASE WHEN gap <= INTERVAL 6 HOUR THEN 0 ELSE 1 END)
           OVER (PARTITION BY customer_id ORDER BY event_ts ROWS UNBOUNDED PRECEDING) AS session FROM gaps)
SELECT customer_id, CAST(session AS BIGINT) AS session, MIN(event_ts) AS started_ts, MAX(event_ts) AS ended_ts, COUNT(*) AS events
FROM numbered GROUP BY 1, 2""", "r_events"),

    "time_to_next_purchase": with_roles("""
SELECT event_id, customer_id, LEAD(event_ts) OVER w AS next_ts,
       ROUND((epoch_us(LEAD(event_ts) OVER w) - epoch_us(event_ts)) / 1e6, 6) AS seconds_to_next
FROM r_events WHERE event_type = 'purchase' AND customer_id IS NOT NULL AND event_ts IS NOT NULL
WINDOW w AS (PARTITION BY customer_id ORDER BY event_ts, event_id)""", "r_events"),

    "streamed_daily_revenue": with_roles(f"""
SELECT CAST(order_ts AS DATE) AS day, COUNT(*) AS orders, {_money('SUM(revenue_usd)')} AS revenue
FROM r_orders WHERE order_ts IS NOT NULL
GROUP BY 1 HAVING CAST(order_ts AS DATE) + 1 <= (SELECT MAX(order_ts) - INTERVAL 2 DAY FROM r_orders)""", "r_orders"),

    "merged_daily_revenue": with_roles(f"""
SELECT CAST(order_ts AS DATE) AS day, {_money('SUM(revenue_usd)')} AS revenue, COUNT(*) AS orders
FROM r_orders WHERE source IS DISTINCT FROM '4-NOT SPECIFIED' GROUP BY 1""", "r_orders"),

    "reconciliation": with_roles(f"""
, item AS (SELECT order_id, SUM(qty * unit_price_usd) AS items_usd FROM r_order_items GROUP BY 1
), head AS (SELECT order_id, SUM(revenue_usd) AS header_usd FROM r_orders GROUP BY 1
), sides AS (
    SELECT 'no items' AS cause, header_usd, NULL AS items_usd FROM head
    WHERE NOT EXISTS (SELECT 1 FROM item WHERE item.order_id IS NOT DISTINCT FROM head.order_id)
    UNION ALL
    SELECT 'no header', NULL, items_usd FROM item
    WHERE NOT EXISTS (SELECT 1 FROM head WHERE item.order_id IS NOT DISTINCT FROM head.order_id)
    UNION ALL
    SELECT CASE WHEN header_usd IS NULL OR items_usd IS NULL THEN 'no amount' WHEN header_usd = items_usd THEN 'equal' ELSE 'differs' END,
           header_usd, items_usd
    FROM head JOIN item ON item.order_id IS NOT DISTINCT FROM head.order_id)
SELECT cause, COUNT(*) AS orders, {_money('SUM(header_usd)')} AS header_usd, {_money('SUM(items_usd)')} AS items_usd,
       {_money('SUM(ABS(header_usd - items_usd))')} AS gap_usd
FROM sides GROUP BY cause""", "r_order_items", "r_orders"),

    "customers_difference": with_roles("""
, a AS (SELECT customer_id, COUNT(*) AS n FROM r_customers GROUP BY 1
), b AS (SELECT customer_id, COUNT(*) AS n FROM r_orders GROUP BY 1)
SELECT COALESCE(a.customer_id, b.customer_id) AS customer_id,
       CASE WHEN COALESCE(a.n, 0) > COALESCE(b.n, 0) THEN 'left' ELSE 'right' END AS side,
       ABS(COALESCE(a.n, 0) - COALESCE(b.n, 0)) AS copies
FROM a FULL JOIN b ON a.customer_id IS NOT DISTINCT FROM b.customer_id WHERE COALESCE(a.n, 0) <> COALESCE(b.n, 0)""",
                                       "r_customers", "r_orders"),

    "event_props": "SELECT event_id, event_type, CAST(props ->> '$.k' AS BIGINT) AS p_k FROM events",

    "event_props_keys": """
WITH pairs AS (
    SELECT event_type, unnest(json_keys(props)) AS key, props FROM events WHERE props IS NOT NULL
), v AS (SELECT event_type, key, json_extract_string(props, '$."' || key || '"') AS value FROM pairs)
SELECT event_type, key, COUNT(*) AS rows, COUNT(DISTINCT value) AS distinct_values, COUNT(TRY_CAST(value AS DOUBLE)) AS numbers,
       ROUND(MIN(TRY_CAST(value AS DOUBLE)), 2) AS least, ROUND(MAX(TRY_CAST(value AS DOUBLE)), 2) AS most,
       ROUND(SUM(TRY_CAST(value AS DOUBLE)), 2) AS total
FROM v GROUP BY 1, 2""",

    "ab_bootstrap": with_roles(f"""
, users AS (
    SELECT x.user_id, x."group" AS arm, COALESCE(SUM(o.revenue_usd), 0) AS revenue
    FROM r_experiments x LEFT JOIN r_orders o ON o.customer_id = x.user_id AND o.order_ts >= x.exposed_ts
    GROUP BY 1, 2
), drawn AS (
    SELECT arm, r AS replicate, revenue,
           CAST('0x' || substr(md5(CAST(user_id AS VARCHAR) || ':' || CAST(r AS VARCHAR)), 1, 8) AS BIGINT) AS h
    FROM users, range(1, 101) t(r)
), means AS (
    SELECT arm, replicate, CAST(SUM(({_WEIGHT}) * revenue) AS DOUBLE) / SUM({_WEIGHT}) AS mean FROM drawn GROUP BY 1, 2
), point AS (
    SELECT arm, COUNT(*) AS users, CAST(SUM(revenue) AS DOUBLE) / COUNT(*) AS mean FROM users GROUP BY 1
), every AS (
    SELECT arm, replicate, mean FROM means
    UNION ALL SELECT 'B - A', a.replicate, b.mean - a.mean FROM means a JOIN means b USING (replicate) WHERE a.arm = 'A' AND b.arm = 'B'
), points AS (
    SELECT * FROM point
    UNION ALL SELECT 'B - A', a.users + b.users, b.mean - a.mean FROM point a, point b WHERE a.arm = 'A' AND b.arm = 'B'
), spread AS (
    SELECT arm, stddev_samp(mean) AS std_error, quantile_cont(mean, 0.025) AS low, quantile_cont(mean, 0.975) AS high
    FROM every GROUP BY arm)
SELECT arm, users, ROUND(mean, 6) AS mean, ROUND(std_error, 6) AS std_error, ROUND(low, 6) AS low, ROUND(high, 6) AS high
FROM points LEFT JOIN spread USING (arm)""", "r_experiments", "r_orders"),

    "retention_matrix": with_roles("""
, active AS (
    SELECT DISTINCT customer_id, CAST(date_trunc('month', order_ts) AS DATE) AS m FROM r_orders WHERE customer_id IS NOT NULL
), placed AS (
    SELECT MIN(m) OVER (PARTITION BY customer_id) AS cohort_month, m FROM active
), calendar AS (
    SELECT m, ROW_NUMBER() OVER (ORDER BY m) - 1 AS k FROM (SELECT DISTINCT m FROM active WHERE m IS NOT NULL) ORDER BY m LIMIT 4
), n AS (
    SELECT cohort_month, COUNT_IF(k = 0) AS n0, COUNT_IF(k = 1) AS n1, COUNT_IF(k = 2) AS n2, COUNT_IF(k = 3) AS n3
    FROM placed LEFT JOIN calendar USING (m) GROUP BY 1)
SELECT cohort_month, ROUND(n0 / NULLIF(n0, 0), 6) AS m0, ROUND(n1 / NULLIF(n0, 0), 6) AS m1,
       ROUND(n2 / NULLIF(n0, 0), 6) AS m2, ROUND(n3 / NULLIF(n0, 0), 6) AS m3 FROM n""", "r_orders"),

    "sql_category_months": with_roles(f"""
, sold AS (SELECT order_id, product_id, SUM(qty * unit_price_usd) AS usd FROM r_order_items GROUP BY ALL)
SELECT category, make_date(year(order_ts), 1, 1) AS year, {_money('SUM(usd)')} AS revenue_usd, COUNT(DISTINCT order_id) AS orders
FROM sold JOIN r_orders USING (order_id) JOIN r_products USING (product_id) GROUP BY ALL""",
                                      "r_order_items", "r_orders", "r_products"),

    "table_list": """
SELECT * FROM (VALUES
    ('customers', 6, 'customer_id, signup_date, country, age_band, income_band, channel', 'customer_id'),
    ('products', 4, 'product_id, product_name, category, price_usd', 'product_id'),
    ('orders', 5, 'order_id, customer_id, order_ts, source, revenue_usd', 'order_id'),
    ('order_items', 4, 'order_id, product_id, qty, unit_price_usd', NULL),
    ('events', 4, 'event_id, customer_id, event_ts, event_type', 'event_id'),
    ('marketing_experiments', 6, 'exp_id, user_id, group, exposed_ts, converted, conversion_ts', 'exp_id')
) t(table_name, n_columns, columns, primary_key)""",

    "preview_daily_revenue": with_roles(f"""
, sold AS (SELECT order_id, SUM(qty * unit_price_usd) AS usd FROM r_order_items GROUP BY 1)
SELECT CAST(order_ts AS DATE) AS order_date, {_money('SUM(usd)')} AS daily_revenue_usd
FROM sold JOIN r_orders USING (order_id) GROUP BY 1 ORDER BY 1 NULLS FIRST LIMIT 10""", "r_order_items", "r_orders"),
}
