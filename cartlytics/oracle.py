"""DuckDB SQL equivalent of each registered query (the correctness oracle).

The SQL is written from the definitions in SURVEY, by other methods than the
Spark operators where there is a choice, over the role CTEs of
``cartlytics.sources.roles`` (the same projections the Spark queries use).
Output columns are aliased and rounded as ``cartlytics.registry`` does: money
to cents, other doubles to 6 places unless said otherwise.
"""

from __future__ import annotations

from .extended_sql import SQL as EXTENDED_SQL
from .functions.stats import normal_critical_value
from .sources.roles import ROLE_SQL, with_roles

CALENDAR = [f"{y}-{m:02d}-01" for y in range(1995, 2002) for m in range(1, 13)]
Z95 = repr(normal_critical_value(0.05))

_LINE = "oi.qty * oi.unit_price_usd"
_MONEY = "ROUND(CAST({} AS DOUBLE), 2)"


def _money(expr: str) -> str:
    return _MONEY.format(expr)


# one row per order that has items, then per customer
_PAID = """paid AS (SELECT order_id, SUM(qty * unit_price_usd) AS usd FROM r_order_items GROUP BY order_id)"""

_LTV = f"""{_PAID}, spent AS (
    SELECT r_orders.customer_id, COUNT(DISTINCT r_orders.order_id) AS orders, SUM(usd) AS revenue_usd
    FROM paid, r_orders WHERE paid.order_id = r_orders.order_id GROUP BY r_orders.customer_id
), ltv AS (
    SELECT spent.customer_id, r_customers.country, r_customers.channel, spent.orders, spent.revenue_usd
    FROM spent, r_customers WHERE spent.customer_id = r_customers.customer_id)"""

# what each customer spent in each month, added up by the month of signup
_SIGNUP_COHORTS = f"""{_PAID}, active AS (
    SELECT r_orders.customer_id AS who, last_day(CAST(order_ts AS DATE)) AS until, SUM(usd) AS usd
    FROM r_orders, paid WHERE paid.order_id = r_orders.order_id GROUP BY ALL
), cohort_revenue AS (
    SELECT make_date(year(signup_date), month(signup_date), 1) AS signup_month,
           make_date(year(until), month(until), 1) AS order_month, SUM(usd) AS revenue_usd
    FROM active, r_customers WHERE who = customer_id GROUP BY ALL)"""

# the months of each customer as a list, its least element, and one row per element;
# orders without a time are one more month, NULL
_PURCHASE_COHORTS = """bought AS (
    SELECT customer_id, list_sort(list_distinct(list(CAST(datetrunc('month', order_ts) AS DATE)))) AS months,
           COUNT(*) > COUNT(order_ts) AS undated
    FROM r_orders WHERE customer_id IS NOT NULL GROUP BY customer_id
), pc AS (
    SELECT months[1] AS cohort_month, active.m AS purchase_month, COUNT(*) AS customers
    FROM bought, unnest(CASE WHEN undated THEN list_append(months, NULL) ELSE months END) AS active(m)
    GROUP BY ALL)"""


def _first_events(events: str) -> str:
    """One row per customer and kind of event: its first time."""
    return f"""firsts AS (
    SELECT customer_id, event_type, event_ts FROM {events}
    QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id, event_type ORDER BY event_ts NULLS LAST) = 1
), steps AS (
    SELECT customer_id,
           ANY_VALUE(event_ts) FILTER (event_type = 'visit') AS visit_ts,
           ANY_VALUE(event_ts) FILTER (event_type = 'signup') AS signup_ts,
           ANY_VALUE(event_ts) FILTER (event_type = 'purchase') AS purchase_ts
    FROM firsts GROUP BY customer_id)"""


def _funnel(events: str) -> str:
    return _first_events(events) + """, funnel AS (
    SELECT customer_id, visit_ts, IF(customer_id IS NULL, NULL, signup_ts) AS signup_ts,
           IF(customer_id IS NULL, NULL, purchase_ts) AS purchase_ts
    FROM steps WHERE visit_ts IS NOT NULL)"""


def _monthly(events: str) -> str:
    return _first_events(events) + """, monthly AS (
    SELECT CAST(date_trunc('month', visit_ts) AS DATE) AS month, COUNT(*) AS visitors,
           COUNT(signup_ts) AS signups, COUNT(purchase_ts) AS purchasers
    FROM steps GROUP BY 1)"""


def _ratio(num: str, den: str) -> str:
    return f"ROUND(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0), 6)"


_ARMS = """arms AS (
    SELECT "group" AS grp, COUNT(*) AS users, COUNT(*) FILTER (WHERE converted) AS converters
    FROM r_experiments GROUP BY 1)"""


def _matrix(long: str, row: str, column: str, value: str, zero: str) -> str:
    """One conditional aggregate per month of the calendar, and one for none."""
    cells = [f"COALESCE(MAX({value}) FILTER ({column} = DATE '{m}'), {zero}) AS \"{m}\"" for m in CALENDAR]
    cells.append(f"COALESCE(MAX({value}) FILTER ({column} IS NULL), {zero}) AS no_month")
    return f"SELECT {row}, {', '.join(cells)} FROM {long} GROUP BY {row}"


_TOTALS = """t AS (
    SELECT COUNT(*) FILTER (WHERE "group" = 'A') AS n_a,
           COUNT(*) FILTER (WHERE "group" = 'A' AND converted) AS c_a,
           COUNT(*) FILTER (WHERE "group" = 'B') AS n_b,
           COUNT(*) FILTER (WHERE "group" = 'B' AND converted) AS c_b
    FROM r_experiments WHERE "group" IN ('A', 'B')
), s AS (
    SELECT CAST(c_a AS DOUBLE) / NULLIF(CAST(n_a AS DOUBLE), 0) AS p_a,
           CAST(c_b AS DOUBLE) / NULLIF(CAST(n_b AS DOUBLE), 0) AS p_b,
           CAST(c_a + c_b AS DOUBLE) / NULLIF(CAST(n_a + n_b AS DOUBLE), 0) AS p,
           CAST(1.0 AS DOUBLE) / NULLIF(CAST(n_a AS DOUBLE), 0) AS inv_a,
           CAST(1.0 AS DOUBLE) / NULLIF(CAST(n_b AS DOUBLE), 0) AS inv_b
    FROM t)"""

_SAMPLE = """sc AS (
    SELECT * FROM r_customers
    ORDER BY md5('42:' || CAST(customer_id AS VARCHAR)), customer_id LIMIT 500
), so AS (
    SELECT * FROM r_orders WHERE customer_id IN (SELECT customer_id FROM sc)
), soi AS (
    SELECT * FROM r_order_items WHERE order_id IN (SELECT order_id FROM so)
), se AS (
    SELECT * FROM r_events WHERE customer_id IN (SELECT customer_id FROM sc)
), sx AS (
    SELECT * FROM r_experiments WHERE user_id IN (SELECT customer_id FROM sc))"""

_ALL_ROLES = ("r_customers", "r_products", "r_orders", "r_order_items", "r_events", "r_experiments")


def _pk(table: str, role: str, key: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{key}' AS key_column,
       CAST(COALESCE(SUM(c), 0) AS BIGINT) AS n_rows,
       CAST(COALESCE(SUM(CASE WHEN k IS NULL THEN c END), 0) AS BIGINT) AS null_keys,
       COUNT(*) FILTER (WHERE k IS NOT NULL AND c > 1) AS duplicate_keys,
       CAST(COALESCE(SUM(CASE WHEN k IS NOT NULL AND c > 1 THEN c - 1 END), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT {key} AS k, COUNT(*) AS c FROM {role} GROUP BY 1)"""


def _fk(child: str, child_role: str, fk: str, parent: str, parent_role: str, pk: str) -> str:
    return f"""SELECT '{child}.{fk} -> {parent}.{pk}' AS edge, COUNT(*) AS violations
FROM {child_role} ch WHERE ch.{fk} IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {parent_role} pa WHERE pa.{pk} = ch.{fk})"""


SQL: dict[str, str] = {
    "daily_revenue": with_roles(f"""
SELECT CAST(o.order_ts AS DATE) AS order_date, {_money(f'SUM({_LINE})')} AS daily_revenue_usd
FROM r_orders o JOIN r_order_items oi USING (order_id)
GROUP BY 1 ORDER BY 1""", "r_orders", "r_order_items"),

    "category_performance": with_roles(f"""
SELECT p.category, {_money(f'SUM({_LINE})')} AS revenue_usd,
       COUNT(DISTINCT oi.product_id) AS products_sold
FROM r_order_items oi JOIN r_products p USING (product_id)
GROUP BY 1 ORDER BY SUM({_LINE}) DESC""", "r_order_items", "r_products"),

    "top_products": with_roles(f"""
SELECT p.product_name, p.category, {_money(f'SUM({_LINE})')} AS revenue_usd, COUNT(*) AS item_lines
FROM r_order_items oi JOIN r_products p USING (product_id)
GROUP BY 1, 2 ORDER BY SUM({_LINE}) DESC, 1, 2 LIMIT 10""", "r_order_items", "r_products"),

    "customer_ltv": with_roles(f""", {_LTV}
SELECT customer_id, country, channel, orders, {_money('revenue_usd')} AS revenue_usd
FROM ltv ORDER BY ltv.revenue_usd DESC""", "r_customers", "r_orders", "r_order_items"),

    "ltv_summary": with_roles(f""", {_LTV}, v AS (
    SELECT CAST(revenue_usd AS DOUBLE) AS v, revenue_usd AS x FROM ltv WHERE revenue_usd IS NOT NULL)
SELECT COUNT(v) AS count,
       ROUND(CAST(SUM(x) AS DOUBLE) / NULLIF(COUNT(v), 0), 6) AS mean,
       ROUND(stddev_samp(v), 4) AS std,
       ROUND(MIN(v), 6) AS min,
       ROUND(quantile_cont(v, 0.5), 6) AS p50,
       ROUND(quantile_cont(v, 0.75), 6) AS p75,
       ROUND(quantile_cont(v, 0.9), 6) AS p90,
       ROUND(quantile_cont(v, 0.95), 6) AS p95,
       ROUND(MAX(v), 6) AS max
FROM v""", "r_customers", "r_orders", "r_order_items"),

    "ltv_histogram": with_roles(f""", {_LTV}, v AS (
    SELECT CAST(revenue_usd AS DOUBLE) AS v FROM ltv WHERE revenue_usd IS NOT NULL
), mm AS (
    SELECT CASE WHEN MIN(v) = MAX(v) THEN MIN(v) - 0.5 ELSE MIN(v) END AS lo,
           CASE WHEN MIN(v) = MAX(v) THEN MAX(v) + 0.5 ELSE MAX(v) END AS hi
    FROM v HAVING COUNT(*) > 0
), c AS (
    SELECT LEAST(CAST(FLOOR((v.v - mm.lo) * 30.0 / (mm.hi - mm.lo)) AS BIGINT) + 1, 30) AS bucket,
           COUNT(*) AS customers
    FROM v CROSS JOIN mm GROUP BY 1)
SELECT CAST(b.bucket AS INTEGER) AS bucket,
       ROUND(mm.lo + (b.bucket - 1) * (mm.hi - mm.lo) / 30.0, 6) AS bin_low,
       ROUND(mm.lo + b.bucket * (mm.hi - mm.lo) / 30.0, 6) AS bin_high,
       COALESCE(c.customers, 0) AS customers
FROM range(1, 31) b(bucket) CROSS JOIN mm LEFT JOIN c ON c.bucket = b.bucket
ORDER BY 1""", "r_customers", "r_orders", "r_order_items"),

    "signup_cohort_revenue": with_roles(f""", {_SIGNUP_COHORTS}
SELECT signup_month, order_month, {_money('revenue_usd')} AS revenue_usd
FROM cohort_revenue ORDER BY signup_month, order_month""", "r_customers", "r_orders", "r_order_items"),

    "cohort_revenue_matrix": with_roles(f""", {_SIGNUP_COHORTS}, long AS (
    SELECT signup_month, order_month, {_money('revenue_usd')} AS revenue_usd FROM cohort_revenue)
{_matrix('long', 'signup_month', 'order_month', 'revenue_usd', '0.0')}""", "r_customers", "r_orders", "r_order_items"),

    "ranked_customers": with_roles("""
SELECT c.customer_id, c.country,
       ROUND(CAST(SUM(o.revenue_usd) AS DOUBLE), 2) AS revenue,
       ROW_NUMBER() OVER (ORDER BY SUM(o.revenue_usd) DESC NULLS LAST, c.customer_id) AS rn,
       RANK() OVER (ORDER BY SUM(o.revenue_usd) DESC NULLS LAST) AS rnk
FROM r_orders o JOIN r_customers c USING (customer_id)
GROUP BY 1, 2 ORDER BY revenue DESC""", "r_orders", "r_customers"),

    "revenue_moving_avg": with_roles("""
, d AS (SELECT CAST(order_ts AS DATE) AS day, SUM(revenue_usd) AS revenue FROM r_orders GROUP BY 1)
SELECT day, ROUND(CAST(revenue AS DOUBLE), 2) AS revenue,
       ROUND(CASE WHEN COUNT(revenue) OVER w7 = 7
                  THEN CAST(SUM(revenue) OVER w7 AS DOUBLE) / 7.0 END, 6) AS ma7,
       ROUND(CASE WHEN COUNT(revenue) OVER w28 = 28
                  THEN CAST(SUM(revenue) OVER w28 AS DOUBLE) / 28.0 END, 6) AS ma28
FROM d
WINDOW w7 AS (ORDER BY day ASC NULLS LAST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w28 AS (ORDER BY day ASC NULLS LAST ROWS BETWEEN 27 PRECEDING AND CURRENT ROW)
ORDER BY day""", "r_orders"),

    "purchase_cohorts": with_roles(f""", {_PURCHASE_COHORTS}
SELECT cohort_month, purchase_month, customers FROM pc ORDER BY 1, 2""", "r_orders"),

    "cohort_customer_matrix": with_roles(f""", {_PURCHASE_COHORTS}
{_matrix('pc', 'cohort_month', 'purchase_month', 'customers', '0')}""", "r_orders"),

    "cohort_retention": with_roles(f""", {_PURCHASE_COHORTS}, o AS (
    SELECT cohort_month, purchase_month, customers,
           CAST((year(purchase_month) - year(cohort_month)) * 12
                + month(purchase_month) - month(cohort_month) AS INTEGER) AS month_offset
    FROM pc WHERE cohort_month IS NOT NULL AND purchase_month IS NOT NULL
), s AS (
    SELECT cohort_month, MAX(CASE WHEN month_offset = 0 THEN customers END) AS cohort_size
    FROM o GROUP BY 1)
SELECT o.cohort_month, o.month_offset, o.customers, s.cohort_size,
       {_ratio('o.customers', 's.cohort_size')} AS retention
FROM o JOIN s USING (cohort_month)
WHERE o.month_offset BETWEEN 0 AND 3
ORDER BY 1, 2""", "r_orders"),

    "cohort_retention_calendar": with_roles(f""", {_PURCHASE_COHORTS}, fm AS (
    SELECT purchase_month FROM (SELECT DISTINCT purchase_month FROM pc WHERE purchase_month IS NOT NULL)
    ORDER BY 1 LIMIT 4
), cohorts AS (SELECT DISTINCT cohort_month FROM pc
), cells AS (
    SELECT c.cohort_month, f.purchase_month, COALESCE(pc.customers, 0) AS customers
    FROM cohorts c CROSS JOIN fm f
    LEFT JOIN pc ON pc.cohort_month = c.cohort_month AND pc.purchase_month = f.purchase_month
), base AS (
    SELECT cohort_month, customers AS base FROM cells
    WHERE purchase_month = (SELECT MIN(purchase_month) FROM fm))
SELECT cells.cohort_month, cells.purchase_month,
       {_ratio('cells.customers', 'base.base')} AS retention
FROM cells JOIN base ON cells.cohort_month IS NOT DISTINCT FROM base.cohort_month
ORDER BY 1, 2""", "r_orders"),

    "customer_funnel": with_roles(f""", {_funnel('r_order_events')}
SELECT customer_id, visit_ts, signup_ts, purchase_ts FROM funnel""", "r_order_events"),

    "funnel_steps": with_roles(f""", {_funnel('r_events')}
SELECT COUNT(visit_ts) AS visit, COUNT(signup_ts) AS signup, COUNT(purchase_ts) AS purchase,
       {_ratio('COUNT(signup_ts)', 'COUNT(visit_ts)')} AS visit_to_signup,
       {_ratio('COUNT(purchase_ts)', 'COUNT(signup_ts)')} AS signup_to_purchase,
       {_ratio('COUNT(purchase_ts)', 'COUNT(visit_ts)')} AS visit_to_purchase
FROM funnel""", "r_events"),

    "monthly_funnel": with_roles(f""", {_monthly('r_order_events')}
SELECT month, visitors, signups, purchasers FROM monthly ORDER BY month""", "r_order_events"),

    "monthly_funnel_rates": with_roles(f""", {_monthly('r_order_events')}
SELECT month, visitors, signups, purchasers,
       {_ratio('signups', 'visitors')} AS visit_to_signup,
       {_ratio('purchasers', 'signups')} AS signup_to_purchase
FROM monthly ORDER BY month""", "r_order_events"),

    "ab_conversion": with_roles(f""", {_ARMS}
SELECT grp, users, converters, {_ratio('converters', 'users')} AS rate FROM arms""", "r_experiments"),

    "ab_ztest": with_roles(f""", {_TOTALS}
SELECT ROUND((p_a - p_b) / NULLIF(SQRT(p * (CAST(1.0 AS DOUBLE) - p) * (inv_a + inv_b)), 0), 6) AS z_stat
FROM s""", "r_experiments"),

    "ab_confidence": with_roles(f""", {_ARMS}, r AS (
    SELECT grp, users, CAST(converters AS DOUBLE) / NULLIF(CAST(users AS DOUBLE), 0) AS rate FROM arms
), h AS (
    SELECT grp, rate, CAST('{Z95}' AS DOUBLE) * SQRT(rate * (CAST(1.0 AS DOUBLE) - rate)
           / CAST(users AS DOUBLE)) AS half FROM r
), b AS (
    SELECT grp, rate, GREATEST(CAST(0.0 AS DOUBLE), rate - half) AS lo,
           LEAST(CAST(1.0 AS DOUBLE), rate + half) AS up FROM h)
SELECT grp, ROUND(rate, 6) AS rate, ROUND(lo, 6) AS ci_low, ROUND(up, 6) AS ci_upp,
       ROUND(rate - lo, 6) AS err_low, ROUND(up - rate, 6) AS err_upp
FROM b""", "r_experiments"),

    "order_revenue": with_roles(f"""
SELECT o.order_id, o.customer_id, {_money('r.revenue_usd')} AS revenue_usd
FROM r_orders o
LEFT JOIN (SELECT order_id, SUM(qty * unit_price_usd) AS revenue_usd
           FROM r_order_items GROUP BY 1) r USING (order_id)""", "r_orders", "r_order_items"),

    "referential_sample": with_roles(f""", {_SAMPLE}
SELECT 'customers' AS table_name, COUNT(*) AS n_rows FROM sc
UNION ALL SELECT 'products', COUNT(*) FROM r_products
UNION ALL SELECT 'orders', COUNT(*) FROM so
UNION ALL SELECT 'order_items', COUNT(*) FROM soi
UNION ALL SELECT 'events', COUNT(*) FROM se
UNION ALL SELECT 'marketing_experiments', COUNT(*) FROM sx""", *_ALL_ROLES),

    "recency_weight": with_roles("""
, raw AS (
    SELECT customer_id, CAST(0.3 AS DOUBLE) + CAST(0.7 AS DOUBLE) * (1 + COUNT(*) OVER (
               ORDER BY signup_date, customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
               / COUNT(*) OVER () AS weight
    FROM r_customers WHERE signup_date IS NOT NULL)
SELECT customer_id, ROUND(weight / SUM(weight) OVER (), 12) AS weight FROM raw
UNION ALL
SELECT customer_id, CAST(NULL AS DOUBLE) FROM r_customers WHERE signup_date IS NULL""", "r_customers"),

    "check_primary_keys": with_roles("\n" + "\nUNION ALL\n".join([
        _pk("customers", "r_customers", "customer_id"),
        _pk("products", "r_products", "product_id"),
        _pk("orders", "r_orders", "order_id"),
        _pk("events", "r_events", "event_id"),
        _pk("marketing_experiments", "r_experiments", "exp_id"),
    ]), "r_customers", "r_products", "r_orders", "r_events", "r_experiments"),

    "check_foreign_keys": with_roles("\n" + "\nUNION ALL\n".join([
        _fk("orders", "r_orders", "customer_id", "customers", "r_customers", "customer_id"),
        _fk("order_items", "r_order_items", "order_id", "orders", "r_orders", "order_id"),
        _fk("order_items", "r_order_items", "product_id", "products", "r_products", "product_id"),
        _fk("events", "r_events", "customer_id", "customers", "r_customers", "customer_id"),
        _fk("marketing_experiments", "r_experiments", "user_id", "customers", "r_customers", "customer_id"),
        _fk("orders", "r_orders", "order_id", "order_items", "r_order_items", "order_id"),
    ]), *_ALL_ROLES),

    "table_row_counts": with_roles("""
SELECT 'customers' AS table_name, COUNT(*) AS n_rows FROM r_customers
UNION ALL SELECT 'products', COUNT(*) FROM r_products
UNION ALL SELECT 'orders', COUNT(*) FROM r_orders
UNION ALL SELECT 'order_items', COUNT(*) FROM r_order_items
UNION ALL SELECT 'events', COUNT(*) FROM r_events
UNION ALL SELECT 'marketing_experiments', COUNT(*) FROM r_experiments""", *_ALL_ROLES),

}

SQL["order_funnel_steps"] = SQL["funnel_steps"].replace("FROM r_events", "FROM r_order_events").replace(
    f"r_events AS ({ROLE_SQL['r_events']})", f"r_order_events AS ({ROLE_SQL['r_order_events']})")

SQL["customers_by_orders"] = with_roles("""
, n AS (SELECT customer_id, COUNT(*) AS orders FROM r_orders GROUP BY customer_id)
SELECT c.customer_id, c.country, n.orders,
       ROW_NUMBER() OVER (ORDER BY n.orders DESC, c.customer_id) AS rn,
       1 + (SELECT COUNT(*) FROM n m JOIN r_customers d USING (customer_id) WHERE m.orders > n.orders) AS rnk
FROM r_customers c JOIN n USING (customer_id)""", "r_orders", "r_customers")

# 2 (1 - Phi(|z|)) by an all-positive series: erf(x) = 2/sqrt(pi) exp(-x^2) sum 2^n x^(2n+1) / (1 3 ... (2n+1))
SQL["ab_pvalue"] = with_roles(f""", {_TOTALS}, z AS (
    SELECT (p_a - p_b) / NULLIF(SQRT(p * (CAST(1.0 AS DOUBLE) - p) * (inv_a + inv_b)), 0) AS z FROM s
), x AS (SELECT z, ABS(z) / SQRT(CAST(2.0 AS DOUBLE)) AS x FROM z)
SELECT ROUND(z, 6) AS z_stat,
       ROUND(CASE WHEN x = 0 THEN 1 ELSE 1 - 2 / SQRT(PI()) * EXP(-x * x) * list_sum(list_transform(
           range(0, 80), lambda n: EXP(n * LN(2.0) + (2 * n + 1) * LN(x)
               - COALESCE(list_sum(list_transform(range(0, n + 1), lambda k: LN(2.0 * k + 1))), 0)))) END, 6) AS p_value
FROM x""", "r_experiments")

_ROLE = {"customers": "r_customers", "products": "r_products", "orders": "r_orders", "order_items": "r_order_items",
         "events": "r_events", "marketing_experiments": "r_experiments"}
_MONEY_COLUMNS = {"products": "price_usd", "orders": "revenue_usd", "order_items": "unit_price_usd"}
_SAMPLED = {"customers": "sc", "orders": "so", "order_items": "soi", "events": "se", "marketing_experiments": "sx"}
_FIRST_BY = {"customers": "customer_id", "products": "product_id", "orders": "order_id", "events": "event_id",
             "order_items": "order_id, product_id, qty, unit_price_usd", "marketing_experiments": "exp_id"}


def _columns(table: str) -> str:
    money = _MONEY_COLUMNS.get(table)
    return f"* REPLACE ({_money(money)} AS {money})" if money else "*"


for _table, _cte in _SAMPLED.items():
    SQL[f"sampled_{_table}"] = with_roles(f""", {_SAMPLE}
SELECT {_columns(_table)} FROM {_cte}""", *_ALL_ROLES)
for _table, _order in _FIRST_BY.items():
    SQL[f"preview_{_table}"] = with_roles(f"""
, head AS (SELECT * FROM {_ROLE[_table]} ORDER BY {_order} LIMIT 5)
SELECT {_columns(_table)} FROM head""", _ROLE[_table])
SQL["table_preview"] = SQL["preview_orders"]

SQL.update(EXTENDED_SQL)
