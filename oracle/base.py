"""The order-line model in DuckDB SQL, and small helpers to write checks against it."""

from __future__ import annotations


def r(expr: str, n: int = 2) -> str:
    """Round half away from zero in DECIMAL, shown as DOUBLE."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def S(expr: str) -> str:
    """Exact sum shown as DOUBLE."""
    return f"CAST(SUM({expr}) AS DOUBLE)"


def M(expr: str) -> str:
    """Mean as exact sum over count."""
    return f"({S(expr)} / NULLIF(COUNT({expr}), 0))"


def pct(p: str, q: str) -> str:
    return f"(CAST({p} AS DOUBLE) * 100 / NULLIF(CAST({q} AS DOUBLE), 0))"


def div(p: str, q: str) -> str:
    return f"(CAST({p} AS DOUBLE) / NULLIF(CAST({q} AS DOUBLE), 0))"


MARGIN = pct("SUM(profit)", "SUM(sales)")

LINES = """
o0 AS (
  SELECT l.*, o.*, c.*, n.*, rg.*, p.*,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
    CAST(CAST(l_discount AS DECIMAL(4,2)) * 8 AS DECIMAL(4,2)) AS d,
    CAST(o_orderdate AS DATE) AS od, CAST(l_shipdate AS DATE) AS sd
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey JOIN customer c ON o_custkey = c_custkey
  JOIN nation n ON c_nationkey = n_nationkey JOIN region rg ON n_regionkey = r_regionkey
  JOIN part p ON l_partkey = p_partkey),
o1 AS (
  SELECT *, CAST(ROUND(price * (1 - d), 2) AS DECIMAL(18,2)) AS sales_,
    od + CAST(((date_diff('day', od, sd) % 8) + 8) % 8 AS INTEGER) AS ship_
  FROM o0),
lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
      || '-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(price AS VARCHAR) AS row_id,
    l_orderkey AS order_id, od AS order_date, CAST(ship_ AS DATE) AS ship_date, sd AS raw_ship_date,
    o_orderpriority AS ship_mode, o_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
    'United States' AS country, r_name AS region, n_name AS state,
    n_name || '-' || CAST(c_custkey % 20 AS VARCHAR) AS city,
    CASE WHEN c_custkey % 20 <> 7 THEN
      lpad(CAST(501 + c_nationkey * 1000 + (c_custkey % 20) * 40 + c_custkey % 3 AS VARCHAR), 5, '0') END AS postal_code,
    l_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS sub_category,
    sales_ AS sales, CAST(l_quantity AS INTEGER) AS quantity, d AS discount,
    CAST(sales_ - ROUND(price * (CAST('0.40' AS DECIMAL(3,2)) + CAST('0.04' AS DECIMAL(3,2)) * (c_nationkey % 10)), 2)
      AS DECIMAL(18,2)) AS profit
  FROM o1)
"""

# Calendar and value features on top of the lines.
FEATURES = (
    LINES
    + """,
f0 AS (
  SELECT *, CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
    strftime(order_date, '%b') AS order_month_name, 'Q' || CAST(quarter(order_date) AS VARCHAR) AS order_quarter,
    CAST(quarter(order_date) AS INTEGER) AS order_quarter_num, strftime(order_date, '%Y-%m') AS year_month,
    strftime(order_date, '%Y') || '-Q' || CAST(quarter(order_date) AS VARCHAR) AS year_quarter,
    dayname(order_date) AS order_day_name, CAST(weekofyear(order_date) AS INTEGER) AS order_week,
    dayofweek(order_date) IN (0, 6) AS is_weekend_order, strftime(ship_date, '%b') AS processing_month,
    CAST(date_diff('day', order_date, ship_date) AS INTEGER) AS shipping_days,
    date_diff('day', order_date, ship_date) > 5 AS is_delayed,
    CAST(profit AS DOUBLE) / NULLIF(CAST(sales AS DOUBLE), 0) * 100 AS profit_margin,
    CAST(sales AS DOUBLE) / NULLIF(quantity, 0) AS unit_price,
    profit < 0 AS is_loss, discount > 0 AS is_discounted,
    CASE WHEN discount < 1 THEN CAST(sales AS DOUBLE) / (1 - CAST(discount AS DOUBLE)) - CAST(sales AS DOUBLE)
      ELSE 0 END AS discount_value,
    CASE WHEN discount <= -0.01 OR discount > 1 THEN NULL WHEN discount <= 0 THEN 'No discount'
      WHEN discount <= 0.15 THEN '1-15%' WHEN discount <= 0.30 THEN '16-30%' WHEN discount <= 0.50 THEN '31-50%'
      WHEN discount <= 1 THEN '50%+' END AS discount_band
  FROM lines),
f AS (
  SELECT *, CASE WHEN profit_margin <= 0 THEN 'Loss' WHEN profit_margin <= 10 THEN 'Low (0-10%)'
      WHEN profit_margin <= 25 THEN 'Healthy (10-25%)' WHEN profit_margin > 25 THEN 'Strong (25%+)' END AS margin_band
  FROM f0)
"""
)

PROFILE = (
    FEATURES
    + """,
p0 AS (
  SELECT customer_id, customer_name, segment, COUNT(DISTINCT order_id) AS lifetime_orders,
    SUM(sales) AS lifetime_value, SUM(profit) AS lifetime_profit, CAST(SUM(quantity) AS BIGINT) AS lifetime_units,
    CAST(SUM(discount) AS DOUBLE) / COUNT(discount) AS avg_discount, MIN(order_date) AS first_order,
    MAX(order_date) AS last_order, COUNT(DISTINCT product_id) AS distinct_products
  FROM f GROUP BY customer_id, customer_name, segment),
p1 AS (
  SELECT *, CAST(lifetime_value AS DOUBLE) / lifetime_orders AS avg_order_value,
    CAST(lifetime_profit AS DOUBLE) * 100 / NULLIF(CAST(lifetime_value AS DOUBLE), 0) AS profit_margin,
    CAST(date_diff('day', first_order, last_order) AS INTEGER) AS tenure_days,
    CAST(date_diff('day', last_order, (SELECT MAX(last_order) FROM p0)) + 1 AS INTEGER) AS recency_days,
    lifetime_orders > 1 AS is_repeat,
    row_number() OVER (ORDER BY lifetime_orders, customer_id, customer_name, segment) AS place,
    COUNT(*) OVER () AS n
  FROM p0),
pe AS (
  SELECT quantile_cont(CAST(recency_days AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS re,
    quantile_cont(CAST(lifetime_value AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS ve FROM p1),
p2 AS (
  SELECT p1.*, CAST(lifetime_value AS DOUBLE) >= ve[4] AS is_high_value,
    5 - CAST(recency_days > re[1] AS INTEGER) - CAST(recency_days > re[2] AS INTEGER)
      - CAST(recency_days > re[3] AS INTEGER) - CAST(recency_days > re[4] AS INTEGER) AS r_score,
    CAST(GREATEST(1, ((place - 1) * 5 + n - 2) // GREATEST(n - 1, 1)) AS INTEGER) AS f_score,
    1 + CAST(CAST(lifetime_value AS DOUBLE) > ve[1] AS INTEGER) + CAST(CAST(lifetime_value AS DOUBLE) > ve[2] AS INTEGER)
      + CAST(CAST(lifetime_value AS DOUBLE) > ve[3] AS INTEGER)
      + CAST(CAST(lifetime_value AS DOUBLE) > ve[4] AS INTEGER) AS m_score
  FROM p1, pe),
profile AS (
  SELECT *, r_score + f_score + m_score AS rfm_score,
    CASE WHEN r_score + f_score + m_score >= 13 THEN 'Champion' WHEN r_score + f_score + m_score >= 10 THEN 'Loyal'
      WHEN r_score + f_score + m_score >= 7 THEN 'Potential' ELSE 'At Risk' END AS rfm_segment
  FROM p2)
"""
)

EDGES = """,
se AS (SELECT quantile_cont(CAST(sales AS DOUBLE), [0.25, 0.5, 0.75]) AS e, MAX(CAST(sales AS DOUBLE)) AS top FROM f)
"""
SALES_CATEGORY = (
    "CASE WHEN sales <= -0.01 THEN NULL WHEN CAST(sales AS DOUBLE) <= e[1] THEN 'Small' "
    "WHEN CAST(sales AS DOUBLE) <= e[2] THEN 'Medium' WHEN CAST(sales AS DOUBLE) <= e[3] THEN 'Large' "
    "WHEN CAST(sales AS DOUBLE) <= top THEN 'Very Large' END AS sales_category"
)


def on(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def on_lines(select: str) -> str:
    return on(FEATURES, select)


def on_profile(select: str) -> str:
    return on(PROFILE, select)
