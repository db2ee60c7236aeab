"""Checks for the thirty questions, the views and the warehouse."""

from __future__ import annotations

from .base import EDGES, FEATURES, MARGIN, PROFILE, SALES_CATEGORY, M, S, div, on, on_lines, on_profile, pct, r

AOV = r(div("SUM(sales)", "COUNT(DISTINCT order_id)"))
SALES, PROFIT = r("SUM(sales)"), r("SUM(profit)")
MARGIN2 = r(MARGIN)
ORDERS = "COUNT(DISTINCT order_id)"
UNITS = "CAST(SUM(quantity) AS BIGINT)"


def disc(n: int) -> str:
    return r(f"{M('discount')} * 100", n)


def share(x: str) -> str:
    return r(pct(x, f"SUM({x}) OVER ()"))


VIEW_PRODUCT = f""",
vp AS (
  SELECT product_id, product_name, category, sub_category, ROUND(SUM(sales), 2) AS sales, ROUND(SUM(profit), 2) AS profit,
    {MARGIN2} AS margin_pct, {UNITS} AS units, {ORDERS} AS orders, {disc(2)} AS avg_discount_pct,
    CASE WHEN SUM(profit) < 0 THEN 'Loss making' WHEN {MARGIN} < 5 THEN 'Thin margin'
      WHEN {MARGIN} < 20 THEN 'Healthy' ELSE 'Strong' END AS health_flag
  FROM f GROUP BY product_id, product_name, category, sub_category)
"""
VIEW_REGION = f""",
vr AS (
  SELECT region, state, city, ROUND(SUM(sales), 2) AS sales, ROUND(SUM(profit), 2) AS profit, {MARGIN2} AS margin_pct,
    {ORDERS} AS orders, COUNT(DISTINCT customer_id) AS customers, {disc(2)} AS avg_discount_pct
  FROM f GROUP BY region, state, city)
"""
VIEW_CUSTOMER = """,
vc AS (
  SELECT customer_id, customer_name, segment, lifetime_orders, ROUND(lifetime_value, 2) AS lifetime_value,
    ROUND(lifetime_profit, 2) AS lifetime_profit, ROUND(CAST(avg_order_value AS DECIMAL(38,10)), 2) AS avg_order_value,
    recency_days, rfm_score, rfm_segment, CAST(is_repeat AS INTEGER) AS is_repeat,
    CAST(is_high_value AS INTEGER) AS is_high_value FROM profile)
"""
VC_MONEY = (
    "CAST(lifetime_value AS DOUBLE) AS lifetime_value, CAST(lifetime_profit AS DOUBLE) AS lifetime_profit, "
    "CAST(avg_order_value AS DOUBLE) AS avg_order_value"
)
MONEY = "CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit"

BAND14 = (
    "CASE WHEN discount = 0 THEN 'No discount' WHEN discount <= 0.15 THEN '1-15%' WHEN discount <= 0.30 THEN '16-30%' "
    "WHEN discount <= 0.50 THEN '31-50%' ELSE '50%+' END"
)


def on_products(select: str) -> str:
    return on(FEATURES + VIEW_PRODUCT, select)


def on_regions(select: str) -> str:
    return on(FEATURES + VIEW_REGION, select)


def on_customers(select: str) -> str:
    return on(PROFILE + VIEW_CUSTOMER, select)


def cell(category: str) -> str:
    return f"{r(f'''SUM(CASE WHEN category = '{category}' THEN sales ELSE 0 END)''')} AS {category.lower()}"


CELLS = ", ".join(cell(c) for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"))

QUESTIONS = {
    "q01_executive_kpis": on_lines(f"""
        SELECT {SALES} AS total_sales, {PROFIT} AS total_profit, {MARGIN2} AS profit_margin_pct,
          {ORDERS} AS total_orders, COUNT(DISTINCT customer_id) AS total_customers, {UNITS} AS units_sold,
          {AOV} AS avg_order_value FROM f"""),
    "q02_monthly_revenue": on_lines(f"""
        SELECT year_month, {SALES} AS sales, {PROFIT} AS profit, {ORDERS} AS orders FROM f GROUP BY year_month
        ORDER BY year_month"""),
    "q03_yearly_growth": on_lines(f"""
        , y AS (SELECT order_year, SUM(sales) AS s, SUM(profit) AS p, {ORDERS} AS orders FROM f GROUP BY order_year),
        z AS (SELECT *, LAG(s) OVER (ORDER BY order_year) AS b FROM y)
        SELECT order_year, {r('s')} AS sales, {r('p')} AS profit, {r('b')} AS prev_year_sales,
          {r(pct('s - b', 'b'))} AS yoy_growth_pct, orders FROM z ORDER BY order_year"""),
    "q04_top_10_products_by_sales": on_lines(f"""
        SELECT product_name, category, sub_category, {SALES} AS sales, {PROFIT} AS profit, {MARGIN2} AS margin_pct,
          {UNITS} AS units FROM f GROUP BY product_id, product_name, category, sub_category
        ORDER BY SUM(sales) DESC, product_id LIMIT 10"""),
    "q05_worst_products_by_profit": on_lines(f"""
        SELECT product_name, sub_category, {SALES} AS sales, {PROFIT} AS profit, {disc(1)} AS avg_discount_pct
        FROM f GROUP BY product_id, product_name, sub_category HAVING SUM(f.profit) < 0
        ORDER BY SUM(f.profit), product_id LIMIT 10"""),
    "q06_category_performance": on_lines(f"""
        SELECT category, {SALES} AS sales, {share('SUM(sales)')} AS pct_of_sales, {PROFIT} AS profit,
          {MARGIN2} AS margin_pct, {ORDERS} AS orders FROM f GROUP BY category"""),
    "q07_subcategory_performance": on_lines(f"""
        SELECT category, sub_category, {SALES} AS sales, {PROFIT} AS profit, {MARGIN2} AS margin_pct,
          {disc(1)} AS avg_discount_pct FROM f GROUP BY category, sub_category"""),
    "q08_top_customers": on_lines(f"""
        SELECT CAST(RANK() OVER (ORDER BY SUM(f.sales) DESC) AS BIGINT) AS rank, customer_name, segment, {SALES} AS sales,
          {PROFIT} AS profit, {ORDERS} AS orders, {AOV} AS avg_order_value
        FROM f GROUP BY customer_id, customer_name, segment ORDER BY SUM(f.sales) DESC, customer_id LIMIT 10"""),
    "q09_customer_segments": on_lines(f"""
        SELECT segment, COUNT(DISTINCT customer_id) AS customers, {ORDERS} AS orders, {SALES} AS sales,
          {share('SUM(sales)')} AS pct_of_sales, {PROFIT} AS profit, {AOV} AS avg_order_value FROM f GROUP BY segment"""),
    "q10_repeat_customers": on_lines(f"""
        , c AS (SELECT customer_id, {ORDERS} AS orders, SUM(sales) AS s FROM f GROUP BY customer_id),
        t AS (SELECT CASE WHEN orders = 1 THEN 'One-time' ELSE 'Repeat' END AS customer_type, orders, s FROM c)
        SELECT customer_type, COUNT(*) AS customers, {share('COUNT(*)')} AS pct_of_customers, {r('SUM(s)')} AS sales,
          {share('SUM(s)')} AS pct_of_sales, {r(M('orders'))} AS avg_orders FROM t GROUP BY customer_type"""),
    "q11_region_performance": on_lines(f"""
        SELECT region, {SALES} AS sales, {PROFIT} AS profit, {ORDERS} AS orders,
          COUNT(DISTINCT customer_id) AS customers, {MARGIN2} AS profit_margin_pct, {disc(1)} AS avg_discount_pct
        FROM f GROUP BY region"""),
    "q12_state_performance": on_lines(f"""
        SELECT state, region, {SALES} AS sales, {PROFIT} AS profit, {MARGIN2} AS margin_pct, {ORDERS} AS orders
        FROM f GROUP BY state, region"""),
    "q13_daily_sales_pattern": on_lines(f"""
        SELECT order_day_name AS day_of_week, {ORDERS} AS orders, {SALES} AS sales, {r(M('sales'))} AS avg_line_value
        FROM f GROUP BY order_day_name"""),
    "q14_discount_impact": on_lines(f"""
        SELECT {BAND14} AS discount_band, COUNT(*) AS order_lines, {SALES} AS sales, {PROFIT} AS profit,
          {MARGIN2} AS margin_pct FROM f GROUP BY {BAND14}"""),
    "q15_monthly_running_total": on_lines(f"""
        , m AS (SELECT strftime(order_date, '%Y') AS order_year, year_month, SUM(sales) AS s FROM f GROUP BY ALL)
        SELECT order_year, year_month, {r('s')} AS monthly_sales,
          {r('SUM(s) OVER (PARTITION BY order_year ORDER BY year_month)')} AS running_total_ytd FROM m"""),
    "q16_top_products_by_profit": on_products(f"""
        SELECT product_name, category, sub_category, {MONEY}, margin_pct, units FROM vp
        ORDER BY vp.profit DESC, product_id LIMIT 10"""),
    "q17_bottom_products_by_sales": on_products(f"""
        SELECT product_name, sub_category, {MONEY}, orders FROM vp WHERE orders >= 2
        ORDER BY vp.sales, product_id LIMIT 10"""),
    "q18_high_sales_low_profit": on_products(f"""
        SELECT product_name, category, {MONEY}, margin_pct, avg_discount_pct, health_flag FROM vp
        WHERE CAST(vp.sales AS DOUBLE) > (SELECT {M('sales')} FROM vp) * 1.3 AND margin_pct < 5
        ORDER BY vp.sales DESC, product_id LIMIT 15"""),
    "q19_quarterly_growth": on_lines(f"""
        , y AS (SELECT year_quarter AS quarter, SUM(sales) AS s, SUM(profit) AS p FROM f GROUP BY year_quarter),
        z AS (SELECT *, LAG(s) OVER (ORDER BY quarter) AS b FROM y)
        SELECT quarter, {r('s')} AS sales, {r('p')} AS profit, {r('b')} AS prev_quarter,
          {r(pct('s - b', 'b'))} AS qoq_growth_pct FROM z"""),
    "q20_rolling_3month_sales": on_lines(f"""
        , m AS (SELECT year_month, ROUND(SUM(sales), 2) AS s FROM f GROUP BY year_month)
        SELECT year_month, CAST(s AS DOUBLE) AS sales,
          {r('CAST(SUM(s) OVER w3 AS DOUBLE) / COUNT(s) OVER w3')} AS rolling_3m_avg,
          {r('CAST(SUM(s) OVER w6 AS DOUBLE) / COUNT(s) OVER w6')} AS rolling_6m_avg
        FROM m WINDOW w3 AS (ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
          w6 AS (ORDER BY year_month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"""),
    "q21_customer_lifetime_value": on_customers(f"""
        SELECT CAST(DENSE_RANK() OVER (ORDER BY vc.lifetime_value DESC) AS BIGINT) AS clv_rank, customer_name, segment,
          lifetime_orders, {VC_MONEY}, rfm_segment FROM vc ORDER BY vc.lifetime_value DESC, customer_id LIMIT 20"""),
    "q22_rfm_segments": on_customers(f"""
        SELECT rfm_segment, COUNT(*) AS customers, {share('COUNT(*)')} AS pct_customers,
          {r('SUM(lifetime_value)')} AS revenue, {share('SUM(lifetime_value)')} AS pct_revenue,
          {r(M('lifetime_orders'), 1)} AS avg_orders, {r(M('recency_days'), 0)} AS avg_recency_days
        FROM vc GROUP BY rfm_segment"""),
    "q23_high_value_customers": on_customers(f"""
        SELECT CASE WHEN is_high_value = 1 THEN 'High value (top 20%)' ELSE 'Standard' END AS tier,
          COUNT(*) AS customers, {r('SUM(lifetime_value)')} AS revenue, {share('SUM(lifetime_value)')} AS pct_revenue,
          {r(M('avg_order_value'))} AS avg_order_value, {r(M('lifetime_orders'), 1)} AS avg_orders
        FROM vc GROUP BY is_high_value"""),
    "q24_top_cities_by_revenue": on_regions(f"""
        SELECT city, state, region, {SALES} AS sales, {PROFIT} AS profit, {MARGIN2} AS margin_pct,
          CAST(SUM(orders) AS BIGINT) AS orders FROM vr GROUP BY city, state, region
        ORDER BY SUM(vr.sales) DESC, city, state LIMIT 15"""),
    "q25_underperforming_states": on_regions(f"""
        SELECT state, region, {SALES} AS sales, {PROFIT} AS profit, {MARGIN2} AS margin_pct,
          {r(M('CAST(avg_discount_pct AS DECIMAL(10,2))'), 1)} AS avg_discount_pct
        FROM vr GROUP BY state, region HAVING SUM(vr.profit) < 0"""),
    "q26_shipping_mode_analysis": on_lines(f"""
        SELECT ship_mode, {ORDERS} AS orders, {r(M('shipping_days'), 1)} AS avg_days, {SALES} AS sales,
          {PROFIT} AS profit, {MARGIN2} AS margin_pct,
          {r(pct('SUM(CAST(is_delayed AS INTEGER))', 'COUNT(*)'), 1)} AS pct_beyond_sla FROM f GROUP BY ship_mode"""),
    "q27_highest_discount_orders": on_lines(f"""
        SELECT order_id, order_date, customer_name, product_name, {r('discount * 100', 0)} AS discount_pct, {MONEY}
        FROM f ORDER BY discount DESC, f.profit, row_id LIMIT 15"""),
    "q28_segment_category_matrix": on_lines(f"""
        SELECT segment, {CELLS}, {SALES} AS total_sales, {MARGIN2} AS margin_pct FROM f GROUP BY segment"""),
    "q29_weekend_vs_weekday": on_lines(f"""
        SELECT CASE WHEN is_weekend_order THEN 'Weekend' ELSE 'Weekday' END AS day_type, {ORDERS} AS orders,
          {SALES} AS sales, {AOV} AS avg_order_value, {MARGIN2} AS margin_pct, {disc(1)} AS avg_discount_pct
        FROM f GROUP BY is_weekend_order"""),
    "q30_product_rank_within_category": on_lines(f"""
        , t AS (SELECT category, product_name, SUM(sales) AS s, SUM(profit) AS p FROM f GROUP BY category, product_name),
        k AS (SELECT *, CAST(RANK() OVER (PARTITION BY category ORDER BY s DESC) AS BIGINT) AS sales_rank,
          CAST(RANK() OVER (PARTITION BY category ORDER BY p DESC) AS BIGINT) AS profit_rank FROM t)
        SELECT category, product_name, {r('s')} AS sales, {r('p')} AS profit, sales_rank, profit_rank,
          profit_rank - sales_rank AS rank_gap FROM k WHERE sales_rank <= 5"""),
}

VIEWS = {
    "u01_monthly_summary": on_lines(f"""
        SELECT year_month, order_year, order_month, {SALES} AS sales, {PROFIT} AS profit, {MARGIN2} AS margin_pct,
          {ORDERS} AS orders, COUNT(DISTINCT customer_id) AS customers, {UNITS} AS units, {disc(2)} AS avg_discount_pct,
          {AOV} AS avg_order_value FROM f GROUP BY year_month, order_year, order_month"""),
    "u02_customer_360": on_customers(f"""
        , b AS (SELECT customer_id AS cid, COUNT(DISTINCT product_id) AS distinct_products,
          COUNT(DISTINCT state) AS states_shipped_to, {disc(2)} AS avg_discount_pct FROM f GROUP BY customer_id)
        SELECT customer_id, customer_name, segment, lifetime_orders, {VC_MONEY}, recency_days, rfm_score, rfm_segment,
          is_repeat, is_high_value, distinct_products, states_shipped_to, avg_discount_pct
        FROM vc JOIN b ON customer_id = cid"""),
    "u03_product_performance": on_products(f"""
        SELECT product_id, product_name, category, sub_category, {MONEY}, margin_pct, units, orders, avg_discount_pct,
          health_flag FROM vp"""),
    "u04_regional_summary": on_regions(f"""
        SELECT region, state, city, {MONEY}, margin_pct, orders, customers, avg_discount_pct FROM vr"""),
    "u05_discount_analysis": on_lines(f"""
        SELECT discount_band, category, COUNT(*) AS order_lines, {SALES} AS sales, {PROFIT} AS profit,
          {MARGIN2} AS margin_pct, COUNT(*) FILTER (WHERE is_loss) AS loss_making_lines
        FROM f GROUP BY discount_band, category"""),
    "u06_sales_detail": on(
        PROFILE + EDGES,
        f"""
        SELECT row_id, order_id, order_date, ship_date, ship_mode, shipping_days, f.customer_id, f.customer_name,
          f.segment, product_id, product_name, category, sub_category, region, state, city, postal_code,
          lifetime_orders, CAST(is_high_value AS INTEGER) AS is_high_value, rfm_segment, {MONEY}, quantity,
          CAST(discount AS DOUBLE) AS discount, discount_band, {SALES_CATEGORY},
          CAST(is_weekend_order AS INTEGER) AS is_weekend_order, CAST(is_loss AS INTEGER) AS is_loss,
          {r(pct('profit', 'sales'))} AS profit_margin_pct, order_year, year_month
        FROM f JOIN profile pr ON f.customer_id = pr.customer_id, se""",
    ),
    "u07_dim_customer": on_profile(f"""
        SELECT customer_id, customer_name, segment, lifetime_orders, CAST(lifetime_value AS DOUBLE) AS lifetime_value,
          CAST(lifetime_profit AS DOUBLE) AS lifetime_profit, {r('avg_order_value', 6)} AS avg_order_value, recency_days,
          CAST(is_repeat AS INTEGER) AS is_repeat, CAST(is_high_value AS INTEGER) AS is_high_value, rfm_score, rfm_segment
        FROM profile"""),
    "u08_dim_product": on_lines("""
        , k AS (SELECT product_id, product_name, category, sub_category,
          row_number() OVER (PARTITION BY product_id ORDER BY row_id) AS rn FROM f)
        SELECT product_id, product_name, category, sub_category FROM k WHERE rn = 1"""),
    "u09_dim_geography": on_lines("""
        , g AS (SELECT country, region, state, city, postal_code, MIN(row_id) AS fr FROM f GROUP BY ALL)
        SELECT CAST(row_number() OVER (ORDER BY fr) AS INTEGER) AS geo_id, country, region, state, city, postal_code
        FROM g"""),
    "u10_fact_sales": on(
        FEATURES + EDGES,
        f"""
        , g0 AS (SELECT country, region, state, city, postal_code, MIN(row_id) AS fr FROM f GROUP BY ALL),
        g AS (SELECT *, CAST(row_number() OVER (ORDER BY fr) AS INTEGER) AS geo_id FROM g0)
        SELECT row_id, order_id, order_date, ship_date, ship_mode, customer_id, product_id, geo_id, {MONEY}, quantity,
          CAST(discount AS DOUBLE) AS discount, shipping_days, {r('profit_margin', 6)} AS profit_margin, discount_band,
          {SALES_CATEGORY}, CAST(is_weekend_order AS INTEGER) AS is_weekend_order, CAST(is_loss AS INTEGER) AS is_loss,
          CAST(is_delayed AS INTEGER) AS is_delayed
        FROM f JOIN g ON f.country = g.country AND f.region = g.region AND f.state = g.state AND f.city = g.city
          AND f.postal_code IS NOT DISTINCT FROM g.postal_code, se""",
    ),
    "u11_orphans": """
        SELECT 'dim_customer' AS dimension, COUNT(*) AS orphans FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          LEFT JOIN customer ON o_custkey = c_custkey WHERE c_custkey IS NULL
        UNION ALL SELECT 'dim_product', COUNT(*) FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
          WHERE p_partkey IS NULL
        UNION ALL SELECT 'dim_geography', COUNT(*) FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
          LEFT JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey IS NULL""",
    "u11_reconciliation": on_lines(f"""
        SELECT COUNT(*) AS lines, {SALES} AS sales, {PROFIT} AS profit, {ORDERS} AS orders FROM f"""),
}

ANALYTICS = QUESTIONS | VIEWS
