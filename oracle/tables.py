"""Checks for breakdown statistics, exported aggregates, dashboard and workbook tables."""

from __future__ import annotations

from .base import MARGIN, M, S, div, on_lines, pct, r

ORDERS = "COUNT(DISTINCT order_id)"
TOTALS = f"{S('sales')} AS sales, {S('profit')} AS profit"
MARGIN6 = r(MARGIN, 6)


def group(key: str, *cols: str, where: str = "") -> str:
    return on_lines(f"SELECT {key}, {', '.join(cols)} FROM f {where} GROUP BY {key}")


def top(key: str, measure: str, k: int, extra: str = "") -> str:
    return on_lines(
        f"SELECT {key}, {r(f'SUM({measure})')} AS {measure}{extra} FROM f GROUP BY {key} "
        f"ORDER BY SUM(f.{measure}) DESC, {key} LIMIT {k}"
    )


DISCOUNT = f"{r(M('discount'), 6)} AS avg_discount"
YEARLY = on_lines(f"""
    , y AS (SELECT order_year, SUM(sales) AS s, SUM(profit) AS p, {ORDERS} AS orders FROM f GROUP BY order_year),
    z AS (SELECT *, LAG(s) OVER (ORDER BY order_year) AS b FROM y)
    SELECT order_year, CAST(s AS DOUBLE) AS sales, CAST(p AS DOUBLE) AS profit, orders, {r(pct('p', 's'), 6)} AS margin,
      {r(pct('s - b', 'b'), 6)} AS yoy FROM z""")
REGION = group("region", TOTALS, f"{r(M('discount'), 6)} AS discount", f"{MARGIN6} AS margin")
MONTHLY = group("year_month", TOTALS)
SEASON = f"""
    , n AS (SELECT COUNT(DISTINCT order_year) AS y FROM f),
    s AS (SELECT order_month, {r('CAST(SUM(sales) AS DOUBLE) / (SELECT y FROM n)')} AS avg_sales FROM f GROUP BY order_month),
    u AS (SELECT *, monthname(make_date(2020, order_month, 1)) AS month FROM s)"""
SHARE = r(pct("SUM(sales)", "SUM(SUM(sales)) OVER ()"), 6)

STATS = {
    "k26_discount_band_table": group(
        "discount_band", "COUNT(*) AS lines", TOTALS, "COUNT(*) FILTER (WHERE is_loss) AS loss_lines",
        f"{MARGIN6} AS margin_pct", f"{r(pct('COUNT(*) FILTER (WHERE is_loss)', 'COUNT(*)'), 6)} AS loss_rate_pct",
    ),
    "k27_deep_discount_impact": on_lines(f"""
        SELECT COUNT(*) FILTER (WHERE discount > 0.30) AS deep_lines,
          {r(pct('COUNT(*) FILTER (WHERE discount > 0.30)', 'COUNT(*)'), 1)} AS deep_line_pct,
          CAST(SUM(profit) FILTER (WHERE discount > 0.30) AS DOUBLE) AS deep_profit,
          CAST(SUM(profit) FILTER (WHERE discount <= 0.30) AS DOUBLE) AS profit_without_deep FROM f"""),
    "k28_seasonality": on_lines(f"""{SEASON}
        (SELECT 'strongest' AS kind, month, avg_sales FROM u ORDER BY avg_sales DESC, order_month LIMIT 3)
        UNION ALL (SELECT 'weakest', month, avg_sales FROM u ORDER BY avg_sales, order_month LIMIT 3)"""),
    "k29_loss_states": on_lines(f"""
        SELECT state, region, {TOTALS}, {DISCOUNT}, {MARGIN6} AS margin_pct FROM f GROUP BY state, region
        HAVING SUM(f.profit) < 0"""),
    "k29_loss_state_discounts": on_lines(f"""
        , s AS (SELECT state, region, SUM(profit) AS p, CAST({M('discount')} AS DECIMAL(20,12)) AS d FROM f GROUP BY state, region)
        SELECT COUNT(*) FILTER (WHERE p < 0) AS loss_states,
          {r('CAST(SUM(d) FILTER (WHERE p < 0) AS DOUBLE) / COUNT(*) FILTER (WHERE p < 0) * 100', 1)} AS loss_avg_discount_pct,
          {r('CAST(SUM(d) FILTER (WHERE p > 0) AS DOUBLE) / COUNT(*) FILTER (WHERE p > 0) * 100', 1)}
            AS profitable_avg_discount_pct FROM s"""),
    "k30_extremes": on_lines("""
        (SELECT 'largest sales' AS kind, product_name, CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit,
          CAST(discount AS DOUBLE) AS discount FROM f ORDER BY f.sales DESC, row_id LIMIT 3)
        UNION ALL (SELECT 'smallest profit', product_name, CAST(sales AS DOUBLE), CAST(profit AS DOUBLE),
          CAST(discount AS DOUBLE) FROM f ORDER BY f.profit, row_id LIMIT 3)"""),
    "k31_segments": group(
        "segment", "COUNT(DISTINCT customer_id) AS customers", f"{ORDERS} AS orders", TOTALS, f"{MARGIN6} AS margin_pct",
        f"{r(div('SUM(sales)', ORDERS), 6)} AS avg_order_value",
    ),
    "k31_ship_modes": group(
        "ship_mode", f"{ORDERS} AS orders", f"{r(M('shipping_days'), 6)} AS avg_days", TOTALS, f"{MARGIN6} AS margin_pct"
    ),
    "k32_city_leaders": on_lines(f"""
        SELECT city || ', ' || state AS label, {TOTALS}, {MARGIN6} AS margin_pct FROM f GROUP BY city, state
        ORDER BY SUM(f.sales) DESC, city, state LIMIT 10"""),
    "k32_category_shares": group("category", TOTALS, f"{MARGIN6} AS margin_pct", f"{SHARE} AS share_pct"),
    "k32_sub_categories": group("sub_category", TOTALS, DISCOUNT, f"{MARGIN6} AS margin_pct"),
    "k33_yearly_summary": YEARLY,
    "k34_region_summary": REGION,
    "k34_top_products": top("product_name", "sales", 10, ", substring(product_name, 1, 32) AS label"),
    "k34_top_customers": top("customer_name", "sales", 10),
    "w08_rolling_mean": on_lines(f"""
        , m AS (SELECT year_month, SUM(sales) AS s, SUM(profit) AS p FROM f GROUP BY year_month)
        SELECT year_month, CAST(s AS DOUBLE) AS sales, CAST(p AS DOUBLE) AS profit,
          CASE WHEN COUNT(s) OVER w = 3 THEN {r('CAST(SUM(s) OVER w AS DOUBLE) / COUNT(s) OVER w')} END AS rolling_mean
        FROM m WINDOW w AS (ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""),
    "s10_agg_monthly": MONTHLY,
    "s10_agg_yearly": YEARLY,
    "s10_agg_region": REGION,
    "s12_agg_category": group(
        "category", TOTALS, f"{ORDERS} AS orders", f"{MARGIN6} AS margin_pct", f"{SHARE} AS pct_of_sales"
    ),
    "s12_agg_discount": group("discount_band", "COUNT(*) AS lines", TOTALS, f"{MARGIN6} AS margin_pct"),
    "s12_agg_region": group(
        "region", TOTALS, f"{ORDERS} AS orders", "COUNT(DISTINCT customer_id) AS customers", DISCOUNT,
        f"{MARGIN6} AS margin_pct",
    ),
    "s12_agg_state": group("state", TOTALS),
    "s12_agg_subcategory": group("category, sub_category", TOTALS, DISCOUNT, f"{MARGIN6} AS margin_pct"),
}


def kpi(place: int, label: str, now: str, was: str, value: str) -> str:
    delta = f"COALESCE({r(pct(f'{now} - {was}', was), 1)}, 0)"
    return f"SELECT CAST({place} AS INTEGER) AS place, '{label}' AS label, {value} AS value, {delta} AS delta_pct FROM t"


LATEST = "order_year = (SELECT MAX(order_year) FROM f)"
BEFORE = "order_year = (SELECT MAX(order_year) FROM f WHERE order_year < (SELECT MAX(order_year) FROM f))"


def both(expr: str, name: str) -> str:
    return (
        f"{expr} AS {name}, {expr} FILTER (WHERE {LATEST}) AS {name}_now, {expr} FILTER (WHERE {BEFORE}) AS {name}_was"
    )


MONTH_GRID = f"""
    , m AS (SELECT order_year, order_month, SUM(sales) AS s, SUM(profit) AS p FROM f GROUP BY ALL),
    g AS (SELECT order_year, UNNEST(range(1, 13)) AS mo FROM (SELECT DISTINCT order_year FROM f))
    SELECT CAST(g.order_year AS INTEGER) AS order_year, strftime(make_date(2020, CAST(mo AS INTEGER), 1), '%b') AS month,
      CAST(COALESCE(s, 0) AS DOUBLE) AS sales, CAST(COALESCE(p, 0) AS DOUBLE) AS profit,
      COALESCE({r(div('p', 's'), 6)}, 0) AS margin
    FROM g LEFT JOIN m ON m.order_year = g.order_year AND order_month = mo
    UNION ALL SELECT NULL, 'Total', {S('sales')}, {S('profit')}, {r(div('SUM(profit)', 'SUM(sales)'), 6)} FROM f"""


def fixed(key: str, members: list[str]) -> str:
    return on_lines(f"""
        , k AS (SELECT UNNEST({members}) AS k UNION SELECT {key} FROM f),
        t AS (SELECT {key}, SUM(sales) AS s, SUM(profit) AS p FROM f GROUP BY {key})
        SELECT k AS {key}, CAST(COALESCE(s, 0) AS DOUBLE) AS sales, CAST(COALESCE(p, 0) AS DOUBLE) AS profit,
          COALESCE({r(div('p', 's'), 6)}, 0) AS margin FROM k LEFT JOIN t ON k = {key}""")


REGION_ROW = f"""{TOTALS}, {ORDERS} AS orders, COUNT(DISTINCT customer_id) AS customers, {r(MARGIN)} AS margin_pct FROM f"""

DASHBOARD = {
    "d01_kpi_cards": on_lines(
        f""", t AS (SELECT {both('SUM(sales)', 's')}, {both('SUM(profit)', 'p')}, {both(ORDERS, 'o')},
        {both('COUNT(DISTINCT customer_id)', 'c')} FROM f)
        {kpi(1, 'Total Sales', 's_now', 's_was', 'CAST(s AS DOUBLE)')} UNION ALL
        {kpi(2, 'Total Profit', 'p_now', 'p_was', 'CAST(p AS DOUBLE)')} UNION ALL
        {kpi(3, 'Total Orders', 'o_now', 'o_was', 'CAST(o AS DOUBLE)')} UNION ALL
        {kpi(4, 'Total Customers', 'c_now', 'c_was', 'CAST(c AS DOUBLE)')} UNION ALL
        {kpi(5, 'Avg Order Value', div('s_now', 'o_now'), div('s_was', 'o_was'), r(div('s', 'o')))}"""
    ),
    "d02_calendar_months": on_lines("""
        , m AS (SELECT order_month, SUM(sales) AS s, SUM(profit) AS p FROM f GROUP BY order_month),
        g AS (SELECT CAST(UNNEST(range(1, 13)) AS INTEGER) AS mo)
        SELECT mo AS order_month, strftime(make_date(2020, mo, 1), '%b') AS month, CAST(COALESCE(s, 0) AS DOUBLE) AS sales,
          CAST(COALESCE(p, 0) AS DOUBLE) AS profit FROM g LEFT JOIN m ON order_month = mo"""),
    "d03_category_share": group("category", f"{r(pct('SUM(sales)', 'SUM(SUM(sales)) OVER ()'), 1)} AS share_pct"),
    "d03_segment_share": group("segment", f"{r(pct('SUM(sales)', 'SUM(SUM(sales)) OVER ()'), 1)} AS share_pct"),
    "d04_top_products": top("product_name", "sales", 5),
    "d04_top_customers": top("customer_name", "sales", 5),
    "d04_top_sub_categories": top("sub_category", "profit", 5),
    "d05_region_table": on_lines(f"SELECT region, {REGION_ROW} GROUP BY region UNION ALL SELECT 'Total', {REGION_ROW}"),
    "d06_state_sales": on_lines(f"""
        SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, {S('sales')} AS sales
        FROM f JOIN nation ON state = n_name GROUP BY n_nationkey"""),
    "d07_as_of": on_lines("SELECT MAX(order_date) AS as_of FROM f"),
    "d08_month_signs": group(
        "year_month", f"{S('profit')} AS profit", "CASE WHEN SUM(f.profit) < 0 THEN 'loss' ELSE 'profit' END AS sign"
    ),
    "e01_kpis": on_lines(
        " UNION ALL ".join(
            f"SELECT '{k}' AS metric, {v} AS value FROM f"
            for k, v in {
                "Total Sales": S("sales"),
                "Total Profit": S("profit"),
                "Profit Margin": r(div("SUM(profit)", "SUM(sales)"), 6),
                "Total Orders": f"CAST({ORDERS} AS DOUBLE)",
                "Total Customers": "CAST(COUNT(DISTINCT customer_name) AS DOUBLE)",
                "Units Sold": S("quantity"),
                "Avg Order Value": r(div("SUM(sales)", ORDERS), 6),
                "Avg Line Value": r(div("SUM(sales)", "COUNT(*)"), 6),
            }.items()
        )
    ),
    "e02_category_table": fixed("category", ["STANDARD", "ECONOMY", "LUXURY"]),
    "e03_monthly_grid": on_lines(MONTH_GRID),
    "e04_region_sheet": on_lines(f"""
        SELECT region, {TOTALS}, {r(div('SUM(profit)', 'SUM(sales)'), 6)} AS margin,
          {r(div('SUM(sales)', '(SELECT SUM(sales) FROM f)'), 6)} AS share_of_sales FROM f GROUP BY region
        UNION ALL SELECT 'Total', {TOTALS}, {r(div('SUM(profit)', 'SUM(sales)'), 6)}, NULL FROM f"""),
    "e04_segment_table": fixed("segment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]),
    "e05_top_customers": on_lines(f"""
        SELECT CAST(row_number() OVER (ORDER BY SUM(f.sales) DESC, customer_name) AS BIGINT) AS rank, customer_name, {TOTALS}
        FROM f GROUP BY customer_name ORDER BY SUM(f.sales) DESC, customer_name LIMIT 20"""),
}

SAMPLE = {
    "l09_scatter_sample": on_lines("""
        SELECT row_id, CAST(discount AS DOUBLE) AS discount, CAST(profit AS DOUBLE) AS profit FROM f
        ORDER BY md5('7:' || row_id), row_id LIMIT 3000"""),
}

TABLE_CHECKS = STATS | DASHBOARD | SAMPLE
