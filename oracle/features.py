"""Checks for line features, customers, forecasts, scenarios and measures."""

from __future__ import annotations

from .base import EDGES, FEATURES, MARGIN, PROFILE, SALES_CATEGORY, M, S, div, on, on_lines, on_profile, pct, r

ORDERS = "COUNT(DISTINCT order_id)"
LINE_MONEY = "CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit"
VALUE = (
    f"{r('profit_margin', 6)} AS profit_margin, {r('unit_price', 6)} AS unit_price, is_loss, is_discounted, "
    f"{r('discount_value', 6)} AS discount_value, discount_band, margin_band"
)
TIME = (
    "order_year, order_month, order_month_name, order_quarter, order_quarter_num, year_month, year_quarter, "
    "order_day_name, order_week, is_weekend_order, processing_month, shipping_days, is_delayed"
)
PROFILE_COLS = (
    "customer_id, customer_name, segment, lifetime_orders, CAST(lifetime_value AS DOUBLE) AS lifetime_value, "
    "CAST(lifetime_profit AS DOUBLE) AS lifetime_profit, lifetime_units, "
    f"{r('avg_discount', 6)} AS avg_discount, first_order, last_order, distinct_products"
)

LINE_FEATURES = {
    "t01_t11_time_features": on_lines(f"SELECT row_id, {TIME} FROM f"),
    "f01_f07_value_features": on_lines(f"SELECT row_id, {VALUE} FROM f"),
    "f06_sales_category": on(
        FEATURES + EDGES, f"SELECT row_id, CAST(sales AS DOUBLE) AS sales, {SALES_CATEGORY} FROM f, se"
    ),
    "f08_qcut_sales_quintile": on_lines("""
        , qe AS (SELECT quantile_cont(CAST(sales AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS e FROM f)
        SELECT row_id, CAST(sales AS DOUBLE) AS sales,
          1 + CAST(CAST(sales AS DOUBLE) > e[1] AS INTEGER) + CAST(CAST(sales AS DOUBLE) > e[2] AS INTEGER)
            + CAST(CAST(sales AS DOUBLE) > e[3] AS INTEGER) + CAST(CAST(sales AS DOUBLE) > e[4] AS INTEGER) AS quintile
        FROM f, qe"""),
    "f09_attach_customer_features": on_profile("""
        SELECT row_id, f.customer_id, lifetime_orders, CAST(lifetime_value AS DOUBLE) AS lifetime_value, is_high_value,
          is_repeat, rfm_segment FROM f LEFT JOIN profile pr ON f.customer_id = pr.customer_id"""),
    "s02_feature_table": on(
        PROFILE + EDGES,
        f"""
        SELECT row_id, order_id, order_date, ship_date, ship_mode, f.customer_id, f.customer_name, f.segment, country,
          region, state, city, postal_code, product_id, product_name, category, sub_category, {LINE_MONEY}, quantity,
          CAST(discount AS DOUBLE) AS discount, {TIME}, {r('f.profit_margin', 6)} AS profit_margin,
          {r('unit_price', 6)} AS unit_price, is_loss, is_discounted, {r('discount_value', 6)} AS discount_value,
          discount_band, margin_band, {SALES_CATEGORY}, lifetime_orders,
          CAST(lifetime_value AS DOUBLE) AS lifetime_value, is_high_value, is_repeat, rfm_segment
        FROM f LEFT JOIN profile pr ON f.customer_id = pr.customer_id, se""",
    ),
    "s11_flat_projection": on_lines("""
        SELECT order_id, order_date, order_year, order_month_name, segment, region, state, city, category, sub_category,
          product_name, customer_name, CAST(sales AS DOUBLE) AS sales, quantity, CAST(discount AS DOUBLE) AS discount,
          CAST(profit AS DOUBLE) AS profit, shipping_days FROM f"""),
}

CUSTOMERS = {
    "p01_lifetime_totals": on_profile(f"SELECT {PROFILE_COLS} FROM p0"),
    "p02_p09_customer_profile": on_profile(f"""
        SELECT {PROFILE_COLS}, {r('avg_order_value', 6)} AS avg_order_value, {r('profit_margin', 6)} AS profit_margin,
          tenure_days, recency_days, is_repeat, is_high_value, r_score, f_score, m_score, rfm_score, rfm_segment
        FROM profile"""),
    "p04_high_value_flag": on_profile(
        "SELECT customer_id, CAST(lifetime_value AS DOUBLE) AS lifetime_value, is_high_value FROM profile"
    ),
    "p05_r_score": on_profile("SELECT customer_id, recency_days, r_score FROM profile"),
    "p06_f_score": on_profile("SELECT customer_id, lifetime_orders, f_score FROM profile"),
    "p07_m_score": on_profile(
        "SELECT customer_id, CAST(lifetime_value AS DOUBLE) AS lifetime_value, m_score FROM profile"
    ),
    "p08_rfm_segment": on_profile("SELECT customer_id, rfm_score, rfm_segment FROM profile"),
    "p10_rfm_rollup": on_profile(f"""
        SELECT rfm_segment, COUNT(*) AS customers, {S('lifetime_value')} AS revenue,
          {r(M('lifetime_orders'), 6)} AS avg_orders, {r(M('recency_days'), 6)} AS avg_recency,
          {r(pct('SUM(lifetime_value)', '(SELECT SUM(lifetime_value) FROM profile)'), 6)} AS pct_revenue
        FROM profile GROUP BY rfm_segment"""),
    "p11_high_value_share": on_profile(f"""
        SELECT COUNT(*) FILTER (WHERE is_high_value) AS high_value_customers,
          {r(div('COUNT(*) FILTER (WHERE is_high_value)', 'COUNT(*)'), 6)} AS share_of_customers,
          {r(div('SUM(lifetime_value) FILTER (WHERE is_high_value)', 'SUM(lifetime_value)'), 6)} AS share_of_revenue
        FROM profile"""),
}


# ---------------------------------------------------------------------- forecast
LAST_MONTH = """(SELECT strftime(CASE WHEN MAX(order_date) = last_day(MAX(order_date)) THEN MAX(order_date)
  ELSE CAST(MAX(order_date) - INTERVAL 1 MONTH AS DATE) END, '%Y-%m') FROM f)"""


def fit(by: str, skip: int) -> str:
    """Positions from the newest month of each series and the fitted growth."""
    keys, comma = (by, ", ") if by else ("1 AS one", ", ")
    part = by or "one"
    return f""",
m{skip} AS (SELECT {keys}{comma}year_month, SUM(sales) AS v FROM f WHERE year_month <= {LAST_MONTH} GROUP BY ALL),
ps{skip} AS (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY year_month DESC) - {skip} AS pos FROM m{skip}),
g{skip} AS (SELECT {part} AS k, COUNT(*) FILTER (WHERE pos > 0) AS n, MAX(year_month) FILTER (WHERE pos > 0) AS last,
  CASE WHEN COUNT(*) FILTER (WHERE pos > 0) >= 24 THEN
    CAST(SUM(v) FILTER (WHERE pos BETWEEN 1 AND 12) AS DOUBLE) / CAST(SUM(v) FILTER (WHERE pos BETWEEN 13 AND 24) AS DOUBLE)
    ELSE 1.0 END AS growth FROM ps{skip} GROUP BY {part})
"""


def ahead(by: str, skip: int, horizon: int) -> str:
    part = by or "one"
    return f""",
fc{skip} AS (SELECT k, i, CAST(CAST(last || '-01' AS DATE) + to_months(CAST(i + 1 AS INTEGER)) AS DATE) AS date,
  CAST(v AS DOUBLE) * growth AS forecast, growth
  FROM g{skip}, range({horizon}) t(i), ps{skip}
  WHERE {part} = k AND pos = LEAST(n, 12) - i % 12 AND pos > 0)
"""


def errors(by: str, skip: int) -> str:
    part = by or "one"
    return f""",
er AS (SELECT k, growth, ABS(forecast - CAST(v AS DOUBLE)) AS err, ABS(forecast - CAST(v AS DOUBLE)) / CAST(v AS DOUBLE) AS rel
  FROM fc{skip}, ps{skip} WHERE {part} = k AND pos + {skip} = {skip} - i),
bt AS (SELECT k, MIN(growth) AS growth, {M('CAST(rel AS DECIMAL(28,12))')} * 100 AS mape,
  {M('CAST(err AS DECIMAL(28,12))')} AS mae FROM er GROUP BY k)
"""


def name(by: str) -> str:
    return f"k AS {by}, " if by else ""


def forecast(by: str = "") -> str:
    return on(
        FEATURES + fit(by, 0) + ahead(by, 0, 3),
        f"SELECT {name(by)}date, {r('forecast', 4)} AS forecast, {r('growth', 4)} AS growth FROM fc0",
    )


def backtest(by: str = "") -> str:
    return on(
        FEATURES + fit(by, 6) + ahead(by, 6, 6) + errors(by, 6),
        f"SELECT {name(by)}{r('growth', 4)} AS growth, {r('mape', 4)} AS mape, {r('mae', 4)} AS mae FROM bt",
    )


def band(by: str = "") -> str:
    key = f"fc0.k AS {by}, " if by else ""
    return on(
        FEATURES + fit(by, 6) + ahead(by, 6, 6) + errors(by, 6) + fit(by, 0) + ahead(by, 0, 3),
        f"""SELECT {key}date, {r('forecast')} AS forecast, {r('forecast * (1 - mape / 100)')} AS lower,
        {r('forecast * (1 + mape / 100)')} AS upper FROM fc0 JOIN bt ON fc0.k = bt.k""",
    )


def capped(cap: str) -> str:
    """Change of profit of a discount's sales in 10^-6 cents, whole numbers throughout."""
    kept, listed = f"(100 - LEAST(pct, {cap}))", "(CASE WHEN pct < 100 THEN 100 - pct ELSE 100 END)"
    top = f"(cents * 1000000 * {kept})"
    return f"CASE WHEN pct IS NULL THEN 0 ELSE SIGN({top}) * ((2 * ABS({top}) + {listed}) // (2 * {listed})) - cents * 1000000 END"


def summed(by: str) -> str:
    key = f"{by}, " if by else ""
    return f"""t AS (SELECT {key}CAST(discount * 100 AS INTEGER) AS pct, CAST(SUM(sales) * 100 AS HUGEINT) AS cents,
      CAST(SUM(profit) * 100 AS HUGEINT) AS gain FROM f GROUP BY ALL)"""


def caps(values: str) -> str:
    return on_lines(f"""
        , {summed('')}, c AS (SELECT CAST(UNNEST({values}) AS INTEGER) AS cap_pct),
        s AS (SELECT cap_pct, CAST(SUM(gain) * 1000000 + SUM({capped('cap_pct')}) AS DECIMAL(38,0)) AS p
          FROM t, c WHERE pct IS NOT NULL GROUP BY cap_pct),
        b AS (SELECT p AS base FROM s WHERE cap_pct = 100)
        SELECT cap_pct, {cents('p')} AS profit, {cents('p - base')} AS uplift,
          {r('CAST(p - base AS DOUBLE) * 100 / CAST(base AS DOUBLE)', 4)} AS uplift_pct FROM s, b""")


def cents(expr: str) -> str:
    """10^-6 cents rounded to whole cents, half away from zero, shown in currency."""
    return f"(SIGN({expr}) * ((ABS(CAST({expr} AS HUGEINT)) + 500000) // 1000000) / 100.0)"


CAPS = caps("[100, 70, 50, 40, 30, 20, 10, 0]")

FORECAST = {
    "g01_forecast_total": forecast(),
    "g01_forecast_by_region": forecast("region"),
    "g01_forecast_by_product": forecast("product_id"),
    "g02_backtest_total": backtest(),
    "g02_backtest_by_region": backtest("region"),
    "g03_forecast_band_total": band(),
    "g03_forecast_band_by_region": band("region"),
    "s10_agg_forecast": band(),
    "g04_discount_caps": CAPS,
    "s10_agg_discount_sim": CAPS,
    "g05_interactive_caps": caps("range(0, 101, 5)"),
    "b16_simulated_profit": on_lines(f"""
        , {summed('region')},
        s AS (SELECT region, CAST(SUM(gain) * 1000000 + SUM({capped('30')}) AS DECIMAL(38,0)) AS p,
          CAST(SUM(gain) * 1000000 AS DECIMAL(38,0)) AS a FROM t GROUP BY region)
        SELECT region, {cents('p')} AS simulated_profit, {cents('p - a')} AS profit_uplift,
          {r('CAST(p - a AS DOUBLE) / CAST(a AS DOUBLE)', 6)} AS profit_uplift_ratio FROM s"""),
}


# ---------------------------------------------------------------------- measures
def by(key: str, **outputs: str) -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in outputs.items())
    return on_lines(f"SELECT {key + ', ' if key else ''}{cols} FROM f" + (f" GROUP BY {key}" if key else ""))


def or0(expr: str) -> str:
    return f"COALESCE({expr}, 0)"


def change(now: str, was: str) -> str:
    return r(div(f"{now} - {was}", was), 6)


UNITS = "CAST(SUM(quantity) AS BIGINT)"
DEEP_LOSS = "SUM(profit) FILTER (WHERE discount > 0.30)"
TOP_PRODUCT = "(SELECT product_name FROM f GROUP BY product_name ORDER BY SUM(sales) DESC, product_name LIMIT 1)"
TOP_CUSTOMER = "(SELECT customer_name FROM f GROUP BY customer_name ORDER BY SUM(sales) DESC, customer_name LIMIT 1)"
TOP_STATE = "(SELECT state FROM f GROUP BY state ORDER BY SUM(sales) DESC, state LIMIT 1)"
BUSIEST = [
    ("product", "product_name", TOP_PRODUCT), ("customer", "customer_name", TOP_CUSTOMER), ("state", "state", TOP_STATE),
]
RANKED = "CAST(DENSE_RANK() OVER (ORDER BY SUM(f.sales) DESC) AS BIGINT) AS sales_rank"

MEASURES = {
    "b01_totals": by("", total_sales=S("sales"), total_profit=S("profit"), units_sold=UNITS),
    "b02_profit_margin": by("category", profit_margin=r(or0(div("SUM(profit)", "SUM(sales)")), 6)),
    "b03_orders_customers": by("region", total_orders=ORDERS, total_customers="COUNT(DISTINCT customer_id)"),
    "b04_avg_order_value": by("segment", avg_order_value=r(or0(div("SUM(sales)", ORDERS)), 6)),
    "b05_calendar": """
        WITH d AS (SELECT year(MIN(o_orderdate)) AS a, year(MAX(o_orderdate)) AS b FROM orders JOIN lineitem
          ON l_orderkey = o_orderkey),
        c AS (SELECT CAST(UNNEST(generate_series(make_date(a, 1, 1), make_date(b, 12, 31), INTERVAL 1 DAY)) AS DATE) AS date
          FROM d)
        SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
          strftime(date, '%b') AS month_name, 'Q' || CAST(quarter(date) AS VARCHAR) AS quarter,
          strftime(date, '%Y-%m') AS year_month, dayname(date) AS day_name FROM c""",
    "b05_calendar_sales": on_lines("""
        , d AS (SELECT year(MIN(order_date)) AS a, year(MAX(order_date)) AS b FROM f),
        c AS (SELECT CAST(UNNEST(generate_series(make_date(a, 1, 1), make_date(b, 12, 31), INTERVAL 1 DAY)) AS DATE) AS date
          FROM d),
        t AS (SELECT order_date, SUM(sales) AS s, COUNT(DISTINCT order_id) AS o FROM f GROUP BY order_date)
        SELECT date, strftime(date, '%Y-%m') AS year_month, CAST(COALESCE(s, 0) AS DOUBLE) AS sales,
          COALESCE(o, 0) AS orders FROM c LEFT JOIN t ON date = order_date"""),
    "b06_prior_year": on_lines(f"""
        , m AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS mo, SUM(sales) AS s, SUM(profit) AS p,
          {ORDERS} AS o FROM f GROUP BY 1)
        SELECT strftime(a.mo, '%Y-%m') AS year_month, CAST(a.s AS DOUBLE) AS sales, CAST(b.s AS DOUBLE) AS sales_prior,
          {change('a.s', 'b.s')} AS sales_change, CAST(a.p AS DOUBLE) AS profit, CAST(b.p AS DOUBLE) AS profit_prior,
          {change('a.p', 'b.p')} AS profit_change, a.o AS orders, b.o AS orders_prior,
          {change('a.o', 'b.o')} AS orders_change
        FROM m a LEFT JOIN m b ON b.mo = CAST(a.mo - INTERVAL 12 MONTH AS DATE)"""),
    "b07_b08_running_sales": on_lines(f"""
        , m AS (SELECT order_year, year_month, SUM(sales) AS s FROM f GROUP BY ALL)
        SELECT year_month, CAST(s AS DOUBLE) AS sales,
          CAST(SUM(s) OVER (PARTITION BY order_year ORDER BY year_month) AS DOUBLE) AS sales_ytd,
          CAST(SUM(s) OVER (ORDER BY year_month) AS DOUBLE) AS running_total FROM m"""),
    "b09_product_rank": on_lines(f"SELECT product_name, {S('sales')} AS sales, {RANKED} FROM f GROUP BY product_name"),
    "b09_customer_rank": on_lines(f"SELECT customer_name, {S('sales')} AS sales, {RANKED} FROM f GROUP BY customer_name"),
    "b10_share_of_selection": on_lines(f"""
        , x AS (SELECT category, sales FROM f WHERE region IN ('ASIA', 'EUROPE'))
        SELECT category, {S('sales')} AS sales, {r(div('SUM(sales)', '(SELECT SUM(sales) FROM x)'), 6)} AS share
        FROM x GROUP BY category"""),
    "b11_deep_discount": by(
        "region",
        deep_discount_loss=f"CAST({DEEP_LOSS} AS DOUBLE)",
        deep_discount_line_share=r(div("COUNT(*) FILTER (WHERE discount > 0.30)", "COUNT(*)"), 6),
    ),
    "b12_prior_month_by_state": on_lines(f"""
        , m AS (SELECT state, CAST(date_trunc('month', order_date) AS DATE) AS mo, SUM(sales) AS s FROM f GROUP BY ALL)
        SELECT a.state, strftime(a.mo, '%Y-%m') AS year_month, CAST(a.s AS DOUBLE) AS sales,
          CAST(b.s AS DOUBLE) AS sales_prior, {change('a.s', 'b.s')} AS sales_change
        FROM m a LEFT JOIN m b ON b.state = a.state AND b.mo = CAST(a.mo - INTERVAL 1 MONTH AS DATE)"""),
    "b13_baskets": by(
        "segment",
        avg_basket_size=r(or0(div("SUM(quantity)", ORDERS)), 6),
        avg_lines_per_order=r(or0(div("COUNT(*)", ORDERS)), 6),
    ),
    "b14_rank_in_scope": on_lines(f"""
        SELECT product_name, {S('sales')} AS sales, {RANKED} FROM f GROUP BY product_name
        UNION ALL SELECT 'Total', {S('sales')}, NULL FROM f"""),
    "b15_exposure": by(
        "category",
        recoverable_profit=f"CAST(-({DEEP_LOSS}) AS DOUBLE)",
        loss_making_lines="COUNT(*) FILTER (WHERE profit < 0)",
    ),
    "b17_top_n_customers": on_lines(f"""
        , k AS (SELECT customer_name, {S('sales')} AS sales, {RANKED} FROM f GROUP BY customer_name)
        SELECT * FROM k WHERE sales_rank <= 5"""),
    **{f"b18_{short}_detail": on_lines(f"""
        SELECT {S('sales')} AS total_sales, {S('profit')} AS total_profit,
          {r(or0(div('SUM(profit)', 'SUM(sales)')), 6)} AS profit_margin, {ORDERS} AS total_orders,
          {UNITS} AS units_sold, {r(M('discount'), 6)} AS avg_discount FROM f WHERE {key} = {top}""")
       for short, key, top in BUSIEST},
    **{f"b18_{short}_trend": on_lines(f"""
        SELECT year_month, {S('sales')} AS sales, {S('profit')} AS profit FROM f WHERE {key} = {top}
        GROUP BY year_month""") for short, key, top in BUSIEST},
    **{f"b18_{short}_orders": on_lines(f"""
        SELECT order_id, order_date, {S('sales')} AS sales, {S('profit')} AS profit, COUNT(*) AS lines FROM f
        WHERE {key} = {top} GROUP BY order_id, order_date""") for short, key, top in BUSIEST},
    "b06_prior_year_sliced": on_lines(f"""
        , x AS (SELECT * FROM f WHERE region IN ('ASIA', 'EUROPE') AND segment = 'BUILDING'),
        a AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS mo, SUM(sales) AS s FROM x
          WHERE order_date BETWEEN DATE '1996-07-01' AND DATE '1998-06-30' GROUP BY 1),
        b AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS mo, SUM(sales) AS s FROM x
          WHERE order_date BETWEEN DATE '1995-07-01' AND DATE '1997-06-30' GROUP BY 1)
        SELECT strftime(a.mo, '%Y-%m') AS year_month, CAST(a.s AS DOUBLE) AS sales, CAST(b.s AS DOUBLE) AS sales_prior,
          {change('a.s', 'b.s')} AS sales_change
        FROM a LEFT JOIN b ON b.mo = CAST(a.mo - INTERVAL 12 MONTH AS DATE)"""),
    "b07_b08_running_sales_sliced": on_lines("""
        , m AS (SELECT order_year, year_month, SUM(sales) AS s FROM f WHERE region IN ('ASIA', 'EUROPE')
          AND segment = 'BUILDING' AND order_date <= DATE '1998-06-30' GROUP BY ALL),
        w AS (SELECT year_month, CAST(s AS DOUBLE) AS sales,
          CAST(SUM(s) OVER (PARTITION BY order_year ORDER BY year_month) AS DOUBLE) AS sales_ytd,
          CAST(SUM(s) OVER (ORDER BY year_month) AS DOUBLE) AS running_total FROM m)
        SELECT * FROM w WHERE year_month >= '1996-07'"""),
    "b09_customer_rank_sliced": on_lines(f"""
        SELECT customer_name, {S('sales')} AS sales, {RANKED} FROM f WHERE region IN ('ASIA', 'EUROPE')
          AND segment = 'BUILDING' AND order_date BETWEEN DATE '1996-07-01' AND DATE '1998-06-30' GROUP BY customer_name"""),
    "b19_state_trend": by("state, year_month", sales=S("sales"), margin_pct=r(MARGIN, 6)),
    "l02_sliced_measures": on_lines(f"""
        SELECT category, {S('sales')} AS total_sales, {S('profit')} AS total_profit,
          {r(or0(div('SUM(profit)', 'SUM(sales)')), 6)} AS profit_margin, {ORDERS} AS total_orders, {UNITS} AS units_sold
        FROM f WHERE order_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' AND region IN ('ASIA', 'EUROPE')
          AND segment = 'BUILDING' GROUP BY category"""),
}

FEATURE_CHECKS = LINE_FEATURES | CUSTOMERS | FORECAST | MEASURES
