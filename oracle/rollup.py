"""Checks for stored roll-ups, running totals and the report of unreadable dates."""

from __future__ import annotations

from .base import S, on, on_lines
from .quality import EXTRACT, date

RANGES = (
    "(VALUES ('first half of 1996', DATE '1996-01-01', DATE '1996-06-30'), ('one day', DATE '1997-03-15', DATE '1997-03-15'),"
    " ('everything', DATE '1900-01-01', DATE '2100-12-31'), ('before the first day', DATE '1900-01-01', DATE '1900-12-31'))"
    " v(period, lo, hi)"
)
MEASURES = ["sales", "profit", "quantity", "discount", "shipping_days"]
SHAPE = "regexp_replace(regexp_replace(text, '[0-9]', '9', 'g'), '[A-Za-z]', 'a', 'g')"

ROLLUP_CHECKS = {
    "b07_range_totals": on_lines(f"""
        , r AS (SELECT DISTINCT region FROM f)
        SELECT r.region, period, {S('coalesce(sales, 0)')} AS sales, {S('coalesce(profit, 0)')} AS profit,
          CAST(SUM(coalesce(quantity, 0)) AS BIGINT) AS quantity
        FROM r CROSS JOIN {RANGES} LEFT JOIN f ON f.region = r.region AND order_date BETWEEN lo AND hi
        GROUP BY r.region, period"""),
    "b06_running_comparison": on_lines("""
        , e AS (SELECT MIN(order_date) AS lo, MAX(order_date) AS hi FROM f),
        mo AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', lo) AS DATE), hi, INTERVAL 1 MONTH)) AS DATE) AS m FROM e),
        s AS (SELECT m, COALESCE(SUM(sales), 0) AS now FROM mo LEFT JOIN f ON CAST(date_trunc('month', order_date) AS DATE) = m GROUP BY m)
        SELECT strftime(s.m, '%Y-%m') AS year_month, CAST(s.now AS DOUBLE) AS now, CAST(p.now AS DOUBLE) AS prior,
          CAST(SUM(s.now) OVER (PARTITION BY year(s.m) ORDER BY s.m) AS DOUBLE) AS ytd,
          CAST(SUM(s.now) OVER (ORDER BY s.m) AS DOUBLE) AS total
        FROM s LEFT JOIN s p ON p.m = CAST(s.m - INTERVAL 12 MONTH AS DATE)"""),
    "x15_display_strings": on_lines("""
        SELECT region, format('{:,}', COUNT(*)) AS lines, printf('$%.3fM', CAST(SUM(sales) AS DOUBLE) / 1e6) AS sales,
          printf('$%.1fK', CAST(SUM(profit) AS DOUBLE) / 1e3) AS profit FROM f GROUP BY region"""),
    "a03_sketched_counts": on_lines("""
        SELECT region, COUNT(*) AS lines, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers,
          TRUE AS orders_close, TRUE AS customers_close FROM f GROUP BY region"""),
    "a13_sketched_quantiles": on_lines(
        " UNION ALL ".join(
            f"SELECT '{m}' AS measure, CAST(p AS DOUBLE) AS prob, COUNT({m}) AS n, TRUE AS close FROM f, (VALUES (0.01), (0.25), (0.5), (0.75), (0.99)) v(p) GROUP BY p"
            for m in MEASURES
        )
    ),
    "c05_unreadable_dates": on(
        EXTRACT,
        f", c AS ("
        + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS text FROM prep WHERE {c} IS NOT NULL AND {date(c)} IS NULL" for c in ("order_date", "ship_date"))
        + f') SELECT "column", {SHAPE} AS shape, COUNT(*) AS cells, MIN(text) AS example FROM c GROUP BY ALL',
    ),
}
