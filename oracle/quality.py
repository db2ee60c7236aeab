"""Checks for the raw extract, cleaning, data quality and distribution statistics."""

from __future__ import annotations

from .base import FEATURES, LINES, M, S, div, on, on_lines, pct, r

RAW = [
    "row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "customer_name", "segment", "country",
    "city", "state", "postal_code", "region", "product_id", "category", "sub_category", "product_name", "sales",
    "quantity", "discount", "profit",
]
REST = [c for c in RAW if c != "row_id"]
CRITICAL = ["order_date", "customer_id", "product_id", "sales", "quantity"]
TOKENS = (
    "('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA', "
    "'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"
)
US = "'%-m/%-d/%Y'"

EXTRACT = (
    LINES
    + f""",
body AS (
  SELECT CASE WHEN copy = 0 THEN row_id ELSE row_id || '-R' END AS row_id, CAST(order_id AS VARCHAR) AS order_id,
    CASE product_id % 3 WHEN 0 THEN strftime(order_date, '%Y-%m-%d') WHEN 1 THEN strftime(order_date, {US})
      ELSE strftime(order_date, '%Y/%m/%d') END AS order_date,
    CASE WHEN product_id % 89 = 0 THEN '13/45/2018'
      WHEN product_id % 83 = 1 THEN strftime(raw_ship_date, '%Y-%m-%d 00:00:00')
      WHEN product_id % 83 = 2 THEN strftime(raw_ship_date, '%d-%b-%Y')
      WHEN product_id % 83 = 3 THEN strftime(raw_ship_date, '%B %-d, %Y')
      WHEN product_id % 83 = 4 THEN strftime(raw_ship_date, '%Y%m%d') WHEN quantity % 2 = 0 THEN strftime(raw_ship_date, '%Y-%m-%d')
      ELSE strftime(raw_ship_date, {US}) END AS ship_date,
    ship_mode, CAST(customer_id AS VARCHAR) AS customer_id,
    CASE WHEN quantity % 7 = 0 THEN '  ' || customer_name || chr(9) ELSE customer_name END AS customer_name, segment,
    CASE WHEN customer_id % 97 = 0 THEN 'Canada' ELSE country END AS country,
    CASE WHEN quantity % 11 = 0 THEN city || ' ' ELSE city END AS city, state,
    CASE WHEN customer_id % 11 <> 0 THEN CAST(CAST(postal_code AS INTEGER) AS VARCHAR) || '.0' END AS postal_code, region,
    CASE WHEN product_id % 503 = 0 THEN 'NA' ELSE CAST(product_id AS VARCHAR) END AS product_id, category, sub_category,
    product_name, CASE WHEN copy = 0 THEN CAST(sales AS VARCHAR) ELSE CAST(sales AS VARCHAR) || '00' END AS sales,
    CASE WHEN product_id % 509 = 1 THEN '' WHEN product_id % 521 = 2 THEN 'many' ELSE CAST(quantity AS VARCHAR) END AS quantity,
    CASE WHEN product_id % 601 = 3 THEN '1.20' ELSE CAST(discount AS VARCHAR) END AS discount,
    CAST(profit AS VARCHAR) AS profit
  FROM lines, (SELECT UNNEST([0, 1]) AS copy) WHERE copy = 0 OR product_id % 101 = 0),
raw AS (
  SELECT * FROM body UNION ALL
  SELECT 'S-' || CAST(o_orderkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), {', '.join(['NULL'] * 19)}
  FROM orders, (SELECT UNNEST([0, 1]) AS copy)
  WHERE (copy = 0 AND o_orderkey % 13 = 0) OR (copy = 1 AND o_orderkey % 26 = 0)),
prep AS (SELECT {', '.join(f'CASE WHEN {c} NOT IN {TOKENS} THEN {c} END AS {c}' for c in RAW)} FROM raw),
complete AS (SELECT * FROM prep WHERE {' AND '.join(f'{c} IS NOT NULL' for c in CRITICAL)})
"""
)


def number(c: str) -> str:
    return f"COALESCE(CAST(TRY_CAST({c} AS DECIMAL(28,8)) AS VARCHAR), {c})"


NUMERIC = ("sales", "quantity", "discount", "profit", "postal_code")


def date(c: str) -> str:
    shapes = {
        r"\d{4}-\d{2}-\d{2}": "%Y-%m-%d",
        r"\d{1,2}/\d{1,2}/\d{4}": "%m/%d/%Y",
        r"\d{4}/\d{2}/\d{2}": "%Y/%m/%d",
        r"[A-Z][a-z]{2} \d{1,2}, \d{4}": "%b %d, %Y",
        r"[A-Z][a-z]{3,} \d{1,2}, \d{4}": "%B %d, %Y",
        r"\d{1,2}-[A-Z][a-z]{2}-\d{4}": "%d-%b-%Y",
        r"\d{8}": "%Y%m%d",
        r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}": "%Y-%m-%d %H:%M:%S",
    }
    cases = " ".join(f"WHEN regexp_full_match({c}, '{k}') THEN try_strptime({c}, '{v}')" for k, v in shapes.items())
    return f"CAST(CASE {cases} END AS DATE)"


DEDUP = (
    EXTRACT
    + f""",
same AS (SELECT row_id, {', '.join(f'{number(c)} AS {c}' if c in NUMERIC else c for c in REST)} FROM complete),
dedup AS (SELECT MIN(row_id) AS row_id, {', '.join(REST)} FROM same GROUP BY {', '.join(REST)})
"""
)
DIGITS = "CAST(CAST(TRY_CAST(postal_code AS DOUBLE) AS BIGINT) AS VARCHAR)"
TYPED_COLS = {
    "order_date": date("order_date"),
    "ship_date": date("ship_date"),
    "postal_code": f"CASE WHEN length({DIGITS}) < 5 THEN lpad({DIGITS}, 5, '0') ELSE {DIGITS} END",
    "sales": "TRY_CAST(TRY_CAST(sales AS DECIMAL(28,8)) AS DECIMAL(18,4))",
    "quantity": "TRY_CAST(TRY_CAST(quantity AS DECIMAL(28,8)) AS INTEGER)",
    "discount": "TRY_CAST(TRY_CAST(discount AS DECIMAL(28,8)) AS DECIMAL(4,2))",
    "profit": "TRY_CAST(TRY_CAST(profit AS DECIMAL(28,8)) AS DECIMAL(18,4))",
}
TEXT = [c for c in RAW if c not in TYPED_COLS or c == "postal_code"]
CLEAN = (
    DEDUP
    + f""",
typed AS (SELECT {', '.join(f'{TYPED_COLS[c]} AS {c}' if c in TYPED_COLS else c for c in RAW)} FROM dedup),
uses AS (SELECT state, city, postal_code, COUNT(*) AS n FROM typed
  WHERE state IS NOT NULL AND city IS NOT NULL AND postal_code IS NOT NULL GROUP BY ALL),
common AS (SELECT state, city, postal_code AS common_code FROM
  (SELECT *, row_number() OVER (PARTITION BY state, city ORDER BY n DESC, postal_code) AS rn FROM uses) WHERE rn = 1),
filled AS (SELECT typed.* REPLACE (COALESCE(typed.postal_code, common_code) AS postal_code),
    typed.postal_code IS NULL AND common_code IS NOT NULL AS imputed
  FROM typed LEFT JOIN common ON typed.state = common.state AND typed.city = common.city),
cleaned AS (SELECT * EXCLUDE (imputed) REPLACE ({', '.join(f"regexp_replace({c}, '^[ \\t]+|[ \\t]+$', '', 'g') AS {c}" for c in TEXT)})
  FROM filled),
x AS (SELECT *, CAST(date_diff('day', order_date, ship_date) AS INTEGER) AS shipping_days,
  CAST(profit AS DOUBLE) / NULLIF(CAST(sales AS DOUBLE), 0) * 100 AS profit_margin FROM cleaned)
"""
)


def shown(cols=RAW) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in ("sales", "discount", "profit") else c for c in cols)


ALL_NULL = f"COALESCE({', '.join(CRITICAL)}) IS NULL"
ANY_NULL = f"({' OR '.join(f'{c} IS NULL' for c in CRITICAL)})"
AUDIT = {
    "rows loaded": "(SELECT COUNT(*) FROM prep)",
    "shell rows removed": f"(SELECT COUNT(*) FROM prep WHERE {ALL_NULL})",
    "incomplete rows removed": f"(SELECT COUNT(*) FROM prep WHERE NOT {ALL_NULL} AND {ANY_NULL})",
    "duplicates removed": "(SELECT COUNT(*) FROM complete) - (SELECT COUNT(*) FROM dedup)",
    "postal codes imputed": "(SELECT COUNT(*) FROM filled WHERE imputed)",
    "postal codes still missing": "(SELECT COUNT(*) FROM filled WHERE postal_code IS NULL)",
    "ship date before order date": "(SELECT COUNT(*) FROM filled WHERE ship_date < order_date)",
    "order dates unreadable": f"(SELECT COUNT(*) FROM prep WHERE order_date IS NOT NULL AND {date('order_date')} IS NULL)",
    "ship dates unreadable": f"(SELECT COUNT(*) FROM prep WHERE ship_date IS NOT NULL AND {date('ship_date')} IS NULL)",
    "rows kept": "(SELECT COUNT(*) FROM filled)",
    "rows dropped": "(SELECT COUNT(*) FROM prep) - (SELECT COUNT(*) FROM filled)",
}

CLEANING = {
    "c01_prepared_extract": on(EXTRACT, f"SELECT {', '.join(RAW)} FROM prep"),
    "c02_c03_complete_rows": on(EXTRACT, f"SELECT {', '.join(RAW)} FROM complete"),
    "c04_without_duplicates": on(DEDUP, f"SELECT {', '.join(RAW)} FROM dedup"),
    "c05_c07_typed": on(CLEAN, f"SELECT {shown()} FROM typed"),
    "c08_common_postal_codes": on(CLEAN, "SELECT state, city, common_code FROM common"),
    "c09_unresolved_postal": on(
        CLEAN, "SELECT city, state, COUNT(*) AS lines FROM cleaned WHERE postal_code IS NULL GROUP BY city, state"
    ),
    "c10_cleaned": on(CLEAN, f"SELECT {shown()} FROM cleaned"),
    "c11_ship_before_order": on(
        CLEAN, "SELECT COUNT(*) FILTER (WHERE ship_date < order_date) AS ship_before_order FROM cleaned"
    ),
    "c12_cleaning_audit": on(
        CLEAN, " UNION ALL ".join(f"SELECT '{k}' AS step, {v} AS rows" for k, v in AUDIT.items())
    ),
    "c13_validated_totals": on(CLEAN, f"""
        SELECT {r('SUM(sales)')} AS total_sales, {r('SUM(profit)')} AS total_profit,
          {r(pct('SUM(profit)', 'SUM(sales)'))} AS margin_pct, COUNT(DISTINCT order_id) AS orders,
          COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT product_id) AS products,
          {r(div('SUM(sales)', 'COUNT(DISTINCT order_id)'))} AS avg_order_value, MIN(order_date) AS first_order,
          MAX(order_date) AS last_order FROM cleaned"""),
    "c14_shell_diagnosis": on(EXTRACT, f"""
        , sh AS (SELECT * FROM prep WHERE sales IS NULL),
        g AS (SELECT COUNT(*) - 1 AS extra FROM prep GROUP BY {', '.join(RAW)})
        SELECT (SELECT COUNT(*) FROM sh) AS rows_without_sales, (SELECT COUNT(order_id) FROM sh) AS with_order_id,
          (SELECT CAST({' + '.join(f'CAST(COUNT({c}) = 0 AS INTEGER)' for c in RAW)} AS BIGINT) FROM sh) AS columns_always_null,
          (SELECT CAST(SUM(extra) AS BIGINT) FROM g) AS exact_duplicates"""),
}

RULES = {
    "No null order IDs": "order_id IS NULL",
    "No null customer IDs": "customer_id IS NULL",
    "No null sales values": "sales IS NULL",
    "Sales are non-negative": "sales < 0",
    "Quantity is positive": "quantity <= 0",
    "Discount within 0-100%": "NOT COALESCE(discount BETWEEN 0 AND 1, FALSE)",
    "Ship date on or after order date": "ship_date < order_date",
    "Shipping days within 0-30": "NOT COALESCE(shipping_days BETWEEN 0 AND 30, FALSE)",
    "Country is single-valued (US)": "country IS DISTINCT FROM 'United States'",
    "Region in expected set": "NOT COALESCE(region IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE'), FALSE)",
    "Segment in expected set": "NOT COALESCE(segment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD'), FALSE)",
    "Category in expected set": "NOT COALESCE(category IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL'), FALSE)",
    "Postal code is 5 chars or explicitly null": "postal_code IS NOT NULL AND length(postal_code) <> 5",
    "Profit margin is finite": "NOT COALESCE(isfinite(profit_margin), FALSE)",
}
VALIDATION = (
    CLEAN
    + ", vv AS ("
    + " UNION ALL ".join(f"SELECT '{k}' AS rule, COUNT(*) FILTER (WHERE {v}) AS violations FROM x" for k, v in RULES.items())
    + f""" UNION ALL SELECT 'No duplicate transactions', CAST(COALESCE(SUM(e), 0) AS BIGINT)
      FROM (SELECT COUNT(*) - 1 AS e FROM x GROUP BY {', '.join(REST)}, shipping_days, profit_margin)),
    rules AS (SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM vv)"""
)

MEASURES = ["sales", "profit", "quantity", "discount", "shipping_days"]
LONG = (
    FEATURES
    + ", lg AS ("
    + " UNION ALL ".join(f"SELECT '{m}' AS measure, CAST({m} AS DOUBLE) AS v FROM f" for m in MEASURES)
    + """),
q0 AS (SELECT measure, COUNT(*) AS n, quantile_cont(v, [0, 0.25, 0.5, 0.75, 1]) AS q, AVG(v) AS mu,
  stddev_samp(v) AS sigma, skewness(v) AS skew FROM lg GROUP BY measure),
fences AS (SELECT *, q[2] - 1.5 * (q[4] - q[2]) AS lo, q[4] + 1.5 * (q[4] - q[2]) AS hi FROM q0)
"""
)


def fence(m: str, side: str) -> str:
    return f"(SELECT {side} FROM fences WHERE measure = '{m}')"


def flag(m: str) -> str:
    v = f"CAST({m} AS DOUBLE)"
    return f"COALESCE({v} < {fence(m, 'lo')} OR {v} > {fence(m, 'hi')}, FALSE)"


FLAGGED = LONG + f""",
fl AS (SELECT row_id, {', '.join(MEASURES)}, {', '.join(f'{flag(m)} AS {m}_outlier' for m in MEASURES)} FROM f),
fo AS (SELECT * FROM fl WHERE {' OR '.join(f'{m}_outlier' for m in MEASURES)})
"""


def histogram(value: str, bins: int) -> str:
    return on_lines(f"""
        , v AS (SELECT {value} AS x FROM f WHERE {value} IS NOT NULL),
        e AS (SELECT MIN(x) AS lo, (MAX(x) - MIN(x)) / {bins} AS w FROM v),
        h AS (SELECT CAST(LEAST(floor((x - lo) / w), {bins - 1}) + 1 AS INTEGER) AS bin, COUNT(*) AS n FROM v, e GROUP BY 1),
        b AS (SELECT CAST(UNNEST(range(1, {bins + 1})) AS INTEGER) AS bin)
        SELECT b.bin, {r('lo + (b.bin - 1) * w', 6)} AS low, {r('lo + b.bin * w', 6)} AS high, COALESCE(n, 0) AS lines
        FROM b LEFT JOIN h ON b.bin = h.bin, e""")


CORRELATED = ["sales", "profit", "quantity", "discount", "unit_price", "shipping_days", "profit_margin"]
PAIRS = [(a, b) for i, a in enumerate(CORRELATED) for b in CORRELATED[:i]]


def corr(a: str, b: str) -> str:
    return r(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))", 6)


KINDS = "'string'"
QUALITY = {
    "k01_k16_rules": on(VALIDATION, "SELECT rule, violations, status FROM rules"),
    "k16_rules_passed": on(
        VALIDATION, "SELECT COUNT(*) FILTER (WHERE status = 'PASS') AS passed, COUNT(*) AS rules FROM rules"
    ),
    "k17_column_profile": on(
        EXTRACT,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", COUNT({c}) AS non_null, COUNT(*) - COUNT({c}) AS null_count,
            COUNT(DISTINCT {c}) AS "unique", MIN({c}) AS sample, {KINDS} AS dtype,
            {r(pct(f'COUNT(*) - COUNT({c})', 'COUNT(*)'))} AS null_pct FROM prep"""
            for c in RAW
        ),
    ),
    "k18_key_uniqueness": on_lines("""
        , g AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT country, region, state, city, postal_code FROM f)),
        w AS (SELECT row_id, COUNT(*) AS u FROM f GROUP BY row_id),
        c AS (SELECT c_custkey, COUNT(*) AS u FROM customer GROUP BY c_custkey),
        p AS (SELECT p_partkey, COUNT(*) AS u FROM part GROUP BY p_partkey)
        SELECT 'dim_customer' AS "table", 'customer_id' AS key, CAST(SUM(u) AS BIGINT) AS rows, COUNT(*) AS keys,
          COUNT(*) FILTER (WHERE u > 1) AS repeated_keys FROM c
        UNION ALL SELECT 'dim_product', 'product_id', CAST(SUM(u) AS BIGINT), COUNT(*), COUNT(*) FILTER (WHERE u > 1) FROM p
        UNION ALL SELECT 'dim_geography', 'geo_id', n, n, 0 FROM g
        UNION ALL SELECT 'fact_sales', 'row_id', CAST(SUM(u) AS BIGINT), COUNT(*), COUNT(*) FILTER (WHERE u > 1) FROM w"""),
    "k19_outlier_summary": on(LONG, f"""
        , k AS (SELECT lg.measure, COUNT(*) FILTER (WHERE v < lo OR v > hi) AS i,
          COUNT(*) FILTER (WHERE ABS((v - mu) / sigma) > 3) AS z FROM lg JOIN fences USING (measure) GROUP BY lg.measure)
        SELECT measure, {r('q[1]')} AS min, {r('q[2]')} AS q1, {r('q[3]')} AS median, {r('q[4]')} AS q3, {r('q[5]')} AS max,
          {r('lo')} AS iqr_lower, {r('hi')} AS iqr_upper, i AS iqr_outliers,
          {r(pct('i', '(SELECT COUNT(*) FROM f)'))} AS iqr_pct, z AS zscore_outliers, {r('skew')} AS skew
        FROM fences JOIN k USING (measure)"""),
    "k20_outlier_rows": on(FLAGGED, f"""
        SELECT row_id, CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit, quantity,
          CAST(discount AS DOUBLE) AS discount, shipping_days, {', '.join(f'{m}_outlier' for m in MEASURES)} FROM fo"""),
    "k20_outlier_share": on(FLAGGED, f"""
        SELECT COUNT(*) AS flagged_rows, {r(pct('COUNT(*)', '(SELECT COUNT(*) FROM f)'), 1)} AS flagged_pct FROM fo"""),
    "k21_shape": on_lines(
        " UNION ALL ".join(
            f"""SELECT '{m}' AS measure, {r(f'skewness(CAST({m} AS DOUBLE))', 6)} AS skew,
            {r(f'kurtosis(CAST({m} AS DOUBLE))', 6)} AS kurtosis FROM f"""
            for m in ("sales", "profit")
        )
    ),
    "k22_median_and_mean": on_lines(f"""
        SELECT 'sales' AS measure, {r('quantile_cont(CAST(sales AS DOUBLE), 0.5)')} AS median, {r(M('sales'))} AS mean
        FROM f"""),
    "k23_histogram_sales": histogram("CAST(sales AS DOUBLE)", 80),
    "k23_histogram_log_sales": histogram("log10(GREATEST(CAST(sales AS DOUBLE), 0.1))", 60),
    "k23_histogram_profit": histogram("CAST(profit AS DOUBLE)", 100),
    "k23_histogram_discount": histogram("CAST(discount * 100 AS DOUBLE)", 25),
    "k24_five_numbers": on(
        LONG,
        f"""SELECT measure, {r('q[1]')} AS min, {r('q[2]')} AS q1, {r('q[3]')} AS median, {r('q[4]')} AS q3,
        {r('q[5]')} AS max FROM fences""",
    ),
    "k25_correlations": on_lines(
        " UNION ALL ".join(f"SELECT '{a}' AS measure, '{b}' AS other, {corr(a, b)} AS r FROM f" for a, b in PAIRS)
    ),
    "k25_correlations_with_profit": on_lines(
        " UNION ALL ".join(
            f"SELECT '{m}' AS measure, {corr(m, 'profit')} AS r FROM f" for m in CORRELATED if m != "profit"
        )
    ),
}

QUALITY_CHECKS = CLEANING | QUALITY
