"""Every query by name: ``QUERIES[name](spark, folder)`` returns its DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import decimals_to_double, display_money, display_thousands, qcut, rnd
from ..functions.dates import unreadable
from ..functions.quantiles import counted, quantile_edges
from ..operators import cleaning, customers, features, forecast, metrics, quality, rollup, scenario, stats, warehouse
from ..session import configure, materialize
from ..sources.extract import raw_extract
from ..sources.star import BASE_COLS, OrderTables
from . import analytics, dashboard, views, workbook

Builder = Callable[[OrderTables], DataFrame]

# Parameters that follow the order tables rather than the defaults of the library.
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
RULE_CATEGORIES = CATEGORIES[:5]
TIME_FEATURES = [
    "order_year", "order_month", "order_month_name", "order_quarter", "order_quarter_num", "year_month",
    "year_quarter", "order_day_name", "order_week", "is_weekend_order", "processing_month", "shipping_days",
    "is_delayed",
]
VALUE_FEATURES = ["profit_margin", "unit_price", "is_loss", "is_discounted", "discount_value", "discount_band", "margin_band"]


def rounded(df: DataFrame, digits: int = 6, *cols: str) -> DataFrame:
    """Round the DOUBLE columns of an output whose last bits depend on summation order."""
    doubles = [c for c, t in df.dtypes if t == "double" and (not cols or c in cols)]
    return df.withColumns({c: rnd(F.col(c), digits) for c in doubles})


# ---------------------------------------------------------------- line features
def time_features(star: OrderTables) -> DataFrame:
    return star.lines("row_id", *TIME_FEATURES)


def value_features(star: OrderTables) -> DataFrame:
    return rounded(star.lines("row_id", *VALUE_FEATURES))


def sales_categories(star: OrderTables) -> DataFrame:
    return features.add_sales_category(star.lines("row_id", "sales"))


def sales_quintile(star: OrderTables) -> DataFrame:
    lines = star.lines("row_id", "sales")
    edges = [F.col("_edges")[i] for i in range(4)]
    placed = lines.withColumn("_edges", quantile_edges(lines, "sales", [0.2, 0.4, 0.6, 0.8]))
    return placed.withColumn("quintile", qcut(F.col("sales").cast("double"), edges, [1, 2, 3, 4, 5])).drop("_edges")


def feature_table(star: OrderTables, profile: DataFrame | None = None) -> DataFrame:
    """All 47 columns: base, calendar, value, size band and customer columns."""
    known = features.customer_features(views.profile_of(star) if profile is None else profile)
    lines = star.lines(*BASE_COLS, *TIME_FEATURES, *VALUE_FEATURES, per_customer=known)
    return features.add_sales_category(lines, star.lines("sales"))


def attached_customers(star: OrderTables) -> DataFrame:
    return star.lines("row_id", "customer_id", per_customer=features.customer_features(views.profile_of(star)))


# -------------------------------------------------------------------- customers
def profile(star: OrderTables) -> DataFrame:
    return rounded(views.profile_of(star))


def lifetime(star: OrderTables) -> DataFrame:
    return rounded(customers.lifetime_totals(star.lines(*customers.PROFILE_INPUTS)))


def scores(star: OrderTables, *cols: str) -> DataFrame:
    return views.profile_of(star).select("customer_id", *cols)


def rfm_rollup(star: OrderTables) -> DataFrame:
    return rounded(customers.rfm_rollup(views.profile_of(star)))


def high_value_share(star: OrderTables) -> DataFrame:
    return rounded(customers.high_value_share(views.profile_of(star)))


# ------------------------------------------------------------- cleaning, quality
def cleaned_features(star: OrderTables) -> DataFrame:
    """The cleaned extract with the columns the rules look at."""
    lines = cleaning.clean(raw_extract(star))
    speed = F.datediff("ship_date", "order_date")
    margin = F.try_divide(F.col("profit").cast("double"), F.col("sales").cast("double")) * 100
    return lines.withColumns({"shipping_days": speed, "profit_margin": margin})


def validation(star: OrderTables) -> DataFrame:
    rules = quality.column_rules("United States", REGIONS, SEGMENTS, RULE_CATEGORIES)
    return quality.validate(cleaned_features(star), rules)


def keys(star: OrderTables) -> DataFrame:
    places = star.lines("row_id", *warehouse.GEO_KEYS)
    return quality.key_uniqueness(
        {
            "dim_customer": (star.customers(), "customer_id"),
            "dim_product": (star.products(), "product_id"),
            "dim_geography": (warehouse.dim_geography(places), "geo_id"),
            "fact_sales": (star.lines("row_id"), "row_id"),
        }
    )


def measure_lines(star: OrderTables) -> DataFrame:
    return star.lines("row_id", *quality.MEASURES)


def histogram(column: Callable[[], F.Column] | str, bins: int) -> Builder:
    def build(star: OrderTables) -> DataFrame:
        name, value = column
        return stats.histogram(star.lines(name), value(), bins)

    return build


# --------------------------------------------------------------------- warehouse
def fact_table(star: OrderTables) -> DataFrame:
    lines = star.lines(
        "row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "product_id",
        *warehouse.GEO_KEYS, "sales", "quantity", "discount", "profit", "shipping_days", "profit_margin",
        "discount_band", "is_weekend_order", "is_loss", "is_delayed",
    )
    banded = features.add_sales_category(lines, star.lines("sales"))
    return warehouse.fact_sales(banded, warehouse.dim_geography(star.lines("row_id", *warehouse.GEO_KEYS)))


def geography_numbers(star: OrderTables) -> DataFrame:
    return warehouse.dim_geography(star.lines("row_id", *warehouse.GEO_KEYS))


def fact_orphans(star: OrderTables) -> DataFrame:
    geography = materialize(geography_numbers(star), "geography")
    lines = star.lines("row_id", "customer_id", "product_id", *warehouse.GEO_KEYS)
    geo = geography.select("geo_id", *[F.col(k).alias(f"g_{k}") for k in warehouse.GEO_KEYS])
    same = [F.col(k).eqNullSafe(F.col(f"g_{k}")) for k in warehouse.GEO_KEYS]
    fact = lines.join(geo, same, "left").select("customer_id", "product_id", "geo_id")
    return warehouse.orphans(
        fact,
        {
            "dim_customer": (star.customers(), "customer_id"),
            "dim_product": (star.products(), "product_id"),
            "dim_geography": (geography, "geo_id"),
        },
    )


# ---------------------------------------------------------------------- forecast
def series(star: OrderTables, *by: str) -> DataFrame:
    return forecast.monthly_series(star.lines("order_date", "year_month", "sales", *by), by, complete=True)


def forecast_of(star: OrderTables, *by: str) -> DataFrame:
    return rounded(forecast.seasonal_naive(series(star, *by), by), 4)


def backtest_of(star: OrderTables, *by: str) -> DataFrame:
    return rounded(forecast.backtest(series(star, *by), by), 4)


def band_of(star: OrderTables, *by: str) -> DataFrame:
    return rounded(forecast.forecast_with_band(series(star, *by), by), 2)


# ----------------------------------------------------------------------- metrics
def kpi_measures(star: OrderTables, *names: str, by: tuple[str, ...] = ()) -> DataFrame:
    lines = star.lines(*metrics.inputs(names, *by))
    return rounded(metrics.measure(lines, names, by))


def sliced_measures(star: OrderTables) -> DataFrame:
    names = ["total_sales", "total_profit", "profit_margin", "total_orders", "units_sold"]
    lines = star.lines(*metrics.inputs(names, "order_date", "region", "category", "segment"))
    where = metrics.slicer("1996-01-01", "1998-12-31", region=["ASIA", "EUROPE"], segment="BUILDING")
    return rounded(metrics.measure(lines, names, ["category"], where))


def prior_year(star: OrderTables) -> DataFrame:
    columns = {"total_sales": "sales", "total_profit": "profit", "total_orders": "orders"}
    return rounded(metrics.compare_periods(star.lines("order_date", "order_id", "sales", "profit"), columns, 12))


# A selection that cuts dates and members at once.
SELECTION = {"start": "1996-07-01", "end": "1998-06-30", "region": ["ASIA", "EUROPE"], "segment": "BUILDING"}


def prior_year_sliced(star: OrderTables) -> DataFrame:
    lines = star.lines("order_date", "region", "segment", "sales")
    return rounded(metrics.compare_periods(lines, {"total_sales": "sales"}, 12, where=SELECTION))


def running_sliced(star: OrderTables) -> DataFrame:
    return metrics.running_sales(star.lines("order_date", "order_year", "year_month", "region", "segment", "sales"), SELECTION)


def rank_sliced(star: OrderTables) -> DataFrame:
    return metrics.sales_rank(star.lines("order_date", "customer_name", "region", "segment", "sales"), "customer_name", SELECTION)


# Ranges of days that running totals answer.
RANGES = {
    "first half of 1996": ("1996-01-01", "1996-06-30"),
    "one day": ("1997-03-15", "1997-03-15"),
    "everything": ("1900-01-01", "2100-12-31"),
    "before the first day": ("1900-01-01", "1900-12-31"),
}


def totals_of_ranges(star: OrderTables) -> DataFrame:
    running = materialize(rollup.running_totals(star.lines("order_date", "region", *rollup.SUMS), ["region"]), "running")
    return rollup.range_totals(running, RANGES, ["region"])


def running_comparison(star: OrderTables) -> DataFrame:
    running = materialize(rollup.running_totals(star.lines("order_date", "sales"), sums=["sales"]), "running")
    return rollup.period_comparison(running, 12)


def sketched_counts(star: OrderTables) -> DataFrame:
    """Exact distinct counts, and whether the stored sketches stay within their error of them."""
    lines = star.lines(*rollup.ROLLUP_INPUTS, "region")
    stored = materialize(rollup.daily_rollup(lines), "rollup")
    about = rollup.united(stored, ["region"]).select("region", "lines", "orders_about", "customers_about")
    exact = lines.groupBy("region").agg(F.count_distinct("order_id").alias("orders"), F.count_distinct("customer_id").alias("customers"))

    def close(c: str) -> F.Column:
        return (F.abs(F.col(f"{c}_about") / F.col(c) - 1) <= rollup.DISTINCT_ERROR).alias(f"{c}_close")

    return exact.join(about, "region").select("region", "lines", "orders", "customers", close("orders"), close("customers"))


def sketched_quantiles(star: OrderTables) -> DataFrame:
    """Whether each quantile of a united sketch has a rank within the stated error of the wanted one."""
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    lines = star.lines("region", *quality.MEASURES)
    found = rollup.sketched_quantiles(rollup.quantile_sketch(lines, quality.MEASURES, ["region"]), probs)
    wanted = found.select("measure", "n", F.posexplode("q").alias("at", "q"))
    counts = counted(lines, quality.MEASURES).join(wanted, "measure").groupBy("measure", "at", "n").agg(
        F.sum(F.when(F.col("v") < F.col("q"), F.col("cnt")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("v") <= F.col("q"), F.col("cnt")).otherwise(0)).alias("upto"),
    )
    p = F.element_at(F.array(*map(F.lit, probs)), F.col("at") + 1)
    error = rollup.RANK_ERROR
    close = (F.col("below") / F.col("n") <= p + error) & (F.col("upto") / F.col("n") >= p - error)
    return counts.select("measure", p.alias("prob"), "n", close.alias("close"))


def unread_dates(star: OrderTables) -> DataFrame:
    return unreadable(cleaning.prepare(raw_extract(star)), cleaning.DATES)


def prior_month(star: OrderTables) -> DataFrame:
    lines = star.lines("order_date", "state", "sales")
    return rounded(metrics.compare_periods(lines, {"total_sales": "sales"}, 1, ["state"]))


def busiest(star: OrderTables, key: str, part: Callable) -> DataFrame:
    """Drill into the member with the largest sales."""
    lines = star.lines("order_id", "order_date", "year_month", "sales", "profit", "quantity", "discount", key)
    member = lines.groupBy(key).agg(F.sum("sales").alias("s")).orderBy(F.desc("s"), key).limit(1).select(key).scalar()
    return rounded(part(lines, key, member))


def caps(star: OrderTables) -> DataFrame:
    return scenario.discount_caps(star.lines("sales", "profit", "discount"))


def simulated_by_region(star: OrderTables, cap_pct: int = 30) -> DataFrame:
    return scenario.simulated_profit(star.lines("region", "sales", "profit", "discount"), cap_pct, ["region"])


# --------------------------------------------------------------------- dashboard
def state_codes(star: OrderTables) -> DataFrame:
    """A code per state of the order tables, in the role of the postal abbreviations."""
    code = F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    return star.table("nation").select(F.col("n_name").alias("state"), code.alias("code"))


def displayed(star: OrderTables) -> DataFrame:
    """Totals by region as a dashboard writes them."""
    lines = star.lines("region", "sales", "profit").groupBy("region").agg(F.count("*").alias("n"), F.sum("sales").alias("s"), F.sum("profit").alias("p"))
    return lines.select("region", display_thousands(F.col("n")).alias("lines"), display_money(F.col("s"), 1e6, 3, "M").alias("sales"), display_money(F.col("p"), 1e3, 1, "K").alias("profit"))


def payload(star: OrderTables) -> DataFrame:
    return dashboard.payload(star.lines(*dashboard.PAYLOAD_INPUTS), state_codes(star))


def on_lines(build: Callable[..., DataFrame], *cols: str, **kw) -> Builder:
    """A query that is one library function over the given columns of the lines."""
    return lambda star: rounded(build(star.lines(*cols), **kw))


def _builders() -> dict[str, Builder]:
    a, v, c, q, s, d, w, m = analytics, views, cleaning, quality, stats, dashboard, workbook, metrics
    sp = ("sales", "profit")
    return {
        # the thirty questions
        "q01_executive_kpis": a.q01_executive_kpis,
        "q02_monthly_revenue": a.q02_monthly_revenue,
        "q03_yearly_growth": a.q03_yearly_growth,
        "q04_top_10_products_by_sales": a.q04_top_products_by_sales,
        "q05_worst_products_by_profit": a.q05_worst_products_by_profit,
        "q06_category_performance": a.q06_category_performance,
        "q07_subcategory_performance": a.q07_sub_category_performance,
        "q08_top_customers": a.q08_top_customers,
        "q09_customer_segments": a.q09_customer_segments,
        "q10_repeat_customers": a.q10_repeat_customers,
        "q11_region_performance": a.q11_region_performance,
        "q12_state_performance": a.q12_state_performance,
        "q13_daily_sales_pattern": a.q13_daily_sales_pattern,
        "q14_discount_impact": a.q14_discount_impact,
        "q15_monthly_running_total": a.q15_monthly_running_total,
        "q16_top_products_by_profit": a.q16_top_products_by_profit,
        "q17_bottom_products_by_sales": a.q17_bottom_products_by_sales,
        "q18_high_sales_low_profit": lambda x: a.q18_high_sales_low_profit(x, times_mean=1.3),
        "q19_quarterly_growth": a.q19_quarterly_growth,
        "q20_rolling_3month_sales": a.q20_rolling_sales,
        "q21_customer_lifetime_value": a.q21_customer_lifetime_value,
        "q22_rfm_segments": a.q22_rfm_segments,
        "q23_high_value_customers": a.q23_high_value_customers,
        "q24_top_cities_by_revenue": a.q24_top_cities,
        "q25_underperforming_states": a.q25_underperforming_states,
        "q26_shipping_mode_analysis": a.q26_shipping_mode_analysis,
        "q27_highest_discount_orders": a.q27_highest_discount_orders,
        "q28_segment_category_matrix": lambda x: a.q28_segment_category_matrix(x, CATEGORIES),
        "q29_weekend_vs_weekday": a.q29_weekend_vs_weekday,
        "q30_product_rank_within_category": a.q30_product_rank_within_category,
        # views and warehouse
        "u01_monthly_summary": v.monthly_summary,
        "u02_customer_360": v.customer_360,
        "u03_product_performance": v.product_performance,
        "u04_regional_summary": v.regional_summary,
        "u05_discount_analysis": v.discount_analysis,
        "u06_sales_detail": lambda x: v.sales_detail(feature_table(x)),
        "u07_dim_customer": lambda x: rounded(warehouse.dim_customer(v.profile_of(x))),
        "u08_dim_product": lambda x: warehouse.dim_product(
            x.lines("row_id", "product_id", "product_name", "category", "sub_category")
        ),
        "u09_dim_geography": geography_numbers,
        "u10_fact_sales": lambda x: rounded(fact_table(x)),
        "u11_orphans": fact_orphans,
        "u11_reconciliation": lambda x: warehouse.reconciliation(x.lines("sales", "profit", "order_id")),
        # features and customers
        "t01_t11_time_features": time_features,
        "f01_f07_value_features": value_features,
        "f06_sales_category": sales_categories,
        "f08_qcut_sales_quintile": sales_quintile,
        "f09_attach_customer_features": attached_customers,
        "s02_feature_table": lambda x: rounded(feature_table(x)),
        "p01_lifetime_totals": lifetime,
        "p02_p09_customer_profile": profile,
        "p04_high_value_flag": lambda x: scores(x, "lifetime_value", "is_high_value"),
        "p05_r_score": lambda x: scores(x, "recency_days", "r_score"),
        "p06_f_score": lambda x: scores(x, "lifetime_orders", "f_score"),
        "p07_m_score": lambda x: scores(x, "lifetime_value", "m_score"),
        "p08_rfm_segment": lambda x: scores(x, "rfm_score", "rfm_segment"),
        "p10_rfm_rollup": rfm_rollup,
        "p11_high_value_share": high_value_share,
        # cleaning
        "c01_prepared_extract": lambda x: c.prepare(raw_extract(x)),
        "c02_c03_complete_rows": lambda x: c.drop_incomplete(c.drop_shells(c.prepare(raw_extract(x)))),
        "c04_without_duplicates": lambda x: c.drop_duplicates(
            c.drop_incomplete(c.drop_shells(c.prepare(raw_extract(x))))
        ),
        "c05_c07_typed": lambda x: c.typed(raw_extract(x)),
        "c08_common_postal_codes": lambda x: c.Cleaning(raw_extract(x)).common_codes(),
        "c09_unresolved_postal": lambda x: c.unresolved_postal(c.clean(raw_extract(x))),
        "c10_cleaned": lambda x: c.clean(raw_extract(x)),
        "c11_ship_before_order": lambda x: c.ship_before_order(c.clean(raw_extract(x))),
        "c12_cleaning_audit": lambda x: c.cleaning_audit(raw_extract(x)),
        "c13_validated_totals": lambda x: c.validated_totals(c.clean(raw_extract(x))),
        "c14_shell_diagnosis": lambda x: c.shell_diagnosis(raw_extract(x)),
        "c05_unreadable_dates": unread_dates,
        # quality and statistics
        "k01_k16_rules": validation,
        "k16_rules_passed": lambda x: q.rules_passed(validation(x)),
        "k17_column_profile": lambda x: q.column_profile(c.prepare(raw_extract(x))),
        "k18_key_uniqueness": keys,
        "k19_outlier_summary": lambda x: q.outlier_summary(measure_lines(x)),
        "k20_outlier_rows": lambda x: q.outlier_rows(measure_lines(x)),
        "k20_outlier_share": lambda x: q.outlier_share(measure_lines(x)),
        "k21_shape": lambda x: s.shape(x.lines(*sp), sp),
        "k22_median_and_mean": lambda x: s.median_and_mean(x.lines("sales")),
        "k23_histogram_sales": histogram(("sales", lambda: F.col("sales")), 80),
        "k23_histogram_log_sales": histogram(("sales", lambda: s.log10_floor("sales")), 60),
        "k23_histogram_profit": histogram(("profit", lambda: F.col("profit")), 100),
        "k23_histogram_discount": histogram(("discount", lambda: F.col("discount") * 100), 25),
        "k24_five_numbers": lambda x: s.five_numbers(measure_lines(x), q.MEASURES),
        "k25_correlations": lambda x: s.correlations(x.lines(*s.CORRELATED)),
        "k25_correlations_with_profit": lambda x: s.correlations_with(x.lines(*s.CORRELATED)),
        "k26_discount_band_table": on_lines(s.discount_band_table, "discount_band", "is_loss", *sp),
        "k27_deep_discount_impact": on_lines(s.deep_discount_impact, "discount", "profit"),
        "k28_seasonality": on_lines(s.season_extremes, "order_month", "order_year", "sales"),
        "k29_loss_states": on_lines(s.loss_states, "state", "region", "discount", *sp),
        "k29_loss_state_discounts": on_lines(s.loss_state_discounts, "state", "region", "discount", *sp),
        "k30_extremes": on_lines(s.extremes, "row_id", "product_name", "discount", *sp),
        "k31_segments": on_lines(s.segment_comparison, "segment", "customer_id", "order_id", *sp),
        "k31_ship_modes": on_lines(s.ship_mode_comparison, "ship_mode", "shipping_days", "order_id", *sp),
        "k32_city_leaders": on_lines(s.city_leaders, "city", "state", *sp),
        "k32_category_shares": lambda x: rounded(s.category_shares(x.by_product("category", *sp))),
        "k32_sub_categories": on_lines(s.sub_category_table, "sub_category", "discount", *sp),
        "k33_yearly_summary": on_lines(s.yearly_summary, "order_year", "order_id", *sp),
        "k34_region_summary": on_lines(s.region_summary, "region", "discount", *sp),
        "k34_top_products": lambda x: s.top_by(
            x.by_product("product_name", "sales"), key="product_name", measure="sales", k=10, label_chars=32
        ),
        "k34_top_customers": lambda x: s.top_by(
            x.by_customer("customer_name", "sales"), key="customer_name", measure="sales", k=10
        ),
        "a03_sketched_counts": sketched_counts,
        "a13_sketched_quantiles": sketched_quantiles,
        "l09_scatter_sample": lambda x: s.scatter_sample(x.lines("row_id", "discount", "profit")),
        "w08_rolling_mean": lambda x: s.rolling_mean(s.monthly_totals(x.lines("year_month", *sp))),
        # exported aggregates
        "s10_agg_monthly": on_lines(s.monthly_totals, "year_month", *sp),
        "s10_agg_yearly": on_lines(s.yearly_summary, "order_year", "order_id", *sp),
        "s10_agg_region": on_lines(s.region_summary, "region", "discount", *sp),
        "s10_agg_forecast": lambda x: band_of(x),
        "s10_agg_discount_sim": caps,
        "s12_agg_category": on_lines(s.agg_category, "category", "order_id", *sp),
        "s12_agg_discount": on_lines(s.agg_discount, "discount_band", *sp),
        "s12_agg_region": on_lines(s.agg_region, "region", "order_id", "customer_id", "discount", *sp),
        "s12_agg_state": on_lines(s.agg_state, "state", *sp),
        "s12_agg_subcategory": on_lines(s.agg_sub_category, "category", "sub_category", "discount", *sp),
        # forecast and scenario
        "g01_forecast_total": lambda x: forecast_of(x),
        "g01_forecast_by_region": lambda x: forecast_of(x, "region"),
        "g01_forecast_by_product": lambda x: forecast_of(x, "product_id"),
        "g02_backtest_total": lambda x: backtest_of(x),
        "g02_backtest_by_region": lambda x: backtest_of(x, "region"),
        "g03_forecast_band_total": lambda x: band_of(x),
        "g03_forecast_band_by_region": lambda x: band_of(x, "region"),
        "g04_discount_caps": caps,
        "g05_interactive_caps": lambda x: scenario.interactive_caps(x.lines("discount", *sp)),
        # measures
        "b01_totals": lambda x: kpi_measures(x, "total_sales", "total_profit", "units_sold"),
        "b02_profit_margin": lambda x: rounded(m.measure(x.by_product("category", *sp), ["profit_margin"], ["category"])),
        "b03_orders_customers": lambda x: kpi_measures(x, "total_orders", "total_customers", by=("region",)),
        "b04_avg_order_value": lambda x: kpi_measures(x, "avg_order_value", by=("segment",)),
        "b05_calendar": lambda x: m.calendar(x.lines("order_date")),
        "b05_calendar_sales": lambda x: m.calendar_sales(x.lines("order_date", "order_id", "sales")),
        "b06_prior_year": prior_year,
        "b07_b08_running_sales": on_lines(m.running_sales, "order_year", "year_month", "sales"),
        "b09_product_rank": lambda x: m.sales_rank(x.by_product("product_name", "sales"), "product_name"),
        "b09_customer_rank": lambda x: m.sales_rank(x.by_customer("customer_name", "sales"), "customer_name"),
        "b10_share_of_selection": lambda x: rounded(
            m.share_of_selection(
                x.lines("category", "region", "sales"), ["category"], m.slicer(region=["ASIA", "EUROPE"])
            )
        ),
        "b11_deep_discount": lambda x: kpi_measures(
            x, "deep_discount_loss", "deep_discount_line_share", by=("region",)
        ),
        "b12_prior_month_by_state": prior_month,
        "b06_prior_year_sliced": prior_year_sliced,
        "b07_b08_running_sales_sliced": running_sliced,
        "b09_customer_rank_sliced": rank_sliced,
        "b07_range_totals": totals_of_ranges,
        "b06_running_comparison": running_comparison,
        "b13_baskets": lambda x: kpi_measures(x, "avg_basket_size", "avg_lines_per_order", by=("segment",)),
        "b14_rank_in_scope": lambda x: m.rank_in_scope(x.by_product("product_name", "sales"), "product_name"),
        "b15_exposure": lambda x: kpi_measures(x, "recoverable_profit", "loss_making_lines", by=("category",)),
        "b16_simulated_profit": simulated_by_region,
        "b17_top_n_customers": lambda x: m.top_n(x.by_customer("customer_name", "sales"), "customer_name", 5),
        **{
            f"b18_{short}_{part}": lambda x, key=key, f=f: busiest(x, key, f)
            for short, key in (("product", "product_name"), ("customer", "customer_name"), ("state", "state"))
            for part, f in (("detail", m.detail_kpis), ("trend", m.detail_trend), ("orders", m.detail_orders))
        },
        "b19_state_trend": on_lines(m.state_trend, "state", "year_month", *sp),
        "l02_sliced_measures": sliced_measures,
        # dashboard
        "d01_kpi_cards": on_lines(d.kpi_cards, "order_id", "customer_id", "order_year", *sp),
        "d02_calendar_months": on_lines(d.calendar_months, "order_month", *sp),
        "d03_category_share": lambda x: d.share_of_sales(x.by_product("category", "sales"), "category"),
        "d03_segment_share": lambda x: d.share_of_sales(x.lines("segment", "sales"), "segment"),
        "d04_top_products": lambda x: d.leaders(x.by_product("product_name", "sales"), "product_name", "sales"),
        "d04_top_customers": lambda x: d.leaders(x.by_customer("customer_name", "sales"), "customer_name", "sales"),
        "d04_top_sub_categories": lambda x: d.leaders(x.by_product("sub_category", "profit"), "sub_category", "profit"),
        "d05_region_table": on_lines(d.region_table, "region", "order_id", "customer_id", *sp),
        "d06_state_sales": lambda x: d.state_sales(x.lines("state", "sales"), state_codes(x)),
        "d07_as_of": on_lines(d.as_of, "order_date"),
        "d08_month_signs": on_lines(d.month_signs, "year_month", "profit"),
        "s09_dashboard_payload": payload,
        "x15_display_strings": displayed,
        # workbook
        "e01_kpis": on_lines(w.kpis, "order_id", "customer_name", "quantity", *sp),
        "e02_category_table": lambda x: rounded(
            w.fixed_table(x.by_product("category", *sp), "category", ["STANDARD", "ECONOMY", "LUXURY"])
        ),
        "e03_monthly_grid": on_lines(w.monthly_grid, "order_year", "order_month", *sp),
        "e04_region_sheet": on_lines(w.region_sheet, "region", *sp),
        "e04_segment_table": lambda x: rounded(w.fixed_table(x.lines("segment", *sp), "segment", SEGMENTS)),
        "e05_top_customers": lambda x: rounded(w.top_customers(x.by_customer("customer_name", *sp))),
        "s11_flat_projection": lambda x: w.flat_projection(x.lines(*w.FLAT_COLS)),
    }


def _bind(build: Builder) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return decimals_to_double(build(OrderTables(configure(spark), folder)))

    return run


QUERIES = {name: _bind(build) for name, build in _builders().items()}
