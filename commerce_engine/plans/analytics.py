"""The thirty business questions, each a function of the star.

A ranking that keeps k rows takes the k rows first and numbers those: a rank
depends only on rows ahead of it, so no window ever sees the whole set. Names of
products and customers join after the rows have been reduced to keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import dbl, margin_pct, mean, mean_pct, money, percent, ratio, rnd, share
from ..sources.star import Star
from . import views


def total(c: str) -> Column:
    """The sum over all (already grouped) rows."""
    return F.sum(c).over(Window.partitionBy())


def q01_executive_kpis(star: Star) -> DataFrame:
    orders = F.count_distinct("order_id")
    return star.lines("sales", "profit", "order_id", "customer_id", "quantity").agg(
        money("sales").alias("total_sales"),
        money("profit").alias("total_profit"),
        margin_pct().alias("profit_margin_pct"),
        orders.alias("total_orders"),
        F.count_distinct("customer_id").alias("total_customers"),
        F.sum("quantity").alias("units_sold"),
        rnd(ratio(F.sum("sales"), orders), 2).alias("avg_order_value"),
    )


def q02_monthly_revenue(star: Star) -> DataFrame:
    by = star.lines("year_month", "sales", "profit", "order_id").groupBy("year_month")
    return by.agg(
        money("sales").alias("sales"), money("profit").alias("profit"), F.count_distinct("order_id").alias("orders")
    ).orderBy("year_month")


def q03_yearly_growth(star: Star) -> DataFrame:
    yearly = (
        star.lines("order_year", "sales", "profit", "order_id")
        .groupBy("order_year")
        .agg(
            F.sum("sales").alias("sales"), F.sum("profit").alias("profit"), F.count_distinct("order_id").alias("orders")
        )
    )
    before = F.lag("sales").over(Window.orderBy("order_year"))
    return yearly.select(
        "order_year",
        F.round("sales", 2).alias("sales"),
        F.round("profit", 2).alias("profit"),
        F.round(before, 2).alias("prev_year_sales"),
        rnd(percent(F.col("sales") - before, before), 2).alias("yoy_growth_pct"),
        "orders",
    ).orderBy("order_year")


def q04_top_products_by_sales(star: Star, k: int = 10) -> DataFrame:
    lines = star.lines("product_id", "sales", "profit", "quantity")
    totals = lines.groupBy("product_id").agg(
        money("sales").alias("sales"),
        money("profit").alias("profit"),
        margin_pct().alias("margin_pct"),
        F.sum("quantity").alias("units"),
    )
    top = totals.orderBy(F.desc("sales"), "product_id").limit(k)
    return (
        top.join(star.products(), "product_id")
        .orderBy(F.desc("sales"), "product_id")
        .select("product_name", "category", "sub_category", "sales", "profit", "margin_pct", "units")
    )


def q05_worst_products_by_profit(star: Star, k: int = 10) -> DataFrame:
    lines = star.lines("product_id", "sales", "profit", "discount")
    totals = lines.groupBy("product_id").agg(
        money("sales").alias("sales"), money("profit").alias("profit"), mean_pct("discount", 1).alias("avg_discount_pct")
    )
    worst = totals.where("profit < 0").orderBy("profit", "product_id").limit(k)
    return (
        worst.join(star.products(), "product_id")
        .orderBy("profit", "product_id")
        .select("product_name", "sub_category", "sales", "profit", "avg_discount_pct")
    )


def q06_category_performance(star: Star) -> DataFrame:
    return (
        star.lines("category", "sales", "profit", "order_id")
        .groupBy("category")
        .agg(
            F.sum("sales").alias("total"),
            money("sales").alias("sales"),
            money("profit").alias("profit"),
            margin_pct().alias("margin_pct"),
            F.count_distinct("order_id").alias("orders"),
        )
        .withColumn("pct_of_sales", share(F.col("total"), total("total")))
        .select("category", "sales", "pct_of_sales", "profit", "margin_pct", "orders")
        .orderBy(F.desc("sales"), "category")
    )


def q07_sub_category_performance(star: Star) -> DataFrame:
    return (
        star.lines("category", "sub_category", "sales", "profit", "discount")
        .groupBy("category", "sub_category")
        .agg(
            money("sales").alias("sales"),
            money("profit").alias("profit"),
            margin_pct().alias("margin_pct"),
            mean_pct("discount", 1).alias("avg_discount_pct"),
        )
        .orderBy("profit", "category", "sub_category")
    )


def q08_top_customers(star: Star, k: int = 10) -> DataFrame:
    orders = F.count_distinct("order_id")
    totals = (
        star.lines("customer_id", "order_id", "sales", "profit")
        .groupBy("customer_id")
        .agg(
            money("sales").alias("sales"),
            money("profit").alias("profit"),
            orders.alias("orders"),
            rnd(ratio(F.sum("sales"), orders), 2).alias("avg_order_value"),
        )
    )
    top = totals.orderBy(F.desc("sales"), "customer_id").limit(k)
    ranked = top.withColumn("rank", F.rank().over(Window.orderBy(F.desc("sales"))).cast("bigint"))
    return (
        ranked.join(star.customers(), "customer_id")
        .orderBy("rank", "customer_id")
        .select("rank", "customer_name", "segment", "sales", "profit", "orders", "avg_order_value")
    )


def q09_customer_segments(star: Star) -> DataFrame:
    orders = F.count_distinct("order_id")
    return (
        star.lines("segment", "customer_id", "order_id", "sales", "profit")
        .groupBy("segment")
        .agg(
            F.count_distinct("customer_id").alias("customers"),
            orders.alias("orders"),
            F.sum("sales").alias("total"),
            money("sales").alias("sales"),
            money("profit").alias("profit"),
            rnd(ratio(F.sum("sales"), orders), 2).alias("avg_order_value"),
        )
        .withColumn("pct_of_sales", share(F.col("total"), total("total")))
        .select("segment", "customers", "orders", "sales", "pct_of_sales", "profit", "avg_order_value")
        .orderBy(F.desc("sales"), "segment")
    )


def q10_repeat_customers(star: Star) -> DataFrame:
    per_customer = (
        star.lines("customer_id", "order_id", "sales")
        .groupBy("customer_id")
        .agg(F.count_distinct("order_id").alias("orders"), F.sum("sales").alias("sales"))
    )
    kind = F.when(F.col("orders") == 1, "One-time").otherwise("Repeat")
    by = per_customer.groupBy(kind.alias("customer_type")).agg(
        F.count("*").alias("customers"), F.sum("sales").alias("sales"), rnd(mean("orders"), 2).alias("avg_orders")
    )
    return by.select(
        "customer_type",
        "customers",
        share(F.col("customers"), total("customers")).alias("pct_of_customers"),
        F.round("sales", 2).alias("sales"),
        share(F.col("sales"), total("sales")).alias("pct_of_sales"),
        "avg_orders",
    ).orderBy(F.desc("sales"))


def q11_region_performance(star: Star) -> DataFrame:
    return (
        star.lines("region", "sales", "profit", "order_id", "customer_id", "discount")
        .groupBy("region")
        .agg(
            money("sales").alias("sales"),
            money("profit").alias("profit"),
            F.count_distinct("order_id").alias("orders"),
            F.count_distinct("customer_id").alias("customers"),
            margin_pct().alias("profit_margin_pct"),
            mean_pct("discount", 1).alias("avg_discount_pct"),
        )
        .orderBy(F.desc("sales"), "region")
    )


def q12_state_performance(star: Star) -> DataFrame:
    return (
        star.lines("state", "region", "sales", "profit", "order_id")
        .groupBy("state", "region")
        .agg(
            money("sales").alias("sales"),
            money("profit").alias("profit"),
            margin_pct().alias("margin_pct"),
            F.count_distinct("order_id").alias("orders"),
        )
        .orderBy(F.desc("sales"), "state")
    )


def q13_daily_sales_pattern(star: Star) -> DataFrame:
    return (
        star.lines("order_day_name", "order_id", "sales")
        .groupBy(F.col("order_day_name").alias("day_of_week"))
        .agg(
            F.count_distinct("order_id").alias("orders"),
            money("sales").alias("sales"),
            rnd(mean("sales"), 2).alias("avg_line_value"),
        )
        .orderBy(F.desc("sales"), "day_of_week")
    )


def q14_discount_impact(star: Star) -> DataFrame:
    """Bands by threshold only: negatives fall into the first band, nulls into the last."""
    d = dbl("discount")
    band = (  # fixed values: bands of the question
        F.when(d == 0, "No discount")
        .when(d <= 0.15, "1-15%")
        .when(d <= 0.30, "16-30%")
        .when(d <= 0.50, "31-50%")
        .otherwise("50%+")
    )
    return (
        star.lines("discount", "sales", "profit")
        .groupBy(band.alias("discount_band"))
        .agg(
            F.count("*").alias("order_lines"),
            money("sales").alias("sales"),
            money("profit").alias("profit"),
            margin_pct().alias("margin_pct"),
        )
        .orderBy(F.desc("margin_pct"), "discount_band")
    )


def q15_monthly_running_total(star: Star) -> DataFrame:
    monthly = (
        star.lines("order_year", "year_month", "sales")
        .groupBy(F.col("order_year").cast("string").alias("order_year"), "year_month")
        .agg(F.sum("sales").alias("total"))
    )
    ytd = F.sum("total").over(Window.partitionBy("order_year").orderBy("year_month"))
    return monthly.select(
        "order_year", "year_month", F.round("total", 2).alias("monthly_sales"), F.round(ytd, 2).alias("running_total_ytd")
    ).orderBy("year_month")


def q16_top_products_by_profit(star: Star, k: int = 10) -> DataFrame:
    top = views.product_totals(star).orderBy(F.desc("profit"), "product_id").limit(k)
    return (
        top.join(star.products(), "product_id")
        .orderBy(F.desc("profit"), "product_id")
        .select("product_name", "category", "sub_category", "sales", "profit", "margin_pct", "units")
    )


def q17_bottom_products_by_sales(star: Star, k: int = 10, min_orders: int = 2) -> DataFrame:
    low = views.product_totals(star).where(F.col("orders") >= min_orders).orderBy("sales", "product_id").limit(k)
    return (
        low.join(star.products(), "product_id")
        .orderBy("sales", "product_id")
        .select("product_name", "sub_category", "sales", "profit", "orders")
    )


def q18_high_sales_low_profit(star: Star, k: int = 15, times_mean: float = 3, below_margin: float = 5) -> DataFrame:
    """Products above a multiple of mean product sales with a thin margin."""
    totals = views.product_totals(star)
    average = totals.agg(mean("sales")).scalar()
    low = (
        totals.where((dbl("sales") > average * times_mean) & (F.col("margin_pct") < below_margin))
        .orderBy(F.desc("sales"), "product_id")
        .limit(k)
    )
    return (
        low.join(star.products(), "product_id")
        .orderBy(F.desc("sales"), "product_id")
        .select("product_name", "category", "sales", "profit", "margin_pct", "avg_discount_pct", "health_flag")
    )


def q19_quarterly_growth(star: Star) -> DataFrame:
    by = (
        star.lines("year_quarter", "sales", "profit")
        .groupBy(F.col("year_quarter").alias("quarter"))
        .agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))
    )
    before = F.lag("sales").over(Window.orderBy("quarter"))
    return by.select(
        "quarter",
        F.round("sales", 2).alias("sales"),
        F.round("profit", 2).alias("profit"),
        F.round(before, 2).alias("prev_quarter"),
        rnd(percent(F.col("sales") - before, before), 2).alias("qoq_growth_pct"),
    ).orderBy("quarter")


def q20_rolling_sales(star: Star) -> DataFrame:
    """Moving averages of the rounded monthly sales; frames are partial at the start."""
    monthly = star.lines("year_month", "sales").groupBy("year_month").agg(money("sales").alias("sales"))
    order = Window.orderBy("year_month")

    def average(months: int):
        frame = order.rowsBetween(1 - months, 0)
        return rnd(ratio(F.sum("sales").over(frame), F.count("sales").over(frame)), 2)

    return monthly.select(
        "year_month", "sales", average(3).alias("rolling_3m_avg"), average(6).alias("rolling_6m_avg")
    ).orderBy("year_month")


def q21_customer_lifetime_value(star: Star, k: int = 20, profile: DataFrame | None = None) -> DataFrame:
    values = views.customer_values(views.profile_of(star) if profile is None else profile)
    top = values.orderBy(F.desc("lifetime_value"), "customer_id").limit(k)
    rank = F.dense_rank().over(Window.orderBy(F.desc("lifetime_value"))).cast("bigint")
    return (
        top.withColumn("clv_rank", rank)
        .orderBy("clv_rank", "customer_id")
        .select(
            "clv_rank", "customer_name", "segment", "lifetime_orders", "lifetime_value", "lifetime_profit",
            "avg_order_value", "rfm_segment",
        )
    )


def q22_rfm_segments(star: Star, profile: DataFrame | None = None) -> DataFrame:
    values = views.customer_values(views.profile_of(star) if profile is None else profile)
    by = values.groupBy("rfm_segment").agg(
        F.count("*").alias("customers"),
        F.sum("lifetime_value").alias("revenue"),
        rnd(mean("lifetime_orders"), 1).alias("avg_orders"),
        rnd(mean("recency_days"), 0).alias("avg_recency_days"),
    )
    return by.select(
        "rfm_segment",
        "customers",
        share(F.col("customers"), total("customers")).alias("pct_customers"),
        F.round("revenue", 2).alias("revenue"),
        share(F.col("revenue"), total("revenue")).alias("pct_revenue"),
        "avg_orders",
        "avg_recency_days",
    ).orderBy(F.desc("revenue"))


def q23_high_value_customers(star: Star, profile: DataFrame | None = None) -> DataFrame:
    values = views.customer_values(views.profile_of(star) if profile is None else profile)
    # The two tiers.
    tier = F.when(F.col("is_high_value") == 1, "High value (top 20%)").otherwise("Standard")
    by = values.groupBy(tier.alias("tier")).agg(
        F.count("*").alias("customers"),
        F.sum("lifetime_value").alias("revenue"),
        rnd(mean(F.col("avg_order_value").cast("decimal(20,2)")), 2).alias("avg_order_value"),
        rnd(mean("lifetime_orders"), 1).alias("avg_orders"),
    )
    return by.select(
        "tier",
        "customers",
        F.round("revenue", 2).alias("revenue"),
        share(F.col("revenue"), total("revenue")).alias("pct_revenue"),
        "avg_order_value",
        "avg_orders",
    ).orderBy(F.desc("revenue"))


def q24_top_cities(star: Star, k: int = 15) -> DataFrame:
    return (
        views.regional_summary(star)
        .groupBy("city", "state", "region")
        .agg(
            money("sales").alias("sales"),
            money("profit").alias("profit"),
            margin_pct().alias("margin_pct"),
            F.sum("orders").alias("orders"),
        )
        .orderBy(F.desc("sales"), "city", "state")
        .limit(k)
    )


def q25_underperforming_states(star: Star) -> DataFrame:
    """Average discount is the unweighted mean of the rounded city means."""
    by = (
        views.regional_summary(star)
        .groupBy("state", "region")
        .agg(
            money("sales").alias("sales"),
            money("profit").alias("profit"),
            margin_pct().alias("margin_pct"),
            rnd(mean(F.col("avg_discount_pct").cast("decimal(10,2)")), 1).alias("avg_discount_pct"),
        )
    )
    return by.where("profit < 0").orderBy("profit", "state")


def q26_shipping_mode_analysis(star: Star) -> DataFrame:
    return (
        star.lines("ship_mode", "order_id", "shipping_days", "is_delayed", "sales", "profit")
        .groupBy("ship_mode")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            rnd(mean("shipping_days"), 1).alias("avg_days"),
            money("sales").alias("sales"),
            money("profit").alias("profit"),
            margin_pct().alias("margin_pct"),
            rnd(percent(F.count_if("is_delayed"), F.count("*")), 1).alias("pct_beyond_sla"),
        )
        .orderBy(F.desc("margin_pct"), "ship_mode")
    )


def q27_highest_discount_orders(star: Star, k: int = 15) -> DataFrame:
    """The k deepest-discounted lines; product names join to those k rows only."""
    lines = star.lines("row_id", "order_id", "order_date", "customer_name", "product_id", "discount", "sales", "profit")
    order = [F.desc("discount"), F.asc("profit"), F.asc("row_id")]
    deepest = lines.orderBy(*order).limit(k)
    return (
        deepest.join(star.products().select("product_id", "product_name"), "product_id")
        .orderBy(*order)
        .select(
            "order_id",
            "order_date",
            "customer_name",
            "product_name",
            rnd(dbl("discount") * 100, 0).alias("discount_pct"),
            F.round("sales", 2).alias("sales"),
            F.round("profit", 2).alias("profit"),
        )
    )


def q28_segment_category_matrix(star: Star, categories: Sequence[str]) -> DataFrame:
    def name(category: str) -> str:
        return category.lower().replace(" ", "_")

    cells = [
        F.round(F.sum(F.when(F.col("category") == c, F.col("sales")).otherwise(0)), 2).alias(name(c)) for c in categories
    ]
    return (
        star.lines("segment", "category", "sales", "profit")
        .groupBy("segment")
        .agg(*cells, money("sales").alias("total_sales"), margin_pct().alias("margin_pct"))
        .orderBy(F.desc("total_sales"), "segment")
    )


def q29_weekend_vs_weekday(star: Star) -> DataFrame:
    orders = F.count_distinct("order_id")
    kind = F.when(F.col("is_weekend_order"), "Weekend").otherwise("Weekday")
    return (
        star.lines("is_weekend_order", "order_id", "sales", "profit", "discount")
        .groupBy(kind.alias("day_type"))
        .agg(
            orders.alias("orders"),
            money("sales").alias("sales"),
            rnd(ratio(F.sum("sales"), orders), 2).alias("avg_order_value"),
            margin_pct().alias("margin_pct"),
            mean_pct("discount", 1).alias("avg_discount_pct"),
        )
    )


def q30_product_rank_within_category(star: Star, k: int = 5) -> DataFrame:
    """Top k per category by sales, with their rank by profit.

    The sales rank is limited before the shuffle (group limit). The profit rank of
    those few is a count of the products ahead of them, combined on the map side,
    so no task has to hold a whole category.
    """
    lines = star.by_product("category", "product_name", "sales", "profit").groupBy("category", "product_name")
    totals = lines.agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))
    by_sales = F.rank().over(Window.partitionBy("category").orderBy(F.desc("sales")))
    top = totals.withColumn("sales_rank", by_sales.cast("bigint")).where(F.col("sales_rank") <= k)
    bars = top.groupBy("category").agg(F.collect_set("profit").alias("bars"))
    ahead = (
        totals.join(bars, "category")
        .select("category", "profit", F.explode(F.filter("bars", lambda b: b < F.col("profit"))).alias("bar"))
        .groupBy("category", F.col("bar").alias("profit"))
        .agg(F.count("*").alias("ahead"))
    )
    rank = F.coalesce("ahead", F.lit(0)) + 1
    return (
        top.join(ahead, ["category", "profit"], "left")
        .select(
            "category",
            "product_name",
            F.round("sales", 2).alias("sales"),
            F.round("profit", 2).alias("profit"),
            "sales_rank",
            rank.alias("profit_rank"),
            (rank - F.col("sales_rank")).alias("rank_gap"),
        )
        .orderBy("category", "sales_rank", "product_name")
    )


QUESTIONS = {
    f.__name__: f
    for f in (
        q01_executive_kpis,
        q02_monthly_revenue,
        q03_yearly_growth,
        q04_top_products_by_sales,
        q05_worst_products_by_profit,
        q06_category_performance,
        q07_sub_category_performance,
        q08_top_customers,
        q09_customer_segments,
        q10_repeat_customers,
        q11_region_performance,
        q12_state_performance,
        q13_daily_sales_pattern,
        q14_discount_impact,
        q15_monthly_running_total,
        q16_top_products_by_profit,
        q17_bottom_products_by_sales,
        q18_high_sales_low_profit,
        q19_quarterly_growth,
        q20_rolling_sales,
        q21_customer_lifetime_value,
        q22_rfm_segments,
        q23_high_value_customers,
        q24_top_cities,
        q25_underperforming_states,
        q26_shipping_mode_analysis,
        q27_highest_discount_orders,
        q28_segment_category_matrix,
        q29_weekend_vs_weekday,
        q30_product_rank_within_category,
    )
}
