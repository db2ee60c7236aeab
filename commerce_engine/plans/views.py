"""Reusable views over the star: one function per view, money kept in DECIMAL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import margin_pct, mean_pct, money, percent, ratio, rnd
from ..operators.customers import PROFILE_INPUTS, customer_profile
from ..sources.star import Star


def monthly_summary(star: Star) -> DataFrame:
    lines = star.lines(
        "year_month", "order_year", "order_month", "order_id", "customer_id", "sales", "profit", "quantity", "discount"
    )
    orders = F.count_distinct("order_id")
    return lines.groupBy("year_month", "order_year", "order_month").agg(
        money("sales").alias("sales"),
        money("profit").alias("profit"),
        margin_pct().alias("margin_pct"),
        orders.alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        F.sum("quantity").alias("units"),
        mean_pct("discount", 2).alias("avg_discount_pct"),
        rnd(ratio(F.sum("sales"), orders), 2).alias("avg_order_value"),
    )


def profile_of(star: Star) -> DataFrame:
    return customer_profile(star.lines(*PROFILE_INPUTS))


def customer_360(star: Star, profile: DataFrame | None = None) -> DataFrame:
    """Lifetime attributes next to what each customer's lines show.

    Lines are aggregated by customer before the join, so the profile meets one
    row per customer however many lines that customer has.
    """
    bought = (
        star.lines("customer_id", "product_id", "state", "discount")
        .groupBy("customer_id")
        .agg(
            F.count_distinct("product_id").alias("distinct_products"),
            F.count_distinct("state").alias("states_shipped_to"),
            mean_pct("discount", 2).alias("avg_discount_pct"),
        )
    )
    return customer_values(profile_of(star) if profile is None else profile).join(bought, "customer_id")


def customer_values(profile: DataFrame) -> DataFrame:
    return profile.select(
        "customer_id",
        "customer_name",
        "segment",
        "lifetime_orders",
        F.round("lifetime_value", 2).alias("lifetime_value"),
        F.round("lifetime_profit", 2).alias("lifetime_profit"),
        rnd(F.col("avg_order_value"), 2).alias("avg_order_value"),
        "recency_days",
        "rfm_score",
        "rfm_segment",
        F.col("is_repeat").cast("int").alias("is_repeat"),
        F.col("is_high_value").cast("int").alias("is_high_value"),
    )


def product_totals(star: Star) -> DataFrame:
    """One row per sold product, aggregated before any product attribute is joined."""
    lines = star.lines("product_id", "order_id", "sales", "profit", "quantity", "discount")
    margin = percent(F.sum("profit"), F.sum("sales"))
    return lines.groupBy("product_id").agg(
        money("sales").alias("sales"),
        money("profit").alias("profit"),
        rnd(margin, 2).alias("margin_pct"),
        F.sum("quantity").alias("units"),
        F.count_distinct("order_id").alias("orders"),
        mean_pct("discount", 2).alias("avg_discount_pct"),
        F.when(F.sum("profit") < 0, "Loss making")
        .when(margin < 5, "Thin margin")
        .when(margin < 20, "Healthy")
        .otherwise("Strong")
        .alias("health_flag"),
    )


def product_performance(star: Star) -> DataFrame:
    return product_totals(star).join(star.products(), "product_id").select(
        "product_id", "product_name", "category", "sub_category", "sales", "profit", "margin_pct", "units", "orders",
        "avg_discount_pct", "health_flag",
    )


def regional_summary(star: Star) -> DataFrame:
    lines = star.lines("region", "state", "city", "order_id", "customer_id", "sales", "profit", "discount")
    return lines.groupBy("region", "state", "city").agg(
        money("sales").alias("sales"),
        money("profit").alias("profit"),
        margin_pct().alias("margin_pct"),
        F.count_distinct("order_id").alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        mean_pct("discount", 2).alias("avg_discount_pct"),
    )


def discount_analysis(star: Star) -> DataFrame:
    lines = star.lines("discount_band", "category", "sales", "profit", "is_loss")
    return lines.groupBy("discount_band", "category").agg(
        F.count("*").alias("order_lines"),
        money("sales").alias("sales"),
        money("profit").alias("profit"),
        margin_pct().alias("margin_pct"),
        F.count_if("is_loss").alias("loss_making_lines"),
    )


DETAIL_COLS = [
    "row_id", "order_id", "order_date", "ship_date", "ship_mode", "shipping_days", "customer_id", "customer_name",
    "segment", "product_id", "product_name", "category", "sub_category", "region", "state", "city", "postal_code",
    "lifetime_orders", "is_high_value", "rfm_segment", "sales", "quantity", "discount", "profit", "discount_band",
    "sales_category", "is_weekend_order", "is_loss", "profit_margin_pct", "order_year", "year_month",
]


def sales_detail(features: DataFrame) -> DataFrame:
    """The flat four-way detail from the feature table."""
    margin = rnd(percent(F.col("profit"), F.col("sales")), 2)
    flags = {c: F.col(c).cast("int") for c in ("is_high_value", "is_weekend_order", "is_loss")}
    return features.withColumns({**flags, "profit_margin_pct": margin}).select(*DETAIL_COLS)


def register(star: Star, profile: DataFrame | None = None) -> None:
    """Make the aggregate views available to Spark SQL; a profile that is there already is not built again."""
    for name, build in {
        "vw_monthly_summary": monthly_summary,
        "vw_customer_360": lambda s: customer_360(s, profile),
        "vw_product_performance": product_performance,
        "vw_regional_summary": regional_summary,
        "vw_discount_analysis": discount_analysis,
    }.items():
        build(star).createOrReplaceTempView(name)
