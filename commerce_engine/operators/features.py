"""Per-line features: calendar, value and banding columns, and customer attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import cut, dbl, ratio
from ..functions.quantiles import quantile_edges

SLA_DAYS = 5

# Band labels in their natural order.
DISCOUNT_BANDS = ["No discount", "1-15%", "16-30%", "31-50%", "50%+"]
SALES_CATEGORIES = ["Small", "Medium", "Large", "Very Large"]
MARGIN_BANDS = ["Loss", "Low (0-10%)", "Healthy (10-25%)", "Strong (25%+)"]

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

CUSTOMER_FEATURES = ["lifetime_orders", "lifetime_value", "is_high_value", "is_repeat", "rfm_segment"]


def false_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def name_at(names: Sequence[str], position: Column) -> Column:
    """The name at a 1-based position: a look-up in a literal, where formatting a date costs many times as much.

    In ANSI mode Spark takes an element of an array without nulls as never null, so a
    missing position is kept from it.
    """
    return F.when(position.isNotNull(), F.element_at(F.array(*[F.lit(x) for x in names]), position))


def add_time_features(df: DataFrame, sla_days: int = SLA_DAYS, only: Sequence[str] | None = None) -> DataFrame:
    """Calendar parts of order_date and, where ship_date is present, shipping speed."""

    def quarter(d: Column) -> Column:
        return F.concat(F.lit("Q"), F.quarter(d).cast("string"))

    d, ship = F.col("order_date"), F.col("ship_date")
    of_order = {
        "order_year": lambda: F.year(d),
        "order_month": lambda: F.month(d),
        "order_month_name": lambda: name_at(MONTHS, F.month(d)),
        "order_quarter": lambda: quarter(d),
        "order_quarter_num": lambda: F.quarter(d),
        "year_month": lambda: F.date_format(d, "yyyy-MM"),
        "year_quarter": lambda: F.concat_ws("-", F.year(d).cast("string"), quarter(d)),
        "order_day_name": lambda: name_at(WEEKDAYS, F.weekday(d) + 1),
        "order_week": lambda: F.weekofyear(d),
        "is_weekend_order": lambda: false_if_null(F.weekday(d) >= 5),
    }
    of_ship = {"processing_month": lambda: name_at(MONTHS, F.month(ship))}
    of_both = {
        "shipping_days": lambda: F.datediff(ship, d),
        "is_delayed": lambda: false_if_null(F.datediff(ship, d) > sla_days),
    }
    has_order, has_ship = "order_date" in df.columns, "ship_date" in df.columns
    new = (of_order if has_order else {}) | (of_ship if has_ship else {}) | (of_both if has_order and has_ship else {})
    return df.withColumns({c: build() for c, build in new.items() if only is None or c in only})


def discount_band(c: Column) -> Column:
    """Right-closed bands; a discount outside (-1%, 100%] has no band."""
    return cut(dbl(c), [F.lit(e) for e in (-0.01, 0.0, 0.15, 0.30, 0.50, 1.0)], DISCOUNT_BANDS)


def margin_band(c: Column) -> Column:
    inf = float("inf")
    return cut(dbl(c), [F.lit(e) for e in (-inf, 0.0, 10.0, 25.0, inf)], MARGIN_BANDS)


def list_price(sales: Column, discount: Column) -> Column:
    """Undiscounted line value; a full discount leaves the sales value."""
    return F.when(dbl(discount) < 1, F.try_divide(dbl(sales), 1 - dbl(discount))).otherwise(dbl(sales))


def add_value_features(df: DataFrame) -> DataFrame:
    """Ratios, flags and bands for whichever of the measures the input carries."""
    has = set(df.columns)
    sales, profit, discount, quantity = (F.col(c) for c in ("sales", "profit", "discount", "quantity"))
    new: dict[str, Column] = {}
    if {"sales", "profit"} <= has:
        margin = ratio(profit, sales) * 100
        new |= {"profit_margin": margin, "margin_band": margin_band(margin)}
    if {"sales", "quantity"} <= has:
        new["unit_price"] = ratio(sales, quantity)
    if "profit" in has:
        new["is_loss"] = false_if_null(profit < 0)
    if "discount" in has:
        new |= {"is_discounted": false_if_null(discount > 0), "discount_band": discount_band(discount)}
    if {"sales", "discount"} <= has:
        new["discount_value"] = F.when(dbl(discount) < 1, list_price(sales, discount) - dbl(sales)).otherwise(0.0)
    return df.withColumns(new)


def sales_category(c: Column, quartiles: Sequence[Column], top: Column) -> Column:
    return cut(dbl(c), [F.lit(-0.01), *quartiles, dbl(top)], SALES_CATEGORIES)


def add_sales_category(df: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """Size bands cut on the whole table's quartiles.

    ``measures`` may be a cheaper frame with the same ``sales`` values (for
    example before any join); the edges reach the plan as scalar subqueries.
    """
    source = df if measures is None else measures
    edges = quantile_edges(source, "sales", [0.25, 0.50, 0.75, 1.0])
    quartiles = [F.col("_edges")[i] for i in range(3)]
    return (
        df.withColumn("_edges", edges)
        .withColumn("sales_category", sales_category(F.col("sales"), quartiles, F.col("_edges")[3]))
        .drop("_edges")
    )


def customer_features(profile: DataFrame) -> DataFrame:
    """The five columns of a profile that lines carry; one row per customer."""
    return profile.select("customer_id", *CUSTOMER_FEATURES)


def attach_customer_features(lines: DataFrame, profile: DataFrame) -> DataFrame:
    """Left join five customer columns; the profile must hold one row per customer.

    For lines that come from order tables, ``star.lines(..., per_customer=...)`` joins
    them on the order side and spares a shuffle of the lines.
    """
    return lines.join(customer_features(profile), "customer_id", "left")
