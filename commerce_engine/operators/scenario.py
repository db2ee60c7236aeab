"""Profit under a cap on discounts: all caps from one sum of sales and profit per discount.

For a given discount the new sales are a fixed multiple of the sales, so the lines
are summed by discount first (a hundred rows or so) and every cap is applied to
the sums, in whole numbers. Results do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import rnd

# The caps of the standard scenario, loosest first.
CAPS_PCT = [100, 70, 50, 40, 30, 20, 10, 0]
# New sales of one discount are kept to this many decimals of a cent.
DIGITS = 6


def whole(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def divided(a: Column, b: Column) -> Column:
    """a / b as a whole number, half away from zero; both whole, b positive."""
    doubled = whole(F.abs(a) * 2 + b)
    return F.sign(a).cast("int") * whole((doubled - doubled % (b * 2)) / (b * 2))


def by_discount(lines: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, pct, sales, profit) with the discount in whole per cent and money in whole cents."""
    sums = lines.groupBy(*by, "discount").agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))
    cents = {c: whole(F.round(F.col(c) * 100, 0)) for c in ("sales", "profit")}
    return sums.select(*by, F.round(F.col("discount") * 100, 0).cast("int").alias("pct"), *[v.alias(c) for c, v in cents.items()])


def capped(cap: Column) -> Column:
    """Change of profit, in 10^-DIGITS cents, if discounts had been at most ``cap`` per cent and the sale still closed.

    Null without a discount: LEAST would skip the null and put the cap in its place.
    """
    list_share = F.when(F.col("pct") < 100, 100 - F.col("pct")).otherwise(100)
    kept_share = 100 - F.least(F.col("pct"), cap)
    scaled = whole(F.col("sales") * F.lit(10**DIGITS))
    new_sales = divided(whole(scaled * kept_share.cast("decimal(5,0)")), list_share.cast("decimal(5,0)"))
    return F.when(F.col("pct").isNotNull(), whole(new_sales - scaled))


def totals(groups: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, profit, simulated) in currency, from groups that carry a column ``cap``.

    A line without a discount keeps its profit.
    """
    change = F.coalesce(F.sum(capped(F.col("cap"))), F.lit(0))
    unit = F.lit(10 ** (DIGITS + 2)).cast("decimal(10,0)")
    profit = F.sum("profit")
    return groups.groupBy(*by).agg(
        (profit / 100).alias("profit"), (whole(profit * 10**DIGITS + change) / unit).alias("simulated")
    )


def discount_caps(lines: DataFrame, caps_pct: Sequence[int] = tuple(CAPS_PCT)) -> DataFrame:
    """(cap_pct, profit, uplift, uplift_pct); uplift is against the first cap.

    Lines without a discount are left out, as a missing value leaves a sum.
    """
    caps = F.explode(F.array(*[F.lit(c) for c in caps_pct])).alias("cap")
    sums = by_discount(lines).where("pct is not null").select("*", caps)
    long = totals(sums, ["cap"])
    base = long.where(F.col("cap") == caps_pct[0]).agg(F.first("simulated")).scalar()
    uplift = F.col("simulated") - base
    given = F.array(*[F.lit(c) for c in caps_pct])
    return long.orderBy(F.array_position(given, F.col("cap"))).select(
        F.col("cap").alias("cap_pct"),
        F.round("simulated", 2).cast("double").alias("profit"),
        F.round(uplift, 2).cast("double").alias("uplift"),
        rnd(F.try_divide(uplift.cast("double") * 100, base.cast("double")), 4).alias("uplift_pct"),
    )


def interactive_caps(lines: DataFrame, step: int = 5) -> DataFrame:
    """Every cap of a 0-100 slider, each against the profit actually made."""
    caps = list(range(100, -1, -step))
    return discount_caps(lines, caps).orderBy("cap_pct")


def simulated_profit(lines: DataFrame, cap_pct: int, by: Sequence[str] = ()) -> DataFrame:
    """(by, simulated_profit, profit_uplift, profit_uplift_ratio) under one cap; lines without a discount keep their profit."""
    sums = totals(by_discount(lines, by).withColumn("cap", F.lit(cap_pct)), by)
    uplift = F.col("simulated") - F.col("profit")
    return sums.select(
        *by,
        F.round("simulated", 2).cast("double").alias("simulated_profit"),
        F.round(uplift, 2).cast("double").alias("profit_uplift"),
        rnd(F.try_divide(uplift.cast("double"), F.col("profit").cast("double")), 6).alias("profit_uplift_ratio"),
    )
