"""Workbook tables: KPIs, category and region sheets, the monthly grid, top customers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import dbl, divide_or

FLAT_COLS = [
    "order_id", "order_date", "order_year", "order_month_name", "segment", "region", "state", "city", "category",
    "sub_category", "product_name", "customer_name", "sales", "quantity", "discount", "profit", "shipping_days",
]


def kpis(df: DataFrame) -> DataFrame:
    """Eight metrics as rows; customers are counted by name here."""
    row = df.agg(
        F.sum("sales").alias("s"),
        F.sum("profit").alias("p"),
        F.count_distinct("order_id").alias("o"),
        F.count_distinct("customer_name").alias("c"),
        F.sum("quantity").alias("u"),
        F.count("*").alias("n"),
    )
    s, p, o, n = (F.col(x) for x in "spon")
    metrics = {
        "Total Sales": dbl(s),
        "Total Profit": dbl(p),
        "Profit Margin": divide_or(p, s),
        "Total Orders": dbl(o),
        "Total Customers": dbl("c"),
        "Units Sold": dbl("u"),
        "Avg Order Value": divide_or(s, o),
        "Avg Line Value": divide_or(s, n),
    }
    return row.select(*[v.alias(k) for k, v in metrics.items()]).unpivot([], list(metrics), "metric", "value")


def fixed_table(df: DataFrame, key: str, members: Sequence[str]) -> DataFrame:
    """Sales, profit and margin for every member present and every listed one, 0 where absent."""
    totals = df.groupBy(key).agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))
    listed = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(m) for m in members])).alias(key))
    zero = F.lit(0).cast("decimal(28,2)")
    every = totals.unionByName(listed.select(key, zero.alias("sales"), zero.alias("profit")))
    return every.groupBy(key).agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit")).withColumn(
        "margin", divide_or(F.col("profit"), F.col("sales"))
    )


def monthly_grid(df: DataFrame) -> DataFrame:
    """Every month of every year with orders, empty months as 0, and a Total row."""
    by = df.groupBy("order_year", "order_month").agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))
    grid = df.select("order_year").distinct().select(
        "order_year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("order_month")
    )
    dense = grid.join(by, ["order_year", "order_month"], "left")
    month = F.date_format(F.make_date(F.lit(2020), "order_month", F.lit(1)), "MMM")
    return (
        dense.rollup(F.struct("order_year", "order_month").alias("m"))
        .agg(
            F.grouping_id().alias("is_total"),
            F.coalesce(F.sum("sales"), F.lit(0)).alias("sales"),
            F.coalesce(F.sum("profit"), F.lit(0)).alias("profit"),
        )
        .select(F.col("m.order_year").alias("order_year"), F.col("m.order_month").alias("order_month"), "is_total", "sales", "profit")
        .withColumn("month", F.when(F.col("is_total") == 1, "Total").otherwise(month))
        .withColumn("margin", divide_or(F.col("profit"), F.col("sales")))
        .orderBy("is_total", "order_year", "order_month")
        .select("order_year", "month", "sales", "profit", "margin")
    )


def region_sheet(df: DataFrame) -> DataFrame:
    """Regions with margin and share of sales, then a Total row."""
    by = (
        df.rollup("region")
        .agg(F.grouping_id().alias("is_total"), F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))
        .withColumn("margin", divide_or(F.col("profit"), F.col("sales")))
    )
    whole = F.max(F.when(F.col("is_total") == 1, F.col("sales"))).over(Window.partitionBy())
    name = F.when(F.col("is_total") == 1, "Total").otherwise(F.col("region"))
    share = F.when(F.col("is_total") == 0, divide_or(F.col("sales"), whole))
    return by.select(name.alias("region"), "sales", "profit", "margin", share.alias("share_of_sales"))


def top_customers(df: DataFrame, k: int = 20) -> DataFrame:
    top = (
        df.groupBy("customer_name")
        .agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))
        .orderBy(F.desc("sales"), "customer_name")
        .limit(k)
    )
    place = F.row_number().over(Window.orderBy(F.desc("sales"), "customer_name")).cast("bigint")
    return top.select(place.alias("rank"), "customer_name", "sales", "profit")


def flat_projection(df: DataFrame) -> DataFrame:
    return df.select(*FLAT_COLS)
