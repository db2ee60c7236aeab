"""Named measures over order lines, by any grouping and under any slicer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import divide_or, percent, ratio
from ..functions.ranking import with_dense_rank

DEEP = 0.30


def _deep() -> Column:
    return F.col("discount").cast("double") > DEEP


def measures(approx: bool = False) -> dict[str, tuple[list[str], Column]]:
    """All measures; ``approx`` counts distinct orders and customers by sketch (about 2 % off)."""
    distinct = partial(F.approx_count_distinct, rsd=0.02) if approx else F.count_distinct
    sales, profit, units = F.sum("sales"), F.sum("profit"), F.sum("quantity")
    orders, lines = distinct("order_id"), F.count("*")
    deep_loss = F.sum(F.when(_deep(), F.col("profit")))
    return {
        "total_sales": (["sales"], sales),
        "total_profit": (["profit"], profit),
        "units_sold": (["quantity"], units),
        "profit_margin": (["sales", "profit"], divide_or(profit, sales)),
        "total_orders": (["order_id"], orders),
        "total_customers": (["customer_id"], distinct("customer_id")),
        "avg_order_value": (["sales", "order_id"], divide_or(sales, orders)),
        "deep_discount_loss": (["discount", "profit"], deep_loss),
        "deep_discount_line_share": (["discount"], ratio(F.count_if(_deep()), lines)),
        "avg_basket_size": (["quantity", "order_id"], divide_or(units, orders)),
        "avg_lines_per_order": (["order_id"], divide_or(lines, orders)),
        "recoverable_profit": (["discount", "profit"], -deep_loss),
        "loss_making_lines": (["profit"], F.count_if(F.col("profit") < 0)),
    }


def inputs(names: Sequence[str], *extra: str) -> list[str]:
    """Columns a set of measures needs, for pruned reading."""
    known = measures()
    return list(dict.fromkeys([*extra, *(c for n in names for c in known[n][0])]))


def slicer(
    start: str | None = None, end: str | None = None, year_column: str | None = None, **members: Sequence[str] | str
) -> Column | None:
    """A filter from an order-date range and allowed members per column.

    ``year_column`` names a column with the order's year, such as the one that a table
    is partitioned by: the range's years are asked for as well, so that a scan leaves
    out the other partitions.
    """
    tests = []
    if year_column and start:
        tests.append(F.col(year_column) >= int(start[:4]))
    if year_column and end:
        tests.append(F.col(year_column) <= int(end[:4]))
    if start:
        tests.append(F.col("order_date") >= F.lit(start).cast("date"))
    if end:
        tests.append(F.col("order_date") <= F.lit(end).cast("date"))
    for column, allowed in members.items():
        tests.append(F.col(column).isin([allowed] if isinstance(allowed, str) else list(allowed)))
    out = None
    for t in tests:
        out = t if out is None else out & t
    return out


Selection = Mapping[str, Sequence[str] | str]


def selected(df: DataFrame, where: Selection | None) -> DataFrame:
    """Rows of a selection as :func:`slicer` takes it, pruned by year where there is one."""
    test = slicer(**where, year_column="order_year" if "order_year" in df.columns else None) if where else None
    return df if test is None else df.where(test)


def measure(
    df: DataFrame,
    names: Sequence[str],
    by: Sequence[str] = (),
    where: Column | None = None,
    approx: bool = False,
) -> DataFrame:
    known = measures(approx)
    rows = df if where is None else df.where(where)
    return rows.groupBy(*by).agg(*[known[n][1].alias(n) for n in names])


def calendar(lines: DataFrame) -> DataFrame:
    """Every day from January 1 of the first year to December 31 of the last."""
    ends = lines.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    first = F.make_date(F.year("lo"), F.lit(1), F.lit(1))
    last = F.make_date(F.year("hi"), F.lit(12), F.lit(31))
    d = F.col("date")
    return ends.select(F.explode(F.sequence(first, last)).alias("date")).select(
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMM").alias("month_name"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.date_format(d, "EEEE").alias("day_name"),
    )


def on_calendar(lines: DataFrame, days: DataFrame) -> DataFrame:
    """Lines of the given calendar days, with the calendar's columns.

    The year takes part in the join: from a fact partitioned by it, Spark reads only the
    years that the chosen days fall in (dynamic partition pruning).
    """
    same = (F.col("order_year") == F.col("year")) & (F.col("order_date") == F.col("date"))
    extra = [c for c in days.columns if c not in ("date", "year") and c not in lines.columns]
    return lines.join(days.select("date", "year", *extra), same).drop("date", "year")


def calendar_sales(lines: DataFrame) -> DataFrame:
    """The calendar with each day's sales and distinct orders; quiet days count 0."""
    daily = lines.groupBy(F.col("order_date").alias("date")).agg(
        F.sum("sales").alias("sales"), F.count_distinct("order_id").alias("orders")
    )
    return calendar(lines).join(daily, "date", "left").select(
        "date", "year_month", F.coalesce("sales", F.lit(0)).alias("sales"), F.coalesce("orders", F.lit(0)).alias("orders")
    )


def compare_periods(
    df: DataFrame, columns: Mapping[str, str], months: int, by: Sequence[str] = (), where: Selection | None = None
) -> DataFrame:
    """Per month and group: each measure, its value ``months`` earlier, and the change.

    The earlier value is found by date, so a missing month gives null instead of
    the nearest earlier row. ``columns`` maps measure name to output stem. Of a
    selection, members are cut before; its dates shift with the period, so the
    earlier value covers the same days ``months`` before.
    """
    where = dict(where or {})
    dates = {k: where.pop(k) for k in ("start", "end") if k in where}
    rows = selected(df, where)

    def monthly(rows: DataFrame) -> DataFrame:
        totals = measure(rows.withColumn("month", F.trunc("order_date", "month")), list(columns), [*by, "month"])
        return totals.withColumnsRenamed(dict(columns))

    shifted = [F.add_months(F.lit(v).cast("date"), -months) for v in dates.values()]
    earlier = rows
    for name, bound in zip(dates, shifted):
        earlier = earlier.where(F.col("order_date") >= bound if name == "start" else F.col("order_date") <= bound)
    now = monthly(selected(rows, dates))
    past = monthly(earlier)
    stems = list(columns.values())
    past = past.select(
        *by, F.add_months("month", months).alias("month"), *[F.col(s).alias(f"{s}_prior") for s in stems]
    )
    joined = now.join(past, [*by, "month"], "left")
    out = [*by, F.date_format("month", "yyyy-MM").alias("year_month")]
    for s in stems:
        prior = F.col(f"{s}_prior")
        out += [F.col(s), prior, ratio(F.col(s) - prior, prior).alias(f"{s}_change")]
    return joined.select(*out)


def running_sales(df: DataFrame, where: Selection | None = None) -> DataFrame:
    """Monthly sales with the year-to-date and all-time running totals.

    Of a selection only its members and its end cut the sales; months before its
    start are counted and then left out.
    """
    where = dict(where or {})
    start = where.pop("start", None)
    monthly = selected(df, where).groupBy("order_year", "year_month").agg(F.sum("sales").alias("sales"))
    upto = F.col("year_month")
    ytd = F.sum("sales").over(Window.partitionBy("order_year").orderBy(upto))
    total = F.sum("sales").over(Window.orderBy(upto))
    out = monthly.select("year_month", "sales", ytd.alias("sales_ytd"), total.alias("running_total"))
    return out.where(F.col("year_month") >= start[:7]) if start else out


def sales_rank(df: DataFrame, key: str, where: Selection | None = None) -> DataFrame:
    """Dense rank of every key by sales within a selection, without gathering the keys in one task."""
    totals = selected(df, where).groupBy(key).agg(F.sum("sales").alias("sales"))
    return with_dense_rank(totals, "sales", "sales_rank")


def share_of_selection(df: DataFrame, by: Sequence[str], where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.where(where)
    totals = rows.groupBy(*by).agg(F.sum("sales").alias("sales"))
    return totals.withColumn("share", ratio(F.col("sales"), F.sum("sales").over(Window.partitionBy())))


def rank_in_scope(df: DataFrame, key: str, where: Selection | None = None) -> DataFrame:
    """A Total row on top of ranked keys; the rank is null on the Total row."""
    df = selected(df, where)
    total = df.agg(F.sum("sales").alias("sales")).select(
        F.lit("Total").alias(key), "sales", F.lit(None).cast("bigint").alias("sales_rank")
    )
    return sales_rank(df, key).select(key, "sales", F.col("sales_rank").cast("bigint")).unionByName(total)


def top_n(df: DataFrame, key: str, n: int = 5, where: Selection | None = None) -> DataFrame:
    """Keys whose dense rank by sales within a selection is at most n, ties included."""
    totals = selected(df, where).groupBy(key).agg(F.sum("sales").alias("sales"))
    rank = F.dense_rank().over(Window.orderBy(F.desc("sales")))
    return totals.withColumn("sales_rank", rank.cast("bigint")).where(F.col("sales_rank") <= n)


# ------------------------------------------------------------- drill-through
DETAIL = ["total_sales", "total_profit", "profit_margin", "total_orders", "units_sold"]


def detail_kpis(df: DataFrame, key: str, member: str) -> DataFrame:
    rows = df.where(F.col(key) == member)
    discount = ratio(F.sum("discount"), F.count("discount"))
    known = measures()
    return rows.agg(*[known[n][1].alias(n) for n in DETAIL], discount.alias("avg_discount"))


def detail_trend(df: DataFrame, key: str, member: str) -> DataFrame:
    rows = df.where(F.col(key) == member)
    return rows.groupBy("year_month").agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))


def detail_orders(df: DataFrame, key: str, member: str) -> DataFrame:
    rows = df.where(F.col(key) == member)
    return rows.groupBy("order_id", "order_date").agg(
        F.sum("sales").alias("sales"), F.sum("profit").alias("profit"), F.count("*").alias("lines")
    )


def state_trend(df: DataFrame, where: Selection | None = None) -> DataFrame:
    return selected(df, where).groupBy("state", "year_month").agg(
        F.sum("sales").alias("sales"), percent(F.sum("profit"), F.sum("sales")).alias("margin_pct")
    )
