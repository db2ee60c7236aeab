"""Stored roll-ups of the lines: day-grain totals with mergeable sketches, and running totals.

Both tables are written once and answer any later selection without the lines:

* :func:`daily_rollup` holds sums, distinct sketches of orders and customers and a
  quantile sketch of sales for each day and member. Sketches of any rows unite, so counts
  of distinct orders and quantiles are available under every slicer, at a stated error.
* :func:`running_totals` holds, for every calendar day and member, the totals up to that
  day. The total of any range is the difference of two of its rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .metrics import Selection, selected

#: log2 of a distinct sketch's registers, and a quantile sketch's k.
HLL_BITS, KLL_K = 14, 800
#: Relative error of distinct counts (three standard errors) and rank error of quantiles that tests hold them to.
DISTINCT_ERROR, RANK_ERROR = 0.025, 0.01

SUMS = ["sales", "profit", "quantity"]
ROLLUP_INPUTS = ["order_date", "order_id", "customer_id", *SUMS]


def daily_rollup(lines: DataFrame, by: Sequence[str] = ("region",)) -> DataFrame:
    """One row per day and member: sums, lines, and sketches (a few kB a row)."""
    return lines.groupBy("order_date", *by).agg(
        *[F.sum(c).alias(c) for c in SUMS],
        F.count("*").alias("lines"),
        F.hll_sketch_agg("order_id", HLL_BITS).alias("orders_sketch"),
        F.hll_sketch_agg("customer_id", HLL_BITS).alias("customers_sketch"),
        F.kll_sketch_agg_double(F.col("sales").cast("double"), F.lit(KLL_K)).alias("sales_sketch"),
    )


def united(rollup: DataFrame, by: Sequence[str] = (), where: Selection | None = None, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Sums, distinct orders and customers (about), and quantiles of sales (about) of a selection."""
    quantiles = F.kll_merge_agg_double("sales_sketch", F.lit(KLL_K))
    out = selected(rollup, where).groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in SUMS],
        F.sum("lines").alias("lines"),
        F.hll_sketch_estimate(F.hll_union_agg("orders_sketch")).alias("orders_about"),
        F.hll_sketch_estimate(F.hll_union_agg("customers_sketch")).alias("customers_about"),
        quantiles.alias("_q"),
    )
    at = F.array(*[F.lit(float(p)) for p in probs])
    return out.withColumn("sales_quantiles_about", F.kll_sketch_get_quantile_double("_q", at)).drop("_q")


def quantile_sketch(df: DataFrame, measures: Sequence[str], by: Sequence[str] = (), k: int = KLL_K) -> DataFrame:
    """One mergeable quantile sketch per group and measure: (…, measure, n, sketch)."""
    row = df.groupBy(*by).agg(*[F.kll_sketch_agg_double(F.col(m).cast("double"), F.lit(k)).alias(m) for m in measures])
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("sketch")) for m in measures])
    flat = row.select(*by, F.explode(cells).alias("e")).select(*by, "e.*")
    return flat.select(*by, "measure", F.kll_sketch_get_n_double("sketch").alias("n"), "sketch")


def sketched_quantiles(sketches: DataFrame, probs: Sequence[float], by: Sequence[str] = ("measure",), k: int = KLL_K) -> DataFrame:
    """(…, n, q): quantiles of the union of all sketches that agree in ``by``, within RANK_ERROR of the rank."""
    at = F.array(*[F.lit(float(p)) for p in probs])
    some = sketches.where("n > 0").groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    return some.select(*by, "n", F.kll_sketch_get_quantile_double("sketch", at).alias("q"))


# ------------------------------------------------------------- running totals
def running_totals(lines: DataFrame, by: Sequence[str] = (), sums: Sequence[str] = tuple(SUMS)) -> DataFrame:
    """(members, day, one total up to and with that day per measure): a row for every calendar day and member.

    Lines are grouped by day and member first. A member's days are at most as many as the
    calendar has, which bounds the window. The day before the first is there too, with
    zeros, so that every range has two ends.
    """
    daily = lines.where("order_date is not null").groupBy(F.col("order_date").alias("day"), *by).agg(*[F.sum(c).alias(c) for c in sums])
    ends = daily.agg(F.struct(F.date_sub(F.min("day"), 1).alias("lo"), F.max("day").alias("hi"))).scalar()
    members = daily.select(*by).distinct() if by else daily.agg(F.count("*").alias("n")).where("n > 0").drop("n")
    days = members.withColumn("_ends", ends).select(*by, F.explode(F.sequence("_ends.lo", "_ends.hi")).alias("day"))
    upto = Window.partitionBy(*by).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    known = {c: F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(c) for c in sums}
    same = F.col("day") == F.col("d_day")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"d_{c}"))
    sold = daily.withColumnsRenamed({c: f"d_{c}" for c in ("day", *by)})
    return days.join(sold, same, "left").select(*by, "day", *known.values())


def range_totals(running: DataFrame, ranges: Mapping[str, tuple[str, str]], by: Sequence[str] = (), sums: Sequence[str] = tuple(SUMS)) -> DataFrame:
    """(members, period, totals) of each named range of days, both ends included: two look-ups a range and member.

    Days before the first and after the last of the table are moved to its ends.
    """
    edges = running.agg(F.struct(F.min("day").alias("lo"), F.max("day").alias("hi"))).scalar()
    marks = F.array(
        *[
            F.struct(F.lit(name).alias("period"), day.alias("at"), F.lit(sign).alias("sign"))
            for name, (start, end) in ranges.items()
            for day, sign in ((F.date_sub(F.lit(start).cast("date"), 1), -1), (F.lit(end).cast("date"), 1))
        ]
    )
    wanted = running.sparkSession.range(1).select(F.explode(marks).alias("m")).select("m.*").withColumn("_e", edges)
    at = F.greatest(F.least(F.col("at"), F.col("_e.hi")), F.col("_e.lo")).alias("day")
    found = running.join(wanted.select("period", at, "sign"), "day")
    return found.groupBy(*by, "period").agg(*[F.sum(F.col(c) * F.col("sign")).alias(c) for c in sums])


def period_comparison(running: DataFrame, months: int, by: Sequence[str] = (), measure: str = "sales") -> DataFrame:
    """(members, year_month, now, prior, ytd, total): all from the running totals at the ends of months."""

    def at(day: Column, name: str) -> DataFrame:
        """The totals of the table's own days, under another day: the one that asks for them."""
        return running.select(*[F.col(c).alias(f"{name}_{c}") for c in by], day.alias(f"{name}_day"), F.col(measure).alias(name))

    edges = running.agg(F.struct(F.min("day").alias("lo"), F.max("day").alias("hi"))).scalar()
    is_end = (F.col("day") == F.last_day("day")) | (F.col("day") == F.col("_e.hi"))
    ends = running.withColumn("_e", edges).where(is_end & (F.col("day") > F.col("_e.lo")))
    rows = ends.select(*by, "day", F.trunc("day", "month").alias("month"), F.col(measure).alias("total"), F.col("_e.lo").alias("_lo"))
    asked = {
        "before": F.date_sub("month", 1),
        "year": F.date_sub(F.trunc("month", "year"), 1),
        "prior_end": F.date_sub(F.add_months("month", 1 - months), 1),
        "prior_start": F.date_sub(F.add_months("month", -months), 1),
    }
    for name, day in asked.items():
        side = at(F.col("day"), name)
        same = day == F.col(f"{name}_day")
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"{name}_{c}"))
        rows = rows.join(side, same, "left").drop(f"{name}_day", *[f"{name}_{c}" for c in by])
    none = F.lit(0)
    now = F.col("total") - F.coalesce("before", none)
    known = F.col("prior_end").isNotNull() & (asked["prior_end"] > F.col("_lo"))
    prior = F.when(known, F.col("prior_end") - F.coalesce("prior_start", none))
    return rows.select(*by, F.date_format("month", "yyyy-MM").alias("year_month"), now.alias("now"), prior.alias("prior"), (F.col("total") - F.coalesce("year", none)).alias("ytd"), "total")
