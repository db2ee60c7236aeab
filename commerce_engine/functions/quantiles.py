"""Exact quantiles without bringing a column's distinct values into one task.

Spark's ``percentile`` keeps every distinct value in one aggregation buffer. Here
rows are counted by value once, combined on the map side; both later steps start
from those counts, so the input is read once. Sums over logarithmic buckets (a
bounded number) locate the buckets that hold the wanted ranks; the values inside
them are then put in order. Bucketing is monotone in the value, so the located
ranks are exact. One task orders the distinct values of one bucket: few for money,
a 2048th of an e-fold for any other DOUBLE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_E = 2048


def melt(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Wide to long: one (measure, v) row per non-null value."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("v")) for m in measures])
    return df.select(F.explode(pairs).alias("e")).select("e.measure", "e.v").where("v is not null")


def counted(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """(measure, v, cnt): how often each value occurs."""
    return melt(df, measures).groupBy("measure", "v").agg(F.count("*").alias("cnt"))


def _bucket(v: Column) -> Column:
    return (F.signum(v) * F.floor(F.log1p(F.abs(v) * 100) * BUCKETS_PER_E)).cast("bigint")


def exact_quantiles(df: DataFrame, measures: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(measure, n, q) with ``q`` the linearly interpolated quantiles, one per prob."""
    return quantiles_of(counted(df, measures), probs)


def quantiles_of(counts: DataFrame, probs: Sequence[float]) -> DataFrame:
    """As :func:`exact_quantiles`, from the counts of :func:`counted`."""
    # Never null. The join below makes Spark infer this filter for one of the two uses, which
    # would then differ from the other, and the input be read and counted for each.
    values = counts.withColumn("bucket", _bucket(F.col("v"))).where("bucket is not null")

    at = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    ranks = F.array(*[r for h in at for r in (F.floor(h), F.ceil(h))])

    hist = values.groupBy("measure", "bucket").agg(F.sum("cnt").alias("cnt"))
    running = Window.partitionBy("measure").orderBy("bucket")
    hits = (
        hist.withColumn("upto", F.sum("cnt").over(running.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("n", F.sum("cnt").over(Window.partitionBy("measure")))
        .withColumn("before", F.col("upto") - F.col("cnt"))
        .where(F.exists(ranks, lambda r: (r >= F.col("before")) & (r < F.col("upto"))))
        .select("measure", "bucket", "before", "n")
    )
    # hits has at most two buckets per measure and prob.
    inside = values.join(F.broadcast(hits), ["measure", "bucket"])
    order = Window.partitionBy("measure", "bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    located = (
        inside.withColumn("upto", F.col("before") + F.sum("cnt").over(order))
        .withColumn("first", F.col("upto") - F.col("cnt"))
        .where(F.exists(ranks, lambda r: (r >= F.col("first")) & (r < F.col("upto"))))
        .groupBy("measure", "n")
        .agg(F.collect_list(F.struct("first", "upto", "v")).alias("found"))
    )

    def value_at(rank: Column) -> Column:
        return F.filter("found", lambda s: (s["first"] <= rank) & (rank < s["upto"]))[0]["v"]

    quantiles = []
    for h in at:
        low, high = value_at(F.floor(h)), value_at(F.ceil(h))
        quantiles.append(low + (high - low) * (h - F.floor(h)))
    return located.select("measure", "n", F.array(*quantiles).alias("q"))


def quantile_edges(df: DataFrame, measure: str, probs: Sequence[float]) -> Column:
    """The quantiles as one array column, a scalar subquery.

    Put it into a column of its own before using its elements: every mention of a
    subquery is planned again.
    """
    return exact_quantiles(df, [measure], probs).select("q").scalar()
