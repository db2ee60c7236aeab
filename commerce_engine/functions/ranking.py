"""Global positions over an unbounded, uniquely keyed set, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: ``monotonically_increasing_id`` holds the partition above these bits and the row's number below.
ROW_BITS = 33


def with_global_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Add the 1-based position of each row in ascending ``order`` (which must be unique).

    Spark partitions the rows by range and sorts each range; the rows are written once
    with their range and their number in it. A count per range, as many rows as there
    are partitions, gives the number of rows before each range. ``df`` is read twice (to
    sample and to shuffle): pass a written table if it is costly.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    rows = materialize(ranged, "ranges").withColumn("_range", F.shiftright("_id", ROW_BITS))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.col("_id") - F.shiftleft("_range", ROW_BITS)
    return rows.join(offsets, "_range").withColumn(name, F.col("_before") + within + 1).drop("_range", "_id", "_before")


def with_dense_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """Dense rank by ``value`` descending over all rows of ``df``."""
    distinct = df.select((-F.col(value)).alias("_v")).where("_v is not null").distinct()
    ranked = with_global_position(materialize(distinct, "distinct"), ["_v"], name).select((-F.col("_v")).alias(value), name)
    return df.join(ranked, value, "left")
