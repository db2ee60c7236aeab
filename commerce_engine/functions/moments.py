"""Central moments that merge: groups with count, mean and sums of powers about their own mean.

Sums of raw powers lose every digit where the mean is large against the deviation. Powers
about the mean do not, and those of several groups add up exactly to those of their union
once each group's distance from the common mean is put in. A stored table of moments by
day or region therefore gives deviation, skewness, kurtosis and correlation of any
selection of its rows, without the lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOMENTS = ["n", "mean", "m2", "m3", "m4"]


def moments_of(df: DataFrame, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per group and measure: n, mean, and sums of the 2nd to 4th powers about the mean."""
    v = {m: F.col(m).cast("double") for m in measures}
    stats = {"n": F.count, "mean": F.avg, "var": F.var_pop, "skew": F.skewness, "kurt": F.kurtosis}
    row = df.groupBy(*by).agg(*[f(v[m]).alias(f"{m}|{k}") for m in measures for k, f in stats.items()])
    cells = [F.struct(F.lit(m).alias("measure"), *[F.col(f"`{m}|{k}`").alias(k) for k in stats]) for m in measures]
    flat = row.select(*by, F.explode(F.array(*cells)).alias("e")).select(*by, "e.*").where("n > 0")
    n, var = F.col("n"), F.col("var")
    return flat.select(
        *by, "measure", "n", "mean", (n * var).alias("m2"),
        F.coalesce(F.col("skew") * n * F.pow(var, F.lit(1.5)), F.lit(0.0)).alias("m3"),
        F.coalesce((F.col("kurt") + 3) * n * var * var, F.lit(0.0)).alias("m4"),
    )


def of_counts(counts: DataFrame) -> DataFrame:
    """Each (measure, v, cnt) as a group whose rows all lie on its mean."""
    zero = F.lit(0.0)
    return counts.select("measure", F.col("cnt").alias("n"), F.col("v").alias("mean"), zero.alias("m2"), zero.alias("m3"), zero.alias("m4"))


def merged(moments: DataFrame, by: Sequence[str] = ("measure",)) -> DataFrame:
    """The moments of the union of all groups that agree in ``by``: one row each.

    The common means, one row per result, join back to the groups; both steps combine
    before they shuffle.
    """
    n = F.col("n")
    middle = moments.groupBy(*by).agg(F.sum("n").alias("_n"), F.try_divide(F.sum(F.col("mean") * n), F.sum("n")).alias("_mean"))
    d = F.col("mean") - F.col("_mean")
    m2, m3 = F.col("m2"), F.col("m3")
    return moments.join(middle, list(by)).groupBy(*by).agg(
        F.first("_n").alias("n"),
        F.first("_mean").alias("mean"),
        F.sum(m2 + n * d * d).alias("m2"),
        F.sum(m3 + 3 * d * m2 + n * d * d * d).alias("m3"),
        F.sum(F.col("m4") + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d).alias("m4"),
    )


def sample_deviation() -> Column:
    return F.sqrt(F.try_divide(F.col("m2"), F.col("n") - 1))


def population_skew() -> Column:
    return F.try_divide(F.sqrt("n") * F.col("m3"), F.pow("m2", F.lit(1.5)))


def population_kurtosis() -> Column:
    """Excess kurtosis."""
    return F.try_divide(F.col("n") * F.col("m4"), F.col("m2") * F.col("m2")) - 3


def comoments_of(df: DataFrame, pairs: Sequence[tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """One row per group and pair, over rows that have both values: n, means, sums of squares and of products about the means."""
    cells = []
    for a, b in pairs:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        both = x.isNotNull() & y.isNotNull()
        x, y = F.when(both, x), F.when(both, y)
        stats = {"n": F.count(x), "mx": F.avg(x), "my": F.avg(y), "vx": F.var_pop(x), "vy": F.var_pop(y), "cv": F.covar_pop(x, y)}
        cells.append((a, b, stats))
    row = df.groupBy(*by).agg(*[v.alias(f"{a}|{b}|{k}") for a, b, stats in cells for k, v in stats.items()])
    structs = [F.struct(F.lit(a).alias("measure"), F.lit(b).alias("other"), *[F.col(f"`{a}|{b}|{k}`").alias(k) for k in stats]) for a, b, stats in cells]
    flat = row.select(*by, F.explode(F.array(*structs)).alias("e")).select(*by, "e.*").where("n > 0")
    n = F.col("n")
    return flat.select(*by, "measure", "other", "n", "mx", "my", (n * F.col("vx")).alias("sxx"), (n * F.col("vy")).alias("syy"), (n * F.col("cv")).alias("sxy"))


def merged_comoments(moments: DataFrame, by: Sequence[str] = ("measure", "other")) -> DataFrame:
    """As :func:`merged`, with the Pearson correlation ``r``."""
    n = F.col("n")
    middle = moments.groupBy(*by).agg(*[F.try_divide(F.sum(F.col(m) * n), F.sum("n")).alias(f"_{m}") for m in ("mx", "my")])
    dx, dy = F.col("mx") - F.col("_mx"), F.col("my") - F.col("_my")
    sums = moments.join(middle, list(by)).groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum(F.col("sxx") + n * dx * dx).alias("sxx"),
        F.sum(F.col("syy") + n * dy * dy).alias("syy"),
        F.sum(F.col("sxy") + n * dx * dy).alias("sxy"),
    )
    return sums.withColumn("r", F.try_divide(F.col("sxy"), F.sqrt(F.col("sxx") * F.col("syy"))))
