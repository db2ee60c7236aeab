"""Distribution, correlation and breakdown statistics over order lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import label_order, margin_pct, mean, percent, ratio, rnd, share
from ..functions.quantiles import exact_quantiles
from .features import DISCOUNT_BANDS
from .quality import corrected_kurtosis, corrected_skew

CORRELATED = ["sales", "profit", "quantity", "discount", "unit_price", "shipping_days", "profit_margin"]


def margin(profit: str = "profit", sales: str = "sales") -> Column:
    return percent(F.sum(profit), F.sum(sales))


def shape(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Bias-corrected skewness and excess kurtosis per measure, in one pass."""
    v = {m: F.col(m).cast("double") for m in measures}
    kinds = (("g1", F.skewness), ("g2", F.kurtosis), ("n", F.count))
    row = df.agg(*[f(v[m]).alias(f"{m}|{n}") for m in measures for n, f in kinds])
    cells = [F.struct(F.lit(m).alias("measure"), *[F.col(f"`{m}|{n}`").alias(n) for n, _ in kinds]) for m in measures]
    return row.select(F.explode(F.array(*cells)).alias("e")).select("e.*").select(
        "measure",
        rnd(corrected_skew("g1", "n"), 6).alias("skew"),
        rnd(corrected_kurtosis("g2", "n"), 6).alias("kurtosis"),
    )


def median_and_mean(df: DataFrame, measure: str = "sales") -> DataFrame:
    average = df.agg(mean(measure)).scalar()
    return exact_quantiles(df, [measure], [0.5]).select(
        F.lit(measure).alias("measure"), rnd(F.col("q")[0], 2).alias("median"), rnd(average, 2).alias("mean")
    )


def five_numbers(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    names = ["min", "q1", "median", "q3", "max"]
    q = exact_quantiles(df, measures, [0.0, 0.25, 0.5, 0.75, 1.0])
    return q.select("measure", *[rnd(F.col("q")[i], 2).alias(n) for i, n in enumerate(names)])


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """Equal-width bins between min and max, the last one closed; empty bins count 0."""
    values = df.select(value.cast("double").alias("x")).where("x is not null")
    ends = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo, width = F.col("ends.lo"), (F.col("ends.hi") - F.col("ends.lo")) / bins
    slot = F.least(F.floor(F.try_divide(F.col("x") - lo, width)), F.lit(bins - 1)) + 1
    counts = values.withColumn("ends", ends).groupBy(F.coalesce(slot, F.lit(1)).cast("int").alias("bin")).agg(F.count("*").alias("lines"))
    all_bins = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counts, "bin", "left").withColumn("ends", ends).select(
        "bin",
        rnd(lo + (F.col("bin") - 1) * width, 6).alias("low"),
        rnd(lo + F.col("bin") * width, 6).alias("high"),
        F.coalesce("lines", F.lit(0)).alias("lines"),
    )


def log10_floor(c: str, floor: float = 0.1) -> Column:
    return F.log10(F.greatest(F.col(c).cast("double"), F.lit(floor)))


def correlations(df: DataFrame, measures: Sequence[str] = tuple(CORRELATED)) -> DataFrame:
    """Lower triangle of the Pearson matrix; every pair in one pass, pairwise complete."""
    pairs = [(a, b) for i, a in enumerate(measures) for b in measures[:i]]
    x = {m: F.col(m).cast("double") for m in measures}
    both = {(a, b): x[a].isNotNull() & x[b].isNotNull() for a, b in pairs}
    row = df.agg(
        *[F.corr(F.when(both[a, b], x[a]), F.when(both[a, b], x[b])).alias(f"{a}|{b}") for a, b in pairs]
    )
    long = row.unpivot([], row.columns, "pair", "r")
    part = F.split("pair", r"\|")
    return long.select(part[0].alias("measure"), part[1].alias("other"), rnd(F.col("r"), 6).alias("r"))


def correlations_with(df: DataFrame, target: str = "profit", measures: Sequence[str] = tuple(CORRELATED)) -> DataFrame:
    pairs = correlations(df, measures).where((F.col("measure") == target) | (F.col("other") == target))
    name = F.when(F.col("measure") == target, F.col("other")).otherwise(F.col("measure"))
    return pairs.select(name.alias("measure"), "r").orderBy("r")


def discount_band_table(df: DataFrame) -> DataFrame:
    """Lines, totals, margin and loss rate per band, in band order."""
    return (
        df.where("discount_band is not null")
        .groupBy("discount_band")
        .agg(
            F.count("*").alias("lines"),
            F.sum("sales").alias("sales"),
            F.sum("profit").alias("profit"),
            F.count_if("is_loss").alias("loss_lines"),
            margin().alias("margin_pct"),
            percent(F.count_if("is_loss"), F.count("*")).alias("loss_rate_pct"),
        )
        .orderBy(label_order(F.col("discount_band"), DISCOUNT_BANDS))
    )


def deep_discount_impact(df: DataFrame, limit: float = 0.30) -> DataFrame:
    deep = F.col("discount").cast("double") > limit
    return df.agg(
        F.count_if(deep).alias("deep_lines"),
        rnd(percent(F.count_if(deep), F.count("*")), 1).alias("deep_line_pct"),
        F.sum(F.when(deep, F.col("profit"))).alias("deep_profit"),
        F.sum(F.when(~deep, F.col("profit"))).alias("profit_without_deep"),
    )


def scatter_sample(df: DataFrame, size: int = 3000, seed: int = 7) -> DataFrame:
    """A repeatable sample without replacement: the rows with the smallest seeded digest."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col("row_id").cast("string"))), "row_id").limit(size)


def rolling_mean(monthly: DataFrame, months: int = 3) -> DataFrame:
    """Mean of the last ``months`` rows, null until that many exist."""
    frame = Window.orderBy("year_month").rowsBetween(1 - months, 0)
    full = F.count("sales").over(frame) == months
    average = ratio(F.sum("sales").over(frame), F.count("sales").over(frame))
    return monthly.withColumn("rolling_mean", F.when(full, rnd(average, 2)))


def monthly_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("year_month").agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))


def seasonality(df: DataFrame) -> DataFrame:
    """Sales per calendar month averaged over the years present."""
    by = df.groupBy("order_year", "order_month").agg(F.sum("sales").alias("sales"))
    years = F.size(F.collect_set("order_year").over(Window.partitionBy()))
    return by.withColumn("years", years).groupBy("order_month").agg(rnd(ratio(F.sum("sales"), F.max("years")), 2).alias("avg_sales"))


def season_extremes(df: DataFrame, k: int = 3) -> DataFrame:
    s = seasonality(df)
    name = F.date_format(F.make_date(F.lit(2020), "order_month", F.lit(1)), "MMMM").alias("month")
    top = s.orderBy(F.desc("avg_sales"), "order_month").limit(k).withColumn("kind", F.lit("strongest"))
    low = s.orderBy("avg_sales", "order_month").limit(k).withColumn("kind", F.lit("weakest"))
    return top.unionByName(low).select("kind", name, "avg_sales")


def state_table(df: DataFrame) -> DataFrame:
    return df.groupBy("state", "region").agg(
        F.sum("sales").alias("sales"),
        F.sum("profit").alias("profit"),
        mean("discount").alias("avg_discount"),
        margin().alias("margin_pct"),
    )


def loss_states(df: DataFrame) -> DataFrame:
    return state_table(df).where("profit < 0").orderBy("profit")


def loss_state_discounts(df: DataFrame) -> DataFrame:
    """Mean of the state means of discount, loss-making against profitable states."""
    fixed = F.col("avg_discount").cast("decimal(20,12)")
    return state_table(df).agg(
        F.count_if(F.col("profit") < 0).alias("loss_states"),
        rnd(mean(F.when(F.col("profit") < 0, fixed)) * 100, 1).alias("loss_avg_discount_pct"),
        rnd(mean(F.when(F.col("profit") > 0, fixed)) * 100, 1).alias("profitable_avg_discount_pct"),
    )


def extremes(df: DataFrame, k: int = 3) -> DataFrame:
    """The k largest sales and the k deepest losses."""
    cols = ["product_name", "sales", "profit", "discount"]
    top = df.orderBy(F.desc("sales"), "row_id").limit(k).select(F.lit("largest sales").alias("kind"), *cols)
    low = df.orderBy("profit", "row_id").limit(k).select(F.lit("smallest profit").alias("kind"), *cols)
    return top.unionByName(low)


def segment_comparison(df: DataFrame) -> DataFrame:
    orders = F.count_distinct("order_id")
    return df.groupBy("segment").agg(
        F.count_distinct("customer_id").alias("customers"),
        orders.alias("orders"),
        F.sum("sales").alias("sales"),
        F.sum("profit").alias("profit"),
        margin().alias("margin_pct"),
        ratio(F.sum("sales"), orders).alias("avg_order_value"),
    )


def ship_mode_comparison(df: DataFrame) -> DataFrame:
    return df.groupBy("ship_mode").agg(
        F.count_distinct("order_id").alias("orders"),
        mean("shipping_days").alias("avg_days"),
        F.sum("sales").alias("sales"),
        F.sum("profit").alias("profit"),
        margin().alias("margin_pct"),
    )


def city_leaders(df: DataFrame, k: int = 10) -> DataFrame:
    return (
        df.groupBy("city", "state")
        .agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"), margin().alias("margin_pct"))
        .orderBy(F.desc("sales"), "city", "state")
        .limit(k)
        .withColumn("label", F.concat_ws(", ", "city", "state"))
        .select("label", "sales", "profit", "margin_pct")
    )


def category_shares(df: DataFrame) -> DataFrame:
    by = df.groupBy("category").agg(
        F.sum("sales").alias("sales"), F.sum("profit").alias("profit"), margin().alias("margin_pct")
    )
    return by.withColumn("share_pct", percent(F.col("sales"), F.sum("sales").over(Window.partitionBy())))


def sub_category_table(df: DataFrame) -> DataFrame:
    return df.groupBy("sub_category").agg(
        F.sum("sales").alias("sales"),
        F.sum("profit").alias("profit"),
        mean("discount").alias("avg_discount"),
        margin().alias("margin_pct"),
    )


def yearly_summary(df: DataFrame) -> DataFrame:
    by = df.groupBy("order_year").agg(
        F.sum("sales").alias("sales"),
        F.sum("profit").alias("profit"),
        F.count_distinct("order_id").alias("orders"),
        margin().alias("margin"),
    )
    before = F.lag("sales").over(Window.orderBy("order_year"))
    return by.withColumn("yoy", percent(F.col("sales") - before, before))


def region_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("region").agg(
        F.sum("sales").alias("sales"),
        F.sum("profit").alias("profit"),
        mean("discount").alias("discount"),
        margin().alias("margin"),
    )


def top_by(df: DataFrame, key: str, measure: str, k: int, label_chars: int | None = None) -> DataFrame:
    """The k keys with the largest total, optionally with the key cut to a label length."""
    top = df.groupBy(key).agg(F.sum(measure).alias(measure)).orderBy(F.desc(measure), key).limit(k)
    return top.withColumn("label", F.substring(key, 1, label_chars)) if label_chars else top


# -------------------------------------------------- exported aggregate tables
def agg_category(df: DataFrame) -> DataFrame:
    by = df.groupBy("category").agg(
        F.sum("sales").alias("sales"),
        F.sum("profit").alias("profit"),
        F.count_distinct("order_id").alias("orders"),
        margin().alias("margin_pct"),
    )
    return by.withColumn("pct_of_sales", percent(F.col("sales"), F.sum("sales").over(Window.partitionBy())))


def agg_discount(df: DataFrame) -> DataFrame:
    return (
        df.where("discount_band is not null")
        .groupBy("discount_band")
        .agg(
            F.count("*").alias("lines"),
            F.sum("sales").alias("sales"),
            F.sum("profit").alias("profit"),
            margin().alias("margin_pct"),
        )
        .orderBy(label_order(F.col("discount_band"), DISCOUNT_BANDS))
    )


def agg_region(df: DataFrame) -> DataFrame:
    return df.groupBy("region").agg(
        F.sum("sales").alias("sales"),
        F.sum("profit").alias("profit"),
        F.count_distinct("order_id").alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        mean("discount").alias("avg_discount"),
        margin().alias("margin_pct"),
    )


def agg_state(df: DataFrame) -> DataFrame:
    return df.groupBy("state").agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))


def agg_sub_category(df: DataFrame) -> DataFrame:
    return df.groupBy("category", "sub_category").agg(
        F.sum("sales").alias("sales"),
        F.sum("profit").alias("profit"),
        mean("discount").alias("avg_discount"),
        margin().alias("margin_pct"),
    )
