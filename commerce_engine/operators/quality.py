"""Data-quality rules, column profile, key checks and outlier detection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import label_order, rnd
from ..functions.fingerprint import FINGERPRINT, bits, fingerprint
from ..functions.moments import merged, of_counts, population_skew, sample_deviation
from ..functions.quantiles import counted as value_counts
from ..functions.quantiles import quantiles_of

MEASURES = ["sales", "profit", "quantity", "discount", "shipping_days"]


def unless(ok: Column) -> Column:
    """Violation of a condition; a null operand violates."""
    return ~F.coalesce(ok, F.lit(False))


# The labels of the quality report, in its order.
RULES = [
    "No null order IDs",
    "No null customer IDs",
    "No null sales values",
    "No duplicate transactions",
    "Sales are non-negative",
    "Quantity is positive",
    "Discount within 0-100%",
    "Ship date on or after order date",
    "Shipping days within 0-30",
    "Country is single-valued (US)",
    "Region in expected set",
    "Segment in expected set",
    "Category in expected set",
    "Postal code is 5 chars or explicitly null",
    "Profit margin is finite",
]
DUPLICATES = RULES[3]


def column_rules(
    country: str, regions: Sequence[str], segments: Sequence[str], categories: Sequence[str]
) -> dict[str, Column]:
    """Row-level rules by label; each column is true where the rule is broken."""
    c = F.col
    finite = c("profit_margin").isNotNull() & ~F.isnan("profit_margin") & (F.abs("profit_margin") != float("inf"))
    broken = [
        c("order_id").isNull(),
        c("customer_id").isNull(),
        c("sales").isNull(),
        c("sales") < 0,
        c("quantity") <= 0,
        unless(c("discount").between(0, 1)),
        c("ship_date") < c("order_date"),
        unless(c("shipping_days").between(0, 30)),
        ~c("country").eqNullSafe(country),
        unless(c("region").isin(list(regions))),
        unless(c("segment").isin(list(segments))),
        unless(c("category").isin(list(categories))),
        c("postal_code").isNotNull() & (F.length("postal_code") != 5),
        ~finite,
    ]
    return dict(zip((r for r in RULES if r != DUPLICATES), broken, strict=True))


def validate(df: DataFrame, rules: Mapping[str, Column], ignore: Sequence[str] = ("row_id",)) -> DataFrame:
    """(rule, violations, status) in report order.

    A row is reduced to its fingerprint and one bit for each rule that it breaks. Equal
    rows share both, so one grouping of three numbers gives the duplicates (n - 1 of a
    group of n) and every other rule (n for each bit that is set).
    """
    compared = [c for c in df.columns if c not in ignore]
    rows = df.select(*[v.alias(k) for k, v in fingerprint(compared).items()], bits(list(rules.values())).alias("broken"))
    groups = rows.groupBy(*FINGERPRINT).agg(F.count("*").alias("n"), F.min("broken").alias("broken"))
    counts = {
        name: F.sum(F.when(F.col("broken").bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, F.col("n")).otherwise(0))
        for i, name in enumerate(rules)
    }
    counts[DUPLICATES] = F.sum(F.col("n") - 1)
    row = groups.agg(*[F.coalesce(v, F.lit(0)).alias(name) for name, v in counts.items()])
    status = F.when(F.col("violations") == 0, "PASS").otherwise("FAIL")
    table = row.unpivot([], list(counts), "rule", "violations")
    return table.orderBy(label_order(F.col("rule"), RULES)).withColumn("status", status)


def rules_passed(result: DataFrame) -> DataFrame:
    return result.agg(F.count_if(F.col("status") == "PASS").alias("passed"), F.count("*").alias("rules"))


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Type, completeness, cardinality and a sample value (the smallest) per column.

    Exact: values are counted as (column, value) pairs, combined before the shuffle,
    one narrow row per distinct value. ``approx`` needs a single pass without it and
    counts distinct values by sketch, about 2 % off.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    kinds = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    if approx:
        text = {c: F.col(c).cast("string") for c in df.columns}
        parts = {"non_null": F.count, "unique": lambda c: F.approx_count_distinct(c, 0.02), "sample": F.min}
        row = df.agg(F.count("*").alias("|rows"), *[f(text[c]).alias(f"{c}|{n}") for c in df.columns for n, f in parts.items()])
        cells = [F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{n}`").alias(n) for n in parts]) for c in df.columns]
        counted = row.select("`|rows`", F.explode(F.array(*cells)).alias("e")).select("e.*", (F.col("`|rows`") - F.col("e.non_null")).alias("null_count"))
    else:
        cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in df.columns]
        per_value = df.select(F.explode(F.array(*cells)).alias("e")).groupBy("e.column", "e.value").agg(F.count("*").alias("rows"))
        known = F.col("value").isNotNull()
        counted = per_value.groupBy("column").agg(
            F.coalesce(F.sum(F.when(known, F.col("rows"))), F.lit(0)).alias("non_null"),
            F.coalesce(F.sum(F.when(~known, F.col("rows"))), F.lit(0)).alias("null_count"),
            F.count_if(known).alias("unique"),
            F.min("value").alias("sample"),
        )
    share = F.try_divide(F.col("null_count") * 100.0, F.col("null_count") + F.col("non_null"))
    return counted.select(
        "column", "non_null", "null_count", "unique", "sample",
        F.element_at(kinds, F.col("column")).alias("dtype"), rnd(share, 2).alias("null_pct"),
    )


def key_uniqueness(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table: rows, distinct keys, and keys that occur more than once."""
    out = None
    for name, (df, key) in tables.items():
        per_key = df.groupBy(key).agg(F.count("*").alias("uses"))
        row = per_key.agg(
            F.coalesce(F.sum("uses"), F.lit(0)).alias("rows"),
            F.count("*").alias("keys"),
            F.count_if(F.col("uses") > 1).alias("repeated_keys"),
        ).select(F.lit(name).alias("table"), F.lit(key).alias("key"), "rows", "keys", "repeated_keys")
        out = row if out is None else out.unionByName(row)
    return out


# ------------------------------------------------------------------ outliers
def outlier_fences(df: DataFrame, measures: Sequence[str] = tuple(MEASURES)) -> DataFrame:
    """Quartiles and 1.5 IQR fences: one row per measure."""
    return fences_of(value_counts(df, measures))


def fences_of(counts: DataFrame) -> DataFrame:
    q = quantiles_of(counts, [0.0, 0.25, 0.5, 0.75, 1.0])
    named = q.select(
        "measure", "n", *[F.col("q")[i].alias(a) for i, a in enumerate(["min", "q1", "median", "q3", "max"])]
    )
    iqr = F.col("q3") - F.col("q1")
    return named.withColumns({"lower": F.col("q1") - 1.5 * iqr, "upper": F.col("q3") + 1.5 * iqr})


def by_measure(fences: DataFrame, measures: Sequence[str]) -> Column:
    """One struct with a field for each measure's fence, a scalar subquery over one row per measure."""
    limits = [c for c in fences.columns if c != "measure"]
    of = lambda m: [F.max(F.when(F.col("measure") == m, F.col(c))).alias(c) for c in limits]
    return fences.agg(F.struct(*[F.struct(*of(m)).alias(m) for m in measures]).alias("m")).scalar()


def outlier_summary(df: DataFrame, measures: Sequence[str] = tuple(MEASURES)) -> DataFrame:
    """Fences and counts outside them, counts beyond three deviations, corrected skew.

    Everything follows from one count of the rows by (measure, value): fences,
    moments, and the rows outside the limits. Limits are one row per measure.
    """
    counts = value_counts(df, measures)
    v, n = F.col("v"), F.col("cnt")
    rows = df.agg(F.count("*")).scalar()
    central = merged(of_counts(counts)).select(
        "measure", "mean", sample_deviation().alias("sigma"), population_skew().alias("g1")
    )
    known = fences_of(counts).join(central, "measure")
    limits = known.select("measure", "lower", "upper", "mean", "sigma")
    z = F.abs(F.try_divide(v - F.col("mean"), F.col("sigma")))
    beyond = counts.join(F.broadcast(limits), "measure").groupBy("measure").agg(
        F.coalesce(F.sum(F.when((v < F.col("lower")) | (v > F.col("upper")), n)), F.lit(0)).alias("iqr_outliers"),
        F.coalesce(F.sum(F.when(z > 3, n)), F.lit(0)).alias("zscore_outliers"),
    )
    two = {"min": "min", "q1": "q1", "median": "median", "q3": "q3", "max": "max", "lower": "iqr_lower", "upper": "iqr_upper"}
    return known.join(beyond, "measure").select(
        "measure",
        *[rnd(F.col(c), 2).alias(a) for c, a in two.items()],
        "iqr_outliers",
        rnd(F.col("iqr_outliers") * 100.0 / rows, 2).alias("iqr_pct"),
        "zscore_outliers",
        rnd(corrected_skew("g1", "n"), 2).alias("skew"),
    )


def corrected_skew(g1: str, n: str) -> Column:
    """Bias-corrected sample skewness from the population value."""
    x = F.col(n).cast("double")
    return F.col(g1) * F.sqrt(x * (x - 1)) / F.nullif(x - 2, F.lit(0.0))


def corrected_kurtosis(g2: str, n: str) -> Column:
    """Bias-corrected excess kurtosis from the population value."""
    x = F.col(n).cast("double")
    return (x - 1) / F.nullif((x - 2) * (x - 3), F.lit(0.0)) * ((x + 1) * F.col(g2) + 6)


def outlier_flags(df: DataFrame, measures: Sequence[str] = tuple(MEASURES)) -> DataFrame:
    """All rows with one flag per measure: outside its fence."""
    fenced = df.withColumn("_fence", by_measure(outlier_fences(df, measures).select("measure", "lower", "upper"), measures))
    flags = {}
    for m in measures:
        v = F.col(m).cast("double")
        fence = F.col(f"_fence.{m}")
        flags[f"{m}_outlier"] = F.coalesce((v < fence["lower"]) | (v > fence["upper"]), F.lit(False))
    return fenced.withColumns(flags).drop("_fence")


def any_outlier(measures: Sequence[str]) -> Column:
    return F.array_contains(F.array(*[F.col(f"{m}_outlier") for m in measures]), True)


def outlier_rows(df: DataFrame, measures: Sequence[str] = tuple(MEASURES)) -> DataFrame:
    """Rows outside the fence of any measure, with one flag per measure."""
    return outlier_flags(df, measures).where(any_outlier(measures))


def outlier_share(df: DataFrame, measures: Sequence[str] = tuple(MEASURES)) -> DataFrame:
    flagged = F.count_if(any_outlier(measures))
    return outlier_flags(df, measures).agg(
        flagged.alias("flagged_rows"), F.round(flagged * 100.0 / F.count("*"), 1).alias("flagged_pct")
    )
