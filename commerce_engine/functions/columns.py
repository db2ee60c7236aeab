"""Column helpers shared by all operators. Money stays DECIMAL, ratios are DOUBLE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dbl(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def money(c: Column | str) -> Column:
    """SUM rounded to cents, computed and rounded in DECIMAL."""
    return F.round(F.sum(c), 2)


NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number_from(text: str, kind: str) -> Column:
    """A text column as numbers, null where it shows none.

    The pattern is looked at first: a cast that fails builds an error message for every
    cell before it gives null, some fifty times the cost of one that succeeds.
    """
    return F.expr(f"CASE WHEN `{text}` RLIKE r'{NUMBER}' THEN try_cast(`{text}` AS {kind}) END")


def appearance(row_id: str = "row_id") -> list[Column]:
    """Sort order of first appearance: row numbers as numbers, any other row id behind them as text."""
    return [number_from(row_id, "decimal(38,0)").asc_nulls_last(), F.col(row_id).asc()]


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key. The rank limit cuts each partition to one row a key before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def ratio(p: Column, q: Column) -> Column:
    """p / q in DOUBLE; NULL when q is 0."""
    return F.try_divide(dbl(p), dbl(q))


def rnd(c: Column, digits: int) -> Column:
    """Round a DOUBLE half away from zero by way of DECIMAL, so 0.125 behaves like 0.125."""
    return F.round(c.try_cast("decimal(38,10)"), digits).cast("double")


def percent(p: Column, q: Column) -> Column:
    return F.try_divide(dbl(p) * 100, dbl(q))


def margin_pct(profit: str = "profit", sales: str = "sales", digits: int = 2) -> Column:
    return rnd(percent(F.sum(profit), F.sum(sales)), digits)


def mean(c: Column | str) -> Column:
    """AVG as exact sum over count, so the value does not depend on row order."""
    return ratio(F.sum(c), F.count(c))


def mean_pct(c: Column | str, digits: int) -> Column:
    return rnd(mean(c) * 100, digits)


def divide_or(p: Column, q: Column, alternate: float = 0.0) -> Column:
    """p / q with a stated result for a zero or missing denominator."""
    return F.coalesce(ratio(p, q), F.lit(alternate))


def exact_sum(c: Column, digits: int = 6) -> Column:
    """Sum of a DOUBLE fixed to ``digits`` decimals first: independent of row order, no overflow."""
    scale = 10.0**digits
    return F.sum(F.rint(c * scale).cast("bigint").cast("decimal(19,0)")).cast("double") / scale


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Present DECIMAL columns as DOUBLE at the output boundary."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def cut(c: Column, edges: Sequence[float | Column], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edges[i], edges[i+1]]``; NULL outside all of them."""
    if len(edges) != len(labels) + 1:
        raise ValueError("cut needs one more edge than labels")
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        hit = (c > low) & (c <= high)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out


def qcut(c: Column, edges: Sequence[Column], labels: Sequence) -> Column:
    """Quantile bins from the inner edges; equal values share a bin."""
    if len(labels) != len(edges) + 1:
        raise ValueError("qcut needs one more label than inner edges")
    position = sum(((c > e).cast("int") for e in edges), F.lit(1))
    return F.when(c.isNotNull(), F.element_at(F.array(*[F.lit(x) for x in labels]), position))


def label_order(c: Column, labels: Sequence[str]) -> Column:
    """Sort position of a label in a fixed list; unknown labels come last."""
    return F.coalesce(
        F.nullif(F.array_position(F.array(*[F.lit(x) for x in labels]), c), F.lit(0)),
        F.lit(len(labels) + 1),
    )


def share(c: Column, total: Column, digits: int = 2) -> Column:
    return rnd(percent(c, total), digits)


def display_thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def display_money(c: Column, scale: float, digits: int, suffix: str) -> Column:
    return F.concat(F.lit("$"), F.format_string(f"%.{digits}f", dbl(c) / scale), F.lit(suffix))
