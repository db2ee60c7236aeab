"""Raw extract to clean order lines. The order of the steps is part of the result.

:class:`Cleaning` evaluates an extract once: readable dates and row fingerprints are
computed while the complete rows are written to a stage table, and the counts of the
audit are observed in that write. Everything later reads the stage table.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import NUMBER, appearance, first_rows, number_from, percent, ratio, rnd
from ..functions.dates import read_date as parse_date
from ..functions.fingerprint import FINGERPRINT, fingerprint, in_marks, marks, null_bits
from ..session import materialize
from ..sources.extract import MALFORMED

CRITICAL = ["order_date", "customer_id", "product_id", "sales", "quantity"]
DATES = ["order_date", "ship_date"]
MEASURE_TYPES = {"sales": "decimal(18,4)", "quantity": "int", "discount": "decimal(4,2)", "profit": "decimal(18,4)"}
NUMERIC_TEXT = [*MEASURE_TYPES, "postal_code"]

# Texts read as null.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def standardise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[re.sub("[ -]", "_", c.strip().lower()) for c in df.columns])


def null_tokens_to_null(df: DataFrame) -> DataFrame:
    tokens = ", ".join(f"'{t}'" for t in NULL_TOKENS)
    return df.selectExpr(*[f"`{c}`" if c == MALFORMED else f"CASE WHEN `{c}` NOT IN ({tokens}) THEN `{c}` END AS `{c}`" for c in df.columns])


def prepare(raw: DataFrame) -> DataFrame:
    """Names and nulls as a reader of the extract sees them."""
    return null_tokens_to_null(standardise_names(raw))


def all_critical_null() -> Column:
    return F.coalesce(*[F.col(c) for c in CRITICAL]).isNull()


def any_critical_null() -> Column:
    return F.array_contains(F.array(*[F.col(c).isNull() for c in CRITICAL]), True)


def drop_shells(df: DataFrame) -> DataFrame:
    """Rows that carry no transaction detail at all."""
    return df.dropna(how="all", subset=CRITICAL)


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna(how="any", subset=CRITICAL)


#: Numbers whose spelling is only short of trailing zeros.
PLAIN = r"^(-?[1-9][0-9]{0,18}|0)([.][0-9]{1,8})?$"


def numeric_text(c: str) -> Column:
    """One spelling per number ("12.5" = "12.50"), with eight decimals; other text unchanged.

    Plain numbers are filled up with zeros; only unusual spellings are read as numbers.
    """
    text = f"`{c}`"
    filled = f"""CASE WHEN instr({text}, '.') = 0 THEN concat({text}, '.00000000')
        ELSE concat({text}, substring('00000000', length({text}) - instr({text}, '.') + 1, 8)) END"""
    read = f"CASE WHEN {text} RLIKE r'{NUMBER}' THEN CAST(try_cast({text} AS DECIMAL(28,8)) AS STRING) END"
    return F.expr(f"CASE WHEN {text} RLIKE r'{PLAIN}' THEN {filled} ELSE coalesce({read}, {text}) END")


def comparable(df: DataFrame) -> DataFrame:
    """Numbers in one spelling, and the fingerprint of everything but the row id."""
    rest = [c for c in df.columns if c not in ("row_id", *(f"_{d}" for d in DATES))]
    return df.withColumns({c: numeric_text(c) for c in NUMERIC_TEXT}).withColumns(fingerprint(rest))


def first_of_each(df: DataFrame) -> DataFrame:
    """One row, the lowest row id, per group of :func:`comparable` rows equal in every other column (null = null).

    Rows are put in order by fingerprint, which nearly always decides, then by all
    columns, so only true copies fall together. The rank limit is applied before the
    shuffle too: a group of copies of any size arrives as one row per input partition.
    """
    rest = [c for c in df.columns if c != "row_id" and c not in FINGERPRINT]
    return first_rows(df, [*FINGERPRINT, *rest], appearance()).drop(*FINGERPRINT)


def repeated(rows: DataFrame) -> DataFrame:
    """Marks of the fingerprints that occur more than once; a table of bounded size, written once.

    One number a row is shuffled. A mark may be shared by a row without copies, which
    then is compared for nothing; no copy is without one.
    """
    uses = rows.groupBy("_fp1").agg(F.count("*").alias("uses"))
    return materialize(marks(uses.where("uses > 1"), "_fp1"), "repeated")


def without_copies(rows: DataFrame) -> DataFrame:
    """As :func:`first_of_each`, of a written table: only rows of a repeated fingerprint are shuffled and compared."""
    known = repeated(rows)
    alone = in_marks(rows, known, "_fp1", False).drop(*FINGERPRINT)
    return alone.unionByName(first_of_each(in_marks(rows, known, "_fp1", True)))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """As :func:`first_of_each`, of rows as they come; numbers in one spelling. The rows are written once."""
    return without_copies(materialize(comparable(df), "comparable")).select(*df.columns)


def parse_measures(df: DataFrame) -> DataFrame:
    """Numbers; what cannot be read becomes null, the row stays."""
    return df.withColumns({c: number_from(c, "decimal(28,8)").try_cast(t) for c, t in MEASURE_TYPES.items()})


def postal_text(c: str = "postal_code") -> Column:
    """A code read as a number back to text, zero-padded to five; null stays null."""
    digits = number_from(c, "double").cast("bigint").cast("string")
    return F.when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(digits)


PLACE = ["state", "city"]


def common_postal_codes(df: DataFrame, *same: str) -> DataFrame:
    """Most frequent code of each (state, city); the lowest code wins a tie.

    Columns in ``same`` tell rows apart that are to count once: with them, a frame may
    still hold its duplicates.
    """
    codes = df.dropna(subset=[*PLACE, "postal_code"]).select(*PLACE, "postal_code", *same)
    counts = (codes.distinct() if same else codes).groupBy(*PLACE, "postal_code").agg(F.count("*").alias("uses"))
    best = first_rows(counts, PLACE, [F.desc("uses"), F.asc("postal_code")])
    return best.select(*PLACE, F.col("postal_code").alias("common_code"))


def impute_postal(df: DataFrame, codes: DataFrame | None = None, flag: str | None = None) -> DataFrame:
    filled = df.join(common_postal_codes(df) if codes is None else codes, PLACE, "left")
    code = F.coalesce("postal_code", "common_code")
    extra = [(F.col("postal_code").isNull() & code.isNotNull()).alias(flag)] if flag else []
    return filled.select(*[code.alias(c) if c == "postal_code" else F.col(c) for c in df.columns], *extra)


# The characters that Unicode calls white space.
BLANKS = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def trim_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.trim(c, F.lit(BLANKS)) for c, t in df.dtypes if t == "string"})


IMPUTED = "_imputed"


class Cleaning:
    """One extract, read once.

    Building it writes the complete rows (and malformed ones, which go no further) with
    their dates and fingerprints. The write is a result stage without a shuffle, so the
    observed counts are exact even if executors are lost. A row's dates are read once,
    only rows of a repeated fingerprint are shuffled to drop duplicates, and postal codes
    are counted from the three columns of the rows that remain.
    """

    def __init__(self, raw: DataFrame):
        rows = prepare(raw)
        if MALFORMED not in rows.columns:
            rows = rows.withColumn(MALFORMED, F.lit(None).cast("string"))
        self.columns = [c for c in rows.columns if c != MALFORMED]
        rows = rows.withColumns({f"_{d}": parse_date(d) for d in DATES})
        good, bad = F.col(MALFORMED).isNull(), F.col(MALFORMED).isNotNull()
        seen = Observation()
        counted = rows.observe(
            seen,
            F.count_if(good).alias("loaded"),
            F.count_if(bad).alias("malformed"),
            F.count_if(good & all_critical_null()).alias("shells"),
            F.count_if(good & ~all_critical_null() & any_critical_null()).alias("incomplete"),
            *[F.count_if(good & F.col(d).isNotNull() & F.col(f"_{d}").isNull()).alias(f"odd{d}") for d in DATES],
        )
        complete = counted.where(bad | ~any_critical_null())
        self._stage = materialize(_with_fingerprint(complete), "extract")
        self.seen: dict[str, int] = seen.get

    @property
    def rows(self) -> DataFrame:
        """Complete rows, duplicates included, with fingerprints and dates."""
        return self._stage.where(F.col(MALFORMED).isNull()).drop(MALFORMED)

    def malformed(self) -> DataFrame:
        """The text of the rows that do not have the extract's columns."""
        return self._stage.where(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("line"))

    def typed(self) -> DataFrame:
        """Without duplicates, dates and numbers typed, postal codes as text."""
        dated = self.distinct.withColumns({d: F.col(f"_{d}") for d in DATES})
        return parse_measures(dated).withColumn("postal_code", postal_text()).select(*self.columns)

    @cached_property
    def distinct(self) -> DataFrame:
        """The stage's rows without their duplicates; the first use writes the marks of what is repeated."""
        return without_copies(self.rows)

    def common_codes(self) -> DataFrame:
        """As :func:`common_postal_codes` of the typed rows."""
        return common_postal_codes(self.distinct.withColumn("postal_code", postal_text()))

    def cleaned(self, flag: str | None = None) -> DataFrame:
        """All steps over the stage table. One row a place is written first, so that its true size decides how it joins."""
        return trim_text(impute_postal(self.typed(), materialize(self.common_codes(), "codes"), flag))

    def observed(self) -> tuple[DataFrame, Observation]:
        """The cleaned rows, and what :meth:`audit` needs to know once they have been written."""
        kept = Observation()
        return self.cleaned(IMPUTED).observe(kept, *kept_counts()).drop(IMPUTED), kept

    def audit(self, kept: Observation | None = None) -> DataFrame:
        """Rows loaded, removed per step, imputed, left open and kept.

        ``kept`` are the observed counts of a write; without them the rows are counted.
        """
        spark = self._stage.sparkSession
        if isinstance(kept, Observation):
            row = spark.range(1).select(*[F.lit(v).cast("bigint").alias(k) for k, v in kept.get.items()])
        else:
            row = self.cleaned(IMPUTED).agg(*kept_counts())
        n, c = {k: F.lit(v).cast("bigint") for k, v in self.seen.items()}, F.col
        steps = {
            "rows loaded": n["loaded"],
            "shell rows removed": n["shells"],
            "incomplete rows removed": n["incomplete"],
            "duplicates removed": n["loaded"] - n["shells"] - n["incomplete"] - c("kept"),
            "postal codes imputed": c("imputed"),
            "postal codes still missing": c("missing"),
            "ship date before order date": c("early"),
            "order dates unreadable": n["oddorder_date"],
            "ship dates unreadable": n["oddship_date"],
            "rows kept": c("kept"),
            "rows dropped": n["loaded"] - c("kept"),
        }
        if self.seen["malformed"]:
            steps["malformed rows set aside"] = n["malformed"]
        return row.select(*[v.alias(k) for k, v in steps.items()]).unpivot([], list(steps), "step", "rows")


def _with_fingerprint(df: DataFrame) -> DataFrame:
    return comparable(df.withColumnRenamed(MALFORMED, "_m")).withColumnRenamed("_m", MALFORMED)


def kept_counts() -> list[Column]:
    return [
        F.count_if(IMPUTED).alias("imputed"),
        F.count_if(F.col("postal_code").isNull()).alias("missing"),
        F.count_if(F.col("ship_date") < F.col("order_date")).alias("early"),
        F.count("*").alias("kept"),
    ]


def typed(raw: DataFrame) -> DataFrame:
    return Cleaning(raw).typed()


def clean(raw: DataFrame) -> DataFrame:
    """All steps; building the result writes the stage table."""
    return Cleaning(raw).cleaned()


def unresolved_postal(cleaned: DataFrame) -> DataFrame:
    """Places whose code the data never supplies, with the rows concerned."""
    return cleaned.where("postal_code is null").groupBy("city", "state").agg(F.count("*").alias("lines"))


def ship_before_order(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("ship_date") < F.col("order_date")).alias("ship_before_order"))


def cleaning_audit(raw: DataFrame) -> DataFrame:
    """Rows loaded, removed per step, imputed, left open and kept, from one reading of the extract."""
    return Cleaning(raw).audit()


def validated_totals(cleaned: DataFrame) -> DataFrame:
    orders = F.count_distinct("order_id")
    return cleaned.agg(
        F.round(F.sum("sales"), 2).alias("total_sales"),
        F.round(F.sum("profit"), 2).alias("total_profit"),
        rnd(percent(F.sum("profit"), F.sum("sales")), 2).alias("margin_pct"),
        orders.alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("product_id").alias("products"),
        rnd(ratio(F.sum("sales"), orders), 2).alias("avg_order_value"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
    )


def shell_diagnosis(raw: DataFrame) -> DataFrame:
    """What the rows without sales still hold, and how many raw rows are exact copies.

    Every row is reduced to its fingerprint and a bit for each null column; equal rows
    share both, so all counts follow from one grouping of three numbers.
    """
    df = prepare(raw)
    groups = df.select(*[v.alias(k) for k, v in fingerprint(df.columns).items()], F.expr(null_bits(df.columns)).alias("nulls"))
    groups = groups.groupBy(*FINGERPRINT).agg(F.count("*").alias("n"), F.min("nulls").alias("nulls"))

    def null(c: str) -> Column:
        return F.col("nulls").bitwiseAND(F.lit(1 << df.columns.index(c)).cast("bigint")) != 0

    shell = null("sales")
    empty = [F.every(null(c) | ~shell).cast("int") for c in df.columns]
    return groups.agg(
        F.coalesce(F.sum(F.when(shell, F.col("n"))), F.lit(0)).alias("rows_without_sales"),
        F.coalesce(F.sum(F.when(shell & ~null("order_id"), F.col("n"))), F.lit(0)).alias("with_order_id"),
        sum(empty[1:], empty[0]).cast("bigint").alias("columns_always_null"),
        F.sum(F.col("n") - 1).alias("exact_duplicates"),
    )
