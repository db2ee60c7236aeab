"""Dates in mixed notation: the class of a cell's tokens decides how it is read, once.

A cell is cut into runs of digits and letters. Each run has a kind (one or two digits,
four digits, eight digits, name of a month), and the string of kinds is the cell's
class: ``2018-11-08`` and ``2018/11/8`` are both "ynn". The class says where year, month
and day stand; the three are put in order and read as an ISO date, so a cell meets one
reader at most. A time of day and a weekday are left out first.

All-number dates have the month first, unless the first number is above 12 and can only
be a day. Two-digit years from 69 on are of the last century. A class that is not listed,
or a day that does not exist, gives null; :func:`unreadable` reports such cells by shape.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# English names of months and weekdays.
MONTHS = [
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november",
    "december",
]
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"

ISO = r"^\d{4}-\d{2}-\d{2}$"
#: The two commonest classes in plain notation, "ynn" and "nny", which need no tokens.
YEAR_FIRST = r"^\d{4}([-/.])\d{1,2}\1\d{1,2}\z"
YEAR_LAST = r"^\d{1,2}([-/.])\d{1,2}\1\d{4}\z"
TIME = (
    r"[T ]\s*([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d([.,]\d+)?)?\s*([AaPp]\.?[Mm]\.?)?\s*(Z|UTC|GMT|[+-]\d{2}:?\d{2})?$"
)
#: Between runs, at an ordinal's ending, and where digits meet letters.
CUT = r"[^0-9A-Za-z]+|(?<=[0-9])(?:st|nd|rd|th)(?![A-Za-z])|(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"


def _names(full: Sequence[str], *more: str) -> str:
    """A SQL list of full names, their first three letters and further spellings."""
    return ", ".join(f"'{n}'" for n in [*full, *(n[:3] for n in full), *more])


def tokens(text: str) -> str:
    """SQL: runs of digits and letters in lower case, without time of day and weekday."""
    day = f"CASE WHEN contains({text}, ':') THEN regexp_replace({text}, r'{TIME}', '') ELSE {text} END"
    skipped = "'', " + _names(WEEKDAYS, "tues", "wednes", "thur", "thurs")
    return f"filter(split(lower(trim({day})), r'{CUT}'), t -> t NOT IN ({skipped}))"


#: SQL: one letter a token of ``p``: n (one or two digits), y (four), z (eight), m (month), ? (anything else).
KINDS = f"""array_join(transform(p, t -> CASE
    WHEN translate(t, '{DIGITS}', '') = '' THEN CASE WHEN length(t) <= 2 THEN 'n' WHEN length(t) = 4 THEN 'y' WHEN length(t) = 8 THEN 'z' ELSE '?' END
    WHEN t IN ({_names(MONTHS, "sept")}) THEN 'm' ELSE '?' END), '')"""


def _in_order() -> str:
    """SQL: year-month-day of the tokens ``p`` as text, by class ``k``."""
    a, b, c = "p[0]", "p[1]", "p[2]"
    months = ", ".join(f"'{m[:3]}'" for m in MONTHS)

    def iso(year: str, month: str, day: str) -> str:
        return f"concat_ws('-', {year}, {month}, {day})"

    def of_month(t: str) -> str:
        return f"CAST(array_position(array({months}), left({t}, 3)) AS STRING)"

    def century(t: str) -> str:
        return f"concat(CASE WHEN CAST({t} AS INT) >= 69 THEN '19' ELSE '20' END, lpad({t}, 2, '0'))"

    def first_above(limit: int, yes: str, no: str) -> str:
        return f"CASE WHEN CAST({a} AS INT) > {limit} THEN {yes} ELSE {no} END"

    by_class = {
        "ynn": iso(a, b, c),
        "nny": first_above(12, iso(c, b, a), iso(c, a, b)),
        "mny": iso(c, of_month(a), b),
        "nmy": iso(c, of_month(b), a),
        "z": iso(f"substr({a}, 1, 4)", f"substr({a}, 5, 2)", f"substr({a}, 7, 2)"),
        "ymn": iso(a, of_month(b), c),
        "ynm": iso(a, of_month(c), b),
        "nnn": first_above(31, iso(century(a), b, c), first_above(12, iso(century(c), b, a), iso(century(c), a, b))),
        "mnn": iso(century(c), of_month(a), b),
        "nmn": first_above(31, iso(century(a), of_month(b), c), iso(century(c), of_month(b), a)),
    }
    return "CASE k " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in by_class.items()) + " END"


def read_date(c: str) -> Column:
    """The date a text column shows, null if it shows none.

    One SQL text: ``transform(array(x), p -> ...)[0]`` names a value that is computed once.
    """
    text = f"`{c}`"
    mixed = f"transform(array({tokens(text)}), p -> transform(array({KINDS}), k -> {_in_order()})[0])[0]"
    dashed = f"translate({text}, '/.', '--')"
    a, b, c = (f"split_part({dashed}, '-', {i})" for i in (1, 2, 3))
    year_last = f"CASE WHEN CAST({a} AS INT) > 12 THEN concat_ws('-', {c}, {b}, {a}) ELSE concat_ws('-', {c}, {a}, {b}) END"
    return F.expr(f"""CASE WHEN {text} RLIKE r'{ISO}' THEN try_cast({text} AS DATE)
        WHEN {text} RLIKE r'{YEAR_FIRST}' THEN try_cast({dashed} AS DATE)
        WHEN {text} RLIKE r'{YEAR_LAST}' THEN try_cast({year_last} AS DATE)
        ELSE try_cast({mixed} AS DATE) END""")


def shape(text: Column) -> Column:
    """A text with 9 for each digit and a for each letter."""
    return F.translate(text, DIGITS + LOWER + LOWER.upper(), "9" * 10 + "a" * 52)


def unreadable(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, shape, cells, example) of the texts that show no date."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("text"), read_date(c).alias("day")) for c in columns])
    open_ = df.select(F.explode(cells).alias("e")).select("e.*").where("text is not null and day is null")
    return open_.groupBy("column", shape(F.col("text")).alias("shape")).agg(F.count("*").alias("cells"), F.min("text").alias("example"))
