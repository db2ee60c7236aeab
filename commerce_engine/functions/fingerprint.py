"""Row fingerprints: 128 bits over all values of a row, nulls told apart from every value.

A group of rows is known by two numbers instead of its texts, so it is hashed, shuffled
and counted in a few bytes. Counts taken by fingerprint alone would be off by a collision,
whose chance is below 1e-14 on 1e12 rows; rows are only ever dropped after a comparison
of all their values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINGERPRINT = ["_fp1", "_fp2"]
SALT = 0x5EED


def bits(tests: Sequence[Column]) -> Column:
    """The tests as bits of one number, the first one lowest; at most 62. A test that is null counts as false."""
    if len(tests) > 62:
        raise ValueError("at most 62 tests fit")
    one = [F.when(t, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, t in enumerate(tests)]
    return reduce(lambda a, b: a.bitwiseOR(b), one)


def null_bits(columns: Sequence[str]) -> str:
    """SQL: as :func:`bits`, of the columns that are null."""
    return "(" + " | ".join(f"CASE WHEN `{c}` IS NULL THEN {1 << i}L ELSE 0L END" for i, c in enumerate(columns)) + ")"


def fingerprint(columns: Sequence[str]) -> dict[str, Column]:
    """Two 64-bit hashes over the columns and over which of them are null (a hash alone skips nulls)."""
    nulls = [null_bits(columns[i : i + 62]) for i in range(0, len(columns), 62)]
    values = [f"`{c}`" for c in columns]
    hashes = [*nulls, *values], [str(SALT), *reversed(values), *nulls]
    return {name: F.expr(f"xxhash64({', '.join(parts)})") for name, parts in zip(FINGERPRINT, hashes)}


#: Marks are bits of 2^20 words of 64: what they take is bounded, whatever they stand for.
MARK_BITS = 26


def _word_and_bit(hash_: str) -> tuple[Column, Column]:
    spot = F.col(hash_).bitwiseAND(F.lit((1 << MARK_BITS) - 1).cast("bigint"))
    return F.shiftright(spot, 6), spot.bitwiseAND(F.lit(63).cast("bigint")).cast("int")


def marks(df: DataFrame, hash_: str) -> DataFrame:
    """(word, mask): a bit for each value of a hash column, at most 2^20 rows of two numbers."""
    word, bit = _word_and_bit(hash_)
    mask = F.expr("bit_or(shiftleft(1L, _bit))")
    return df.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(mask.alias("_mask"))


def in_marks(df: DataFrame, known: DataFrame, hash_: str, marked: bool) -> DataFrame:
    """The rows whose hash is marked, or all the others. Marks are of bounded size, so they are sent to all."""
    word, bit = _word_and_bit(hash_)
    found = F.coalesce(F.getbit("_mask", bit) == 1, F.lit(False))
    both = df.join(F.broadcast(known), word == F.col("_word"), "inner" if marked else "left")
    return both.where(found if marked else ~found).select(*df.columns)
