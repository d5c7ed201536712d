"""Text and number helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_name(c: Column) -> Column:
    """Drop digits and outer blanks from a person's name; nothing left gives null."""
    return F.nullif(F.trim(F.regexp_replace(c, "[0-9]+", "")), F.lit(""))


def strip_dots(c: Column) -> Column:
    return F.replace(c, F.lit("."), F.lit(""))


def substring_from(c: Column, start: int, length: int | None = None) -> Column:
    """Zero-based substring; a start outside the text gives null."""
    if start < 0:
        return F.when(F.lit(False), c)
    n = F.length(c) if length is None else F.lit(length)
    return F.when(F.length(c) > start, F.substr(c, F.lit(start + 1), n))


def to_integer(c: Column) -> Column:
    """Whole-number text to bigint; any other text gives null."""
    return F.when(c.rlike(r"^[+-]?\d+$"), c.try_cast("bigint"))


def to_decimal(c: Column) -> Column:
    """Plain decimal text to double; any other text gives null."""
    return F.when(c.rlike(r"^[+-]?\d+(\.\d+)?$"), c.try_cast("double"))


def equivalent(a: Column, b: Column) -> Column:
    """Equality that ignores case and runs of blanks, and treats two nulls as equal."""

    def norm(c: Column) -> Column:
        return F.lower(F.regexp_replace(F.regexp_replace(c, r"^\s+|\s+$", ""), r"\s+", " "))

    return norm(a).eqNullSafe(norm(b))


def floor_mod(a: Column, b: Column) -> Column:
    """Remainder with the sign of the divisor; null when the divisor is zero."""
    return F.try_mod(F.try_mod(a, b) + b, b)


def number_text(c: Column) -> Column:
    """Shortest text of a double in plain notation between 1e-4 and 1e16, with a
    two-digit exponent outside that range."""
    size = F.abs(c)
    plain_text = F.regexp_replace(c.cast("decimal(38,17)").cast("string"), r"(\.\d+?)0+$", "$1")
    wide_text = F.regexp_replace(c.cast("decimal(38,10)").cast("string"), r"(\.\d+?)0+$", "$1")
    text = c.cast("string")
    exponent = F.regexp_replace(text, r"(\.0)?E", "e")
    exponent = F.regexp_replace(exponent, r"e(\d)", "e+$1")
    exponent = F.regexp_replace(exponent, r"e([+-])(\d)$", "e$10$2")
    return (
        F.when(((size >= 1e-3) & (size < 1e7)) | (size == 0) | F.isnan(c), text)
        .when((size >= 1e7) & (size < 1e16), wide_text)
        .when((size >= 1e-4) & (size < 1e-3), plain_text)
        .otherwise(exponent)
    )


#: Decimal places to which amounts are rounded before they are summed; a parameter of every plan that sums.
AMOUNT_PLACES = 4


def exact_sum(c: Column, places: int = AMOUNT_PLACES) -> Column:
    """Sum of amounts, each rounded to ``places`` decimals; up to 28 digits in all. Summing
    decimals keeps the result the same however the rows are spread over partitions, which a
    sum of doubles does not."""
    return F.sum(c.cast(f"decimal(28,{places})")).cast("double")
