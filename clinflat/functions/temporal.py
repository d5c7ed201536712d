"""Dates and times that arrive as text and may be partial ("2020", "2020-06")."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO 8601 forms a record may carry, and the widest zone offsets.
DATETIME_PATTERN = (
    r"^(\d{4})(?:-(\d{2})(?:-(\d{2})(?:T(\d{2})(?::(\d{2})(?::(\d{2})(?:\.(\d+))?)?)?"
    r"(Z|[+-]\d{2}:\d{2})?)?)?)?$"
)
INSTANT_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
TIME_PATTERN = r"^(\d{2})(?::(\d{2})(?::(\d{2})(?:\.(\d+))?)?)$"
OFFSET_PATTERN = r"(Z|[+-]\d{2}:\d{2})$"
EARLIEST_OFFSET = "+14:00"
LATEST_OFFSET = "-12:00"


def to_full_date(c: Column) -> Column:
    """First ten characters as a date; partial dates give null."""
    day = F.substr(c, F.lit(1), F.lit(10))
    return F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), day.try_cast("date"))


def to_local_timestamp(c: Column) -> Column:
    """Text with an offset as a zone-less timestamp in the session zone; a year or a
    year and month give null."""
    return F.when(F.length(c) >= 10, c.try_cast("timestamp")).cast("timestamp_ntz")


def compare_partial(a: Column, b: Column) -> Column:
    """-1, 0 or 1, or null when one side is less precise and the shared part is equal.

    Two full instants with offsets compare as points in time; otherwise the written
    components compare one by one and offsets are ignored.
    """

    def parts(c: Column) -> Column:
        bare = F.when(c.contains("T"), F.regexp_replace(c, OFFSET_PATTERN, "")).otherwise(c)
        return F.split(bare, "[-T:.]")

    def order(x: Column, y: Column) -> Column:
        return F.when(x < y, -1).when(x > y, 1).otherwise(0)

    def order_text(x: Column, y: Column) -> Column:
        width = F.greatest(F.length(x), F.length(y))
        return order(F.rpad(x, width, F.lit("0")), F.rpad(y, width, F.lit("0")))

    at, bt = a.try_cast("timestamp"), b.try_cast("timestamp")
    instants = a.rlike(INSTANT_PATTERN) & b.rlike(INSTANT_PATTERN) & at.isNotNull() & bt.isNotNull()
    pa, pb = parts(a), parts(b)
    shared = F.least(F.size(pa), F.size(pb))
    signs = F.zip_with(F.slice(pa, F.lit(1), shared), F.slice(pb, F.lit(1), shared), order_text)
    first_difference = F.get(F.filter(signs, lambda s: s != 0), F.lit(0))
    by_parts = F.coalesce(first_difference, F.when(F.size(pa) == F.size(pb), 0))
    return F.when(a.isNotNull() & b.isNotNull(), F.when(instants, order(at, bt)).otherwise(by_parts))


def _pieces(c: Column, pattern: str, n: int) -> list[Column]:
    return [F.nullif(F.regexp_extract(c, pattern, i + 1), F.lit("")) for i in range(n)]


def _date_or_datetime_boundary(c: Column, low: bool, as_datetime: Column) -> Column:
    year, month, day, hour, minute, second, fraction, offset = _pieces(c, DATETIME_PATTERN, 8)
    month = F.coalesce(month, F.lit("01" if low else "12"))
    month_start = F.concat(year, F.lit("-"), month, F.lit("-01")).try_cast("date")
    last_day = F.date_format(F.last_day(month_start), "dd")
    day = F.coalesce(day, F.lit("01") if low else last_day)
    date_text = F.concat_ws("-", year, month, day)
    date_text = F.when(day.isNotNull(), date_text)
    two_digits = "00" if low else "59"
    time_text = F.concat(
        F.coalesce(hour, F.lit("00" if low else "23")),
        F.lit(":"),
        F.coalesce(minute, F.lit(two_digits)),
        F.lit(":"),
        F.coalesce(second, F.lit(two_digits)),
        F.lit("."),
        F.coalesce(fraction, F.lit("000" if low else "999")),
        F.coalesce(offset, F.lit(EARLIEST_OFFSET if low else LATEST_OFFSET)),
    )
    full = F.concat(date_text, F.lit("T"), time_text)
    return F.when(c.rlike(DATETIME_PATTERN), F.when(as_datetime, full).otherwise(date_text))


def _time_boundary(c: Column, low: bool) -> Column:
    hour, minute, second, fraction = _pieces(c, TIME_PATTERN, 4)
    rest = F.lit("00" if low else "59")
    text = F.concat(
        hour, F.lit(":"), F.coalesce(minute, rest), F.lit(":"), F.coalesce(second, rest), F.lit("."),
        F.coalesce(fraction, F.lit("000" if low else "999")),
    )
    return F.when(c.rlike(TIME_PATTERN), text)


def _decimal_boundary(c: Column, low: bool) -> Column:
    """``c`` is the number as written, because trailing zeros count as precision. Up to 20
    whole digits and 17 places; longer numbers are an error."""
    exponent = F.coalesce(F.regexp_extract(c, r"[eE]([+-]?\d+)$", 1).try_cast("int"), F.lit(0))
    written = F.length(F.regexp_extract(c, r"\.(\d+)", 1))
    places = F.greatest(written - exponent, F.lit(0))
    half = F.concat(F.lit("0."), F.repeat(F.lit("0"), places), F.lit("5")).try_cast("decimal(38,18)")
    value = c.try_cast("decimal(38,18)")
    number = c.rlike(r"^[+-]?\d+(\.\d+)?([eE][+-]?\d+)?$")
    too_long = number & (value.isNull() | (places >= 18))
    error = F.raise_error(F.lit("a number has more digits than its boundaries can be computed with"))
    return F.when(too_long, error).otherwise((value - half if low else value + half).cast("double"))


def low_boundary(c: Column, kind: str) -> Column:
    """Earliest value that the written text can stand for; ``kind`` is date, dateTime,
    time or decimal."""
    return _boundary(c, kind, True)


def high_boundary(c: Column, kind: str) -> Column:
    """Latest value that the written text can stand for."""
    return _boundary(c, kind, False)


def _boundary(c: Column, kind: str, low: bool) -> Column:
    if kind == "date":
        return _date_or_datetime_boundary(c, low, c.contains("T"))
    if kind in ("dateTime", "instant"):
        return _date_or_datetime_boundary(c, low, F.lit(True))
    if kind == "time":
        return _time_boundary(c, low)
    if kind == "decimal":
        return _decimal_boundary(c, low)
    raise ValueError(f"no boundary for {kind!r}")
