"""Dates, times, numbers and code decoding."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column

__all__ = [
    "hhmm", "hour_minute_unpadded", "date_from_parts", "since", "decode", "null_if_zero",
    "parse_dose", "to_inches", "to_pounds", "decimal_of", "row_key", "covers", "null_of",
]


def null_of(kind: str) -> Column:
    return F.lit(None).cast(kind)


def hhmm(c: str | Column) -> Column:
    return F.date_format(as_column(c), "HH:mm")


def hour_minute_unpadded(c: str | Column) -> Column:
    return F.concat(F.hour(as_column(c)), F.lit(":"), F.minute(as_column(c)))


def date_from_parts(year: str | Column, month: str | Column, day: str | Column) -> Column:
    """Date from its parts; an unknown month or day counts as the first."""
    m = F.coalesce(as_column(month), F.lit(1)).cast("int")
    d = F.coalesce(as_column(day), F.lit(1)).cast("int")
    return F.make_date(as_column(year).cast("int"), m, d)


def since(c: str | Column, floor: date) -> Column:
    """Date on or after the floor, written so that the scan can use it."""
    return as_column(c) >= F.lit(floor)


def decode(c: str | Column, codes: Mapping[int, object], default: object = None) -> Column:
    """Plain code table as one CASE expression."""
    source = as_column(c)
    out: Column | None = None
    for code, value in codes.items():
        out = F.when(source == code, F.lit(value)) if out is None else out.when(source == code, F.lit(value))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def null_if_zero(c: str | Column) -> Column:
    return F.nullif(as_column(c), F.lit(0))


def decimal_of(c: str | Column, precision: int, scale: int) -> Column:
    """Cast that yields NULL instead of an error when the value does not fit."""
    return as_column(c).try_cast(f"decimal({precision},{scale})")


def parse_dose(c: str | Column) -> Column:
    """Number in a dose text. Texts of up to eight characters hold whole doses; in longer
    ones the first eight digits count. Several points ('1.2.3') give NULL."""
    text = as_column(c)
    digits = F.nullif(F.regexp_replace(text, "[^0-9.]", ""), F.lit(""))
    whole = digits.try_cast("decimal(10,0)").cast("decimal(20,5)")
    cut = F.left(digits, F.lit(8)).try_cast("decimal(20,5)")
    return F.when(F.length(text) <= 8, whole).otherwise(cut)


def to_inches(c: str | Column) -> Column:
    return as_column(c) * F.lit(0.393701)


def to_pounds(c: str | Column) -> Column:
    return as_column(c) * F.lit(2.20462)


def covers(start: str | Column, end: str | Column, at: str | Column) -> Column:
    """'Y' when the half-open interval [start, end) holds the date, else 'N'."""
    s, e, a = as_column(start), as_column(end), as_column(at)
    return F.when((s <= a) & (e > a), F.lit("Y")).otherwise(F.lit("N"))


def row_key(*cols: str | Column) -> Column:
    """Repeatable surrogate key of a natural key: a digest that tells NULL from ''."""
    parts = [F.coalesce(F.concat(F.lit("="), as_column(c).cast("string")), F.lit("~")) for c in cols]
    return F.sha2(F.concat_ws("|", *parts), 256)
