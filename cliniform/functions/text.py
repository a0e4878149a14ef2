"""Text columns: packed fields, keyword tests, place names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "as_column", "packed_field", "lead_code", "glue", "text_id", "contains_any",
    "ilike_any", "zip5", "zip9", "facility_zip", "clean_city", "digits_only",
]


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def packed_field(c: str | Column, n: int) -> Column:
    """The n-th part (from 1) of a ``|``-packed text; '' when there are fewer parts."""
    return F.split_part(as_column(c), F.lit("|"), F.lit(n))


def lead_code(c: str | Column, n: int = 3) -> Column:
    """First entry of the comma list held in packed field ``n``, leading commas ignored."""
    part = packed_field(c, n)
    unled = F.ltrim(part, F.lit(","))
    first = F.trim(F.split_part(unled, F.lit(","), F.lit(1)))
    return F.when(F.trim(part).contains(","), first).otherwise(F.trim(part))


def glue(*cols: str | Column) -> Column:
    """Concatenation that skips NULL (``concat`` itself propagates it)."""
    return F.concat_ws("", *[as_column(c) for c in cols])


def text_id(c: str | Column, prefix: str = "") -> Column:
    """A key as text, behind a letter that keeps ids of united sources apart."""
    text = as_column(c).cast("string")
    return F.concat(F.lit(prefix), text) if prefix else text


def contains_any(c: str | Column, words: list[str]) -> Column:
    """True when the lower-cased text holds one of the words; NULL for NULL text."""
    # a word that holds another one says nothing more
    least = [w for w in dict.fromkeys(words) if not any(o in w for o in words if o != w)]
    return F.lower(as_column(c)).rlike("|".join(re.escape(w) for w in least))


def ilike_any(c: str | Column, fragments: list[str]) -> Column:
    """Case-insensitive ``like any ('%fragment%', …)`` for fragments without wildcards."""
    return contains_any(c, [f.lower() for f in fragments])


def digits_only(c: str | Column) -> Column:
    return as_column(c).rlike("^[0-9]+$")


def _undashed(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit(""))


def zip5(c: str | Column) -> Column:
    """Five-digit code: as it is when five digits, else cut from a longer numeric code."""
    z = as_column(c)
    plain = _undashed(z)
    return (F.when((F.length(z) == 5) & digits_only(z), z)
            .when((F.length(z) > 5) & digits_only(plain), F.left(plain, F.lit(5))))


def zip9(c: str | Column) -> Column:
    """Nine-digit code without its dash; NULL for everything else."""
    plain = _undashed(as_column(c))
    return F.when((F.length(plain) == 9) & digits_only(plain), plain)


def facility_zip(c: str | Column) -> Column:
    """First five characters of a code that is numeric (dashes apart) and long enough."""
    z = as_column(c)
    plain = _undashed(z)
    return F.when(digits_only(plain) & (F.length(plain) >= 5), F.left(z, F.lit(5)))


def clean_city(c: str | Column) -> Column:
    """Place name without numbers-only entries; its first odd character becomes a space."""
    city = as_column(c)
    odd = city.rlike(r"(?U)[^\p{Alnum} ]")
    # only the first run of odd characters counts when deciding whether anything is left
    rest = F.regexp_replace(city, r"(?U)^(\w*)[^\w]+", "$1")
    spaced = F.regexp_replace(city, r"(?U)^(\w*)[^\w]", "$1 ")
    return (F.when(digits_only(city), F.lit(None).cast("string"))
            .when(odd & (rest == ""), F.lit(None).cast("string"))
            .when(odd, spaced)
            .otherwise(city))
