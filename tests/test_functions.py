"""Edge values of the column functions (the driver's tables hold no NULLs)."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cliniform import functions as fn


def values(spark, rows, kind, column):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column.alias("y")).collect()]


def test_packed_fields(spark):
    rows = ["a|b|c", "a|b", "x|y|,I10,J20", "p|q| K1 ", None, ""]
    assert values(spark, rows, "string", fn.packed_field("x", 3)) == ["c", "", ",I10,J20", " K1 ", None, ""]
    assert values(spark, rows, "string", fn.lead_code("x")) == ["c", "", "I10", "K1", None, ""]


def test_gluing_skips_null(spark):
    assert values(spark, ["a", None], "string", fn.glue("x", F.lit("|"), "x")) == ["a|a", "|"]
    assert values(spark, ["7", None], "string", fn.text_id("x", "c")) == ["c7", None]


def test_keywords_are_plain_text(spark):
    rows = ["TPN bag", "kcal/oz 5", "tea", None, "a.b"]
    assert values(spark, rows, "string", fn.contains_any("x", ["tpn", "kcal/oz", "axb", "."])) == [True, True, False, None, True]


@pytest.mark.parametrize("text, five, nine, facility", [
    ("12345-6789", "12345", "123456789", "12345"), ("12345", "12345", None, "12345"), ("1234", None, None, None),
    ("ABCDE", None, None, None), (None, None, None, None), ("1234567", "12345", None, "12345"), ("123-456", "12345", None, "123-4")])
def test_zip_codes(spark, text, five, nine, facility):
    assert values(spark, [text], "string", fn.zip5("x")) == [five]
    assert values(spark, [text], "string", fn.zip9("x")) == [nine]
    assert values(spark, [text], "string", fn.facility_zip("x")) == [facility]


def test_city(spark):
    rows = ["123", "St. Paul", "--", "Boston", None, "Fort-Worth Town", "a.-b", "Città Nova"]
    assert values(spark, rows, "string", fn.clean_city("x")) == [
        None, "St  Paul", None, "Boston", None, "Fort Worth Town", "a -b", "Città Nova"]


def test_dates_and_times(spark):
    df = spark.createDataFrame([(2001, None, 5), (2001, 12, None), (None, 1, 1)], "y int, m int, d int")
    got = [r[0] for r in df.select(fn.date_from_parts("y", "m", "d")).collect()]
    assert got == [date(2001, 1, 5), date(2001, 12, 1), None]
    when = [datetime(2020, 1, 1, 7, 5), None]
    assert values(spark, when, "timestamp_ntz", fn.hhmm("x")) == ["07:05", None]
    assert values(spark, when, "timestamp_ntz", fn.hour_minute_unpadded("x")) == ["7:5", None]


def test_doses(spark):
    rows = ["0.5 mL", "1.2.3", "", "123456789 mg", "about 7.25 mg", None, "2"]
    assert values(spark, rows, "string", fn.parse_dose("x")) == [
        Decimal("1.00000"), None, None, Decimal("12345678.00000"), Decimal("7.25000"), None, Decimal("2.00000")]


def test_numbers_that_do_not_fit_become_null(spark):
    assert values(spark, [12345678.0, 1.5], "double", fn.decimal_of("x", 15, 8)) == [None, Decimal("1.50000000")]
    assert values(spark, [0, 3, None], "int", fn.null_if_zero("x")) == [None, 3, None]


def test_row_keys_tell_null_from_empty(spark):
    assert len(set(values(spark, [None, "", "~", "="], "string", fn.row_key("x")))) == 4


def test_interval_is_half_open(spark):
    d = date
    df = spark.createDataFrame([(d(2020, 1, 1), d(2020, 1, 2), d(2020, 1, 1)), (d(2020, 1, 1), d(2020, 1, 1), d(2020, 1, 1)),
                                (d(2020, 1, 1), None, d(2020, 1, 1))], "s date, e date, a date")
    assert [r[0] for r in df.select(fn.covers("s", "e", "a")).collect()] == ["Y", "N", "N"]


def test_rule_lists_hold_pinned_rows():
    """Literal rows, apart from the lists, so that a slip in a list does not pass on both sides."""
    from cliniform.rules import labs as L
    from cliniform.rules.results import GENERAL_RESULT_TEXT, RESULT_TEXT
    assert (RESULT_TEXT[0], RESULT_TEXT[-1], len(RESULT_TEXT)) == (("1+", "1+"), ("yellow", "YELLOW"), 104)
    assert {("ab negative", "AB NEG"), ("Clear", "CLEAR"), ("cerebrospinal fluid", "CEREBROSPINAL FLUID (CSF)"), ("undetected", "UNDETECTABLE")} <= set(RESULT_TEXT)
    assert ("Clear", "CLEAR") not in GENERAL_RESULT_TEXT and ("clear", "CLEAR") in GENERAL_RESULT_TEXT and len(GENERAL_RESULT_TEXT) == 102
    assert len(L.MODIFIER_REPAIRS) == 25
    assert L.MODIFIER_REPAIRS[0] == (("EQ",), ("LT", "LE"), ("OT",), None, "EQ", "EQ", None, None)
    assert L.MODIFIER_REPAIRS[20] == (("OT", "", None), ("OT",), ("LE",), "LE", None, None, None, None)
    assert L.MODIFIER_REPAIRS[23] == (("EQ",), ("EQ",), ("EQ",), None, "NO", "LT", False, True)
    assert L.MODIFIER_REPAIRS[24] == (("LT",), ("NO",), ("LT",), "EQ", "EQ", "EQ", True, True)
    assert L.RANGE_PAIRS[3] == ([4172703, 4172704, 4171754, 4171756], [4172704], "NO|LT")
