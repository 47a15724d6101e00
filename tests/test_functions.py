"""Edge rows of the column expressions."""

import pytest
from pyspark.sql import functions as F

from monthmill.functions import dates, numeric, text
from monthmill.schemas import CREDIT_MIX_SCALE, GARBAGE_TOKEN, SPENDING_SCALE, SSN_FORMAT, TRANSACTION_SCALE


def values(spark, inputs, expression, schema="c string"):
    df = spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in inputs], schema)
    return [row[0] for row in df.coalesce(1).select(expression).collect()]


def test_text_repair(spark, ansi):
    c = F.col("c")
    assert values(spark, ["41_", "_1_", None, ""], text.strip_underscores(c)) == ["41", "1", None, ""]
    assert values(spark, [f"a{GARBAGE_TOKEN}b", GARBAGE_TOKEN, None], text.strip_token(c, GARBAGE_TOKEN)) == ["ab", "", None]
    assert values(spark, ["Media_Manager", "_______", "!!!"], text.letters_only(c)) == ["MediaManager", "", ""]
    assert values(spark, ["", " \t", "x ", None], text.blank_to_null(c)) == [None, None, "x ", None]


def test_ssn_format(spark):
    got = values(spark, ["230-22-9583", "#F%$D@*&8", "230-22-9583 ", None], text.keep_matching(F.col("c"), SSN_FORMAT))
    assert got == ["230-22-9583", None, None, None]


def test_credit_history_needs_plural_units(spark, ansi):
    c = F.col("c")
    months = numeric.total_months(text.number_before(c, "Years"), text.number_before(c, "Months"))
    inputs = ["22 Years and 9 Months", "1 Year and 3 Months", "NA", None, "999999999999 Years and 1 Months"]
    assert values(spark, inputs, months) == [273, None, None, None, None]


def test_split_keeps_a_leading_and(spark):
    got = values(spark, ["A,B, and C"], text.split_list(F.col("c")))
    assert got == [["A", "B", "and C"]]


@pytest.mark.parametrize("name, out", [("Credit-Builder Loan", "credit_builder_loan"), ("A - B", "a_b"), ("x", "x")])
def test_snake_case(name, out):
    assert text.snake_case(name) == out


def test_whole_ratio(spark, ansi):
    rows = [(0.0, 0.0), (5.0, 0.0), (None, 2.0), (2.0, None), (-3.0, 2.0), (2130.3, 710.1), (4.0, 2.0), (1e30, 1e-30)]
    got = values(spark, rows, numeric.whole_ratio(F.col("a"), F.col("b")), "a float, b float")
    assert got == [None, None, None, None, -1, 4, 2, 2**31 - 1]


def test_months_before_holds_to_month_end(spark, ansi):
    import datetime as d

    rows = [(d.date(2023, 3, 31), 1), (d.date(2023, 1, 1), 1), (d.date(2023, 1, 1), None), (d.date(2023, 1, 1), 2_000_000_000)]
    got = values(spark, rows, dates.months_before(F.col("a"), F.col("b")), "a date, b int")
    assert got == [d.date(2023, 2, 28), d.date(2022, 12, 1), None, None]


def test_fill_and_clip(spark, ansi):
    rows = [(None,), (-1.0,), (5.0,), (40.0,), (41.0,), (float("nan"),)]
    c, fill, cap = F.col("c"), F.lit(7.0).cast("float"), F.lit(40.0).cast("float")
    assert values(spark, rows, numeric.fill_and_clip(c, fill, cap), "c float") == [7, 0, 5, 40, 40, 40]
    nothing = F.lit(None).cast("float")
    assert values(spark, [(None,)], numeric.fill_and_clip(c, nothing, cap), "c float") == [None]
    assert values(spark, [(9.0,)], numeric.fill_and_clip(c, fill, nothing), "c float") == [9]
    # The cap comes last, so a cap below 0 wins over the floor.
    assert values(spark, [(9.0,)], numeric.fill_and_clip(c, fill, F.lit(-2.0).cast("float")), "c float") == [-2]


def test_flags_and_scales(spark, ansi):
    c = F.col("c")
    assert values(spark, [(29,), (30,), (None,)], numeric.at_least(c, 30), "c int") == [0, 1, 0]
    assert values(spark, ["Good", "Standard", "Bad", "", None], numeric.scale_by_value(c, CREDIT_MIX_SCALE)) == [3, 2, 1, None, None]
    behaviours = ["High_spent_Large_value_payments", "Low_spent_Medium_value_payments", "High-spent_Small_value", "", None]
    assert values(spark, behaviours, numeric.scale_by_pattern(c, SPENDING_SCALE)) == [2, 1, 2, None, None]
    assert values(spark, behaviours, numeric.scale_by_part(c, TRANSACTION_SCALE)) == [3, 2, 1, None, None]
