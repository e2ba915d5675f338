import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vinilo.functions import dates
from vinilo.functions.numbers import percentage, ratio, round_half_even
from vinilo.functions.text import format_duration, format_price, parse_price


def values(spark, items, kind, expression):
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r["y"] for r in frame.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_parse_price(spark):
    texts = [None, "", "abc", "1.99", "1.99abc", " -3", ".5", "5.", "1e3", "1e", "--1", "+2", "0x10"]
    assert values(spark, texts, "string", parse_price) == [
        0, 0, 0, 1.99, 1.99, -3, 0.5, 5, 1000, 1, 0, 2, 0,
    ]
    assert values(spark, [1.5, None, float("nan")], "double", parse_price) == [1.5, 0, 0]


def test_format_price(spark):
    numbers = [0.0, 1.0, 1.005, 0.125, -0.125, 0.375, 1234567.891, 99.999]
    assert values(spark, numbers, "double", format_price) == [
        "$0.00", "$1.00", "$1.00", "$0.13", "$-0.13", "$0.38", "$1234567.89", "$100.00",
    ]
    assert values(spark, ["x", None, "2.5"], "string", format_price) == ["$0.00", "$0.00", "$2.50"]


def test_format_duration(spark):
    lengths = [None, 0, -5, 999, 61000, 3600000, 59999]
    assert values(spark, lengths, "long", format_duration) == [
        "0:00", "0:00", "0:00", "0:00", "1:01", "60:00", "0:59",
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=200))
def test_formatted_price_is_the_nearest_one(spark, prices):
    from fractions import Fraction

    for price, text in zip(prices, values(spark, prices, "double", format_price), strict=True):
        exact = abs(Fraction(price)) * 100
        cents = exact.numerator // exact.denominator
        if exact - cents >= Fraction(1, 2):
            cents += 1
        assert Fraction(text.lstrip("$-")) * 100 == cents


def test_rounding_and_division(spark):
    frame = spark.createDataFrame([(1.0, 0.0, 2.675)], "a double, z double, h double")
    row = frame.select(
        ratio(F.col("a"), F.col("z")).alias("none"),
        percentage(F.col("a"), F.lit(3), 2).alias("third"),
        round_half_even(F.col("h"), 2).alias("half"),
        round_half_even(F.col("h"), None).alias("same"),
    ).first()
    assert row["none"] is None
    assert row["third"] == 33.33
    assert row["half"] == 2.68  # 2.675 * 100 is 267.5 in floating point, even is 268
    assert row["same"] == 2.675


@pytest.mark.parametrize("kind", ["string", "date", "timestamp_ntz"])
def test_dates_of_any_type(spark, kind):
    frame = spark.createDataFrame([("2024-02-29",)], "x string").select(F.col("x").cast(kind))
    row = frame.select(
        dates.day(frame, "x").alias("day"),
        dates.month_start(dates.day(frame, "x")).alias("month"),
        dates.weekday_name(dates.day(frame, "x")).alias("weekday"),
        dates.month_name(dates.day(frame, "x")).alias("name"),
        dates.is_weekend(dates.day(frame, "x")).alias("weekend"),
    ).first()
    assert tuple(row) == (
        datetime.date(2024, 2, 29),
        datetime.date(2024, 2, 1),
        "Thursday",
        "February",
        False,
    )


def test_text_with_time_and_broken_text(spark):
    frame = spark.createDataFrame(
        [("2024-01-01 10:00:00",), ("2024-13-01",), ("nope",), ("",)], "x string"
    )
    days = [r["d"] for r in frame.select(dates.day(frame, "x").alias("d")).collect()]
    assert days == [datetime.date(2024, 1, 1), None, None, None]
