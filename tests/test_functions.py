from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from playlake.functions import (
    blank_to_null,
    clip_text,
    event_date,
    event_time,
    full_name,
    nan_to_null,
    round_to_int,
    time_parts,
    to_float,
    to_id,
    weekday,
)
from tests.data import rows


def one(spark, value, kind, expression):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression).first()[0]


@pytest.mark.parametrize(
    ("precision", "expected"),
    [("ms", datetime(2018, 11, 1, 21, 1, 46, 796000)), ("s", datetime(2018, 11, 1, 21, 1, 46))],
)
def test_event_time_keeps_or_drops_milliseconds_in_any_zone(spark, zone, precision, expected):
    assert one(spark, 1541106106796, "bigint", event_time("v", precision)) == expected


def test_event_time_reaches_past_32_bit_seconds(spark, zone):
    assert one(spark, 4102444800000, "bigint", event_time("v")) == datetime(2100, 1, 1)


def test_event_date(spark, zone):
    assert one(spark, 1541116799999, "bigint", event_date("v")) == date(2018, 11, 1)


def test_unknown_precision_and_style_are_refused():
    with pytest.raises(ValueError):
        event_time("v", "us")
    with pytest.raises(ValueError):
        weekday("v", "mon1")


@pytest.mark.parametrize(("style", "sunday"), [("mon0", 6), ("sun0", 0), ("sun1", 1)])
def test_weekday_styles(spark, style, sunday):
    ts = F.col("v").cast("timestamp_ntz")
    assert one(spark, "2018-11-04 10:00:00", "string", weekday(ts, style)) == sunday


def test_year_end_belongs_to_week_one(spark):
    df = spark.createDataFrame([("2018-12-31 23:00:00",)], "v string")
    parts = df.select(*(c.alias(n) for n, c in time_parts(F.col("v").cast("timestamp_ntz")).items()))
    assert parts.first().asDict() == {
        "hour": 23, "day": 31, "week": 1, "month": 12, "year": 2018, "weekday": 1
    }


@pytest.mark.parametrize(("value", "expected"), [(35.5, 36), (-0.5, -1), (35.14968, 35), (None, None)])
def test_rounding(spark, value, expected):
    assert one(spark, value, "double", round_to_int("v")) == expected


@pytest.mark.parametrize(("value", "expected"), [("8", 8), ("", None), (None, None), ("x", None)])
def test_ids_of_blank_text_are_null(spark, value, expected):
    assert one(spark, value, "string", to_id("v")) == expected


def test_a_float_is_not_equal_to_its_double(spark):
    assert one(spark, 495.3073, "double", to_float("v").cast("double") == F.col("v")) is False


def test_clip_text(spark):
    assert one(spark, "é" * 300, "string", F.length(clip_text("v"))) == 256
    assert one(spark, "short", "string", clip_text("v")) == "short"


def test_nan_and_blank_become_null(spark):
    assert one(spark, float("nan"), "double", nan_to_null("v")) is None
    assert one(spark, 1.5, "double", nan_to_null("v")) == 1.5
    assert one(spark, "", "string", blank_to_null("v")) is None
    assert one(spark, " ", "string", blank_to_null("v")) == " "


def test_full_name_needs_both_parts(spark):
    df = spark.createDataFrame([("Lily", "Koch"), ("Lily", None)], "a string, b string")
    assert rows(df.select(full_name("a", "b"))) == [(None,), ("Lily Koch",)]
