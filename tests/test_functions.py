import hashlib

import pytest
from pyspark.sql import functions as F

from gridtide.functions import calendar as cal, classify, fixed_values as fixed
from gridtide.functions.keys import number_text, surrogate_key
from gridtide.functions.numeric import degree_days, parse_number, safe_div, wind_chill

from .helpers import values


def test_surrogate_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None, "")], "x string, y string, z string")
    got = values(df, surrogate_key("x", "y").alias("k"), surrogate_key("x", "z").alias("e"))
    expected = hashlib.md5(f"a-{fixed.KEY_NULL_TEXT}".encode()).hexdigest()
    assert got == (expected, hashlib.md5(b"a-").hexdigest())


def test_number_text_is_fixed_point(spark):
    df = spark.createDataFrame([(12345678.0,)], "x double")
    assert values(df, number_text("x").alias("t")) == ("12345678.000000",)


def test_day_part(spark):
    df = spark.createDataFrame([(h,) for h in (5, 6, 9, 10, 16, 17, 21, 22)], "h int")
    got = [r.p for r in df.select(classify.day_part("h").alias("p")).collect()]
    assert got == [
        "OFF_PEAK", "MORNING_PEAK", "MORNING_PEAK", "MIDDAY", "MIDDAY", "EVENING_PEAK", "EVENING_PEAK", "OFF_PEAK",
    ]


def test_degree_days_keep_missing_apart(spark):
    df = spark.createDataFrame([(10.0,), (18.3,), (20.0,), (None,)], "t double")
    heating, cooling = degree_days("t")
    got = [(r.h, r.c) for r in df.select(F.round(heating, 6).alias("h"), F.round(cooling, 6).alias("c")).collect()]
    assert got == [(8.3, 0.0), (0.0, 0.0), (0.0, 1.7), (None, None)]


def test_temperature_bands(spark):
    df = spark.createDataFrame([(26.7,), (26.8,), (4.4,), (-6.7,), (None,)], "t double")
    got = [r.b for r in df.select(classify.temperature_category("t").alias("b")).collect()]
    assert got == ["WARM", "HOT", "COLD", "VERY_COLD", "UNKNOWN"]


def test_wind_chill_applies_only_in_cold_wind(spark):
    df = spark.createDataFrame([(12.0, 9.0), (5.0, 1.3), (5.0, None), (0.0, 5.0)], "t double, v double")
    got = [r.w for r in df.select(F.round(wind_chill("t", "v"), 6).alias("w")).collect()]
    assert got[:3] == [12.0, 5.0, 5.0]
    assert got[3] == pytest.approx(13.12 - 11.37 * 5**0.16, abs=1e-6)


def test_safe_div(spark):
    df = spark.createDataFrame([(6.0, 3.0), (1.0, 0.0), (None, 2.0)], "a double, b double")
    assert [r.q for r in df.select(safe_div("a", "b").alias("q")).collect()] == [2.0, None, None]


def test_parse_number_refuses_words(spark):
    texts = ["+0123", "1.5e2", "12d", "NaN", "", "1_0", None, "-.5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.n for r in df.select(parse_number(F.col("t")).alias("n")).collect()]
    assert got == [123.0, 150.0, None, None, None, None, None, -0.5]


def test_minutes_count_boundaries(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:30' a, TIMESTAMP_NTZ'2024-01-01 00:01:10' b")
    assert values(df, cal.minutes_between("a", "b").alias("m"), cal.minutes_between("b", "a").alias("n")) == (1, -1)


def test_minutes_ignore_session_time_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 01:30:00' a, TIMESTAMP_NTZ'2024-03-10 03:30:00' b")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(df, cal.minutes_between("a", "b").alias("m")) == (120,)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_weekday_and_holidays(spark):
    days = ["2024-01-07", "2024-01-01", "2024-07-04", "2024-12-25", "2023-11-23", "2018-11-22", "2024-11-28"]
    df = spark.createDataFrame([(d,) for d in days], "s string").select(F.to_date("s").alias("d"))
    got = [(r.w, r.h) for r in df.select(cal.weekday("d").alias("w"), cal.is_holiday("d").alias("h")).collect()]
    # The fourth Thursday on the 22nd lies before the default offsets; other offsets can be passed.
    assert got == [(0, False), (1, True), (4, True), (3, True), (4, True), (4, False), (4, True)]
    moved = df.select(cal.is_holiday("d", (21, 27)).alias("h")).collect()
    assert moved[5].h is True


def test_fuel_labels(spark):
    df = spark.createDataFrame([("COW",), ("NUC",), ("ALL",), ("SUN",), ("XYZ",), (None,)], "f string")
    got = [
        (r.p, r.e)
        for r in df.select(
            classify.primary_category("f", classify.is_renewable("f"), classify.is_fossil("f")).alias("p"),
            classify.emission_factor("f").alias("e"),
        ).collect()
    ]
    assert got == [
        ("Fossil Fuel", 0.9), ("Nuclear", 0.0), ("All Sources", 0.0), ("Renewable", 0.0), ("Other", 0.0), ("Other", 0.0),
    ]


def test_county_boxes(spark):
    df = spark.createDataFrame([(35.9, -78.8), (None, None), (30.0, -70.0)], "a double, o double")
    assert [r.c for r in df.select(classify.county("a", "o").alias("c")).collect()] == [
        "Wake", fixed.COUNTY_MISSING, fixed.COUNTY_OTHER,
    ]
