from __future__ import annotations

import math
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from bazaar.functions.calendar import calendar_attributes, month_number
from bazaar.functions.cleaning import (
    clean_dates,
    clean_money,
    clean_numbers,
    delay_days,
    fill_zero,
    null_missing_tokens,
    standard_city,
    standard_state,
    standard_zip,
    zip_or_none,
)


def test_missing_tokens(spark):
    df = spark.createDataFrame([("NA", 1), ("", 2), ("nan", 3), ("Nancy", 4), (None, 5)], "a string, b int")
    assert [r.a for r in null_missing_tokens(df).orderBy("b").collect()] == [
        None,
        None,
        None,
        "Nancy",
        None,
    ]


def test_dates_are_coerced_and_absent_columns_skipped(spark):
    texts = ["2024-01-02", "2024-01-02 03:04:05", "invalid_date", "2024", "01/02/2024", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, d string")
    cleaned = clean_dates(df, ["d", "nowhere"])
    assert dict(cleaned.dtypes)["d"] == "timestamp_ntz"
    assert [r.d for r in cleaned.orderBy("i").collect()] == [
        datetime(2024, 1, 2),
        datetime(2024, 1, 2, 3, 4, 5),
        None,
        None,
        None,
        None,
    ]


def test_impossible_date_is_null(spark):
    df = spark.createDataFrame([("2024-02-31",), ("2024-13-01 00:00:00",)], "d string")
    assert clean_dates(df, ["d"]).where("d IS NOT NULL").isEmpty()


def test_numbers(spark):
    texts = ["1", " 2 ", "x", "1d", "inf", "NaN", None, "-3.5e2", ".5", "1.", "2f", "--1"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, n string")
    got = [r.n for r in clean_numbers(df, ["n", "nowhere"]).orderBy("i").collect()]
    assert got == [1.0, 2.0, None, None, math.inf, None, None, -350.0, 0.5, 1.0, None, None]


def test_nan_in_a_double_column_is_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,)], "n double")
    assert clean_numbers(df, ["n"]).where("n IS NULL").count() == 1


def test_money(spark):
    df = spark.createDataFrame([("1.005",), ("x",), (" 7 ",), (None,), ("1d",)], "m string")
    got = [r.m for r in clean_money(df, ["m"]).collect()]
    assert got == [Decimal("1.01"), None, Decimal("7.00"), None, None]


def test_fill_zero_only_present_columns(spark):
    df = spark.createDataFrame([(None, "a"), (2.0, None)], "w double, t string")
    got = [tuple(r) for r in fill_zero(df, ["w", "nowhere"]).collect()]
    assert got == [(0.0, "a"), (2.0, None)]


def test_city_and_state_lose_all_kinds_of_blanks(spark):
    df = spark.createDataFrame([("\t São Paulo \r\n", " sp ")], "city string, state string")
    row = df.select(standard_city(F.col("city")), standard_state(F.col("state"))).first()
    assert tuple(row) == ("são paulo", "SP")


def test_zip_keeps_zeros_and_is_never_null_for_customers(spark):
    df = spark.createDataFrame([("1151",), ("01151",), ("123456",), ("AB1",), (None,)], "z string")
    got = [tuple(r) for r in df.select(standard_zip(F.col("z")), zip_or_none(F.col("z"))).collect()]
    assert got == [
        ("01151", "01151"),
        ("01151", "01151"),
        ("123456", "123456"),
        ("AB1", "AB1"),
        (None, "None"),
    ]


def test_delay_is_fractional_signed_and_null_safe(spark):
    at = datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [
            (at, datetime(2024, 1, 3, 12)),
            (at, datetime(2023, 12, 31)),
            (at, None),
            (None, at),
        ],
        "a timestamp_ntz, b timestamp_ntz",
    )
    got = [r[0] for r in df.select(delay_days(F.col("a"), F.col("b"))).collect()]
    assert got == [2.5, -1.0, None, None]


def test_calendar(spark):
    df = spark.sql(
        "SELECT CAST(d AS DATE) d FROM VALUES ('2018-12-31'), ('2016-01-01'), ('2024-06-29'),"
        " ('2024-06-30'), ('2024-03-31'), ('2024-10-01') AS t(d)"
    )
    got = {
        str(r.d): (r.year, r.week, r.quarter, r.is_weekend)
        for r in df.withColumns(calendar_attributes(F.col("d"))).collect()
    }
    assert got == {
        "2018-12-31": (2018, 1, 4, False),
        "2016-01-01": (2016, 53, 1, False),
        "2024-06-29": (2024, 26, 2, True),
        "2024-06-30": (2024, 26, 2, True),
        "2024-03-31": (2024, 13, 1, True),
        "2024-10-01": (2024, 40, 4, False),
    }


def test_month_number(spark):
    df = spark.createDataFrame([(datetime(2018, 3, 9),), (None,)], "t timestamp_ntz")
    assert [r[0] for r in df.select(month_number(F.col("t"))).collect()] == [201803, 0]
