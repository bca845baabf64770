"""Column functions on rows with hand-computed results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillstar.functions import classify
from tillstar.functions.dates import is_holiday, is_weekend, noon, seconds_between, sunday_week
from tillstar.functions.keys import change_signature, conformed_key, date_from_key, date_key
from tillstar.functions.numbers import (
    digits_only_int, margin, percent, ratio, safe_int, safe_round_int,
)
from tillstar.functions.text import capitalize_words, part, strip, title_case


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_digits_only_int(spark):
    rows = [("42",), (" ",), ("4x",), (None,), ("-1",), (" 7 ",)]
    got = values(spark, rows, "c string", digits_only_int(F.col("c")))
    assert got == [(42,), (None,), (None,), (None,), (None,), (7,)]


def test_safe_casts(spark):
    assert values(spark, [("12.7",), ("x",), ("-3",)], "c string", safe_int(F.col("c"))) == [
        (None,), (None,), (-3,)
    ]
    assert values(spark, [(12.7,), (12.4,), (None,)], "c double", safe_round_int(F.col("c"))) == [
        (13,), (12,), (None,)
    ]


def test_ratio_by_zero_is_null(spark):
    got = values(
        spark, [(1.0, 0.0), (1.0, 4.0)], "a double, b double",
        ratio(F.col("a"), F.col("b")), percent(F.col("a"), F.col("b")),
    )
    assert got == [(None, None), (0.25, 25.0)]


def test_margin(spark):
    got = values(
        spark, [(10.0, 6.0), (0.0, 6.0), (-1.0, 1.0)], "p double, c double",
        margin(F.col("p"), F.col("c")),
    )
    assert got == [(0.4,), (0.0,), (0.0,)]


@pytest.mark.parametrize(
    "day, week",
    [("2024-01-06", 0), ("2024-01-07", 1), ("2023-01-01", 1), ("2024-12-31", 52)],
)
def test_sunday_week(spark, day, week):
    d = dt.date.fromisoformat(day)
    assert values(spark, [(d,)], "d date", sunday_week(F.col("d"))) == [(week,)]


def test_sunday_week_equals_strftime(spark):
    start = dt.date(2020, 1, 1)
    days = spark.range(4018).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    wrong = [
        r for r in days.select("d", sunday_week(F.col("d")).alias("w")).collect()
        if int(r.d.strftime("%U")) != r.w
    ]
    assert wrong == []


def test_calendar_flags(spark):
    days = [dt.date(2024, 12, 25), dt.date(2024, 7, 4), dt.date(2024, 1, 1), dt.date(2024, 1, 6)]
    got = values(
        spark, [(d,) for d in days], "d date", is_holiday(F.col("d")), is_weekend(F.col("d"))
    )
    assert got == [(True, False), (True, False), (True, False), (False, True)]


def test_noon_and_seconds(spark):
    a, b = dt.datetime(2024, 1, 1, 0, 0, 0, 900000), dt.datetime(2024, 1, 1, 0, 0, 1, 100000)
    got = values(
        spark, [(a, b, dt.date(2024, 1, 1))], "a timestamp_ntz, b timestamp_ntz, d date",
        seconds_between(F.col("a"), F.col("b")), noon(F.col("d")),
    )
    assert got == [(0, dt.datetime(2024, 1, 1, 12))]


def test_conformed_key(spark):
    rows = [("a", None), ("a", "x"), ("a", None), (None, "a")]
    keys = [k for (k,) in values(spark, rows, "a string, b string", conformed_key("a", "b"))]
    assert keys[0] == keys[2] and len(set(keys)) == 3
    assert values(spark, [("google",)], "v string", conformed_key("v")) == [(901331371572936402,)]


def test_change_signature_sees_nulls(spark):
    rows = [("a", None), (None, "a")]
    got = values(spark, rows, "a string, b string", change_signature("a", "b"))
    assert got[0] != got[1]


def test_date_keys(spark):
    d = dt.date(2024, 2, 29)
    got = values(spark, [(d,)], "d date", date_key("d"), date_from_key(date_key("d")))
    assert got == [(20240229, d)]


def test_text(spark):
    rows = [("t-shirts o'neil U.S. polo",), ("  new   BALANCE ",)]
    got = values(spark, rows, "c string", title_case(F.col("c")), capitalize_words(F.col("c")))
    assert got[0] == ("T-Shirts O'Neil U.S. Polo", "T-shirts O'neil U.s. Polo")
    assert got[1][1] == "New Balance"
    assert values(spark, [("Austin, TX",), ("Austin",)], "c string", part(F.col("c"), ",", 1)) == [
        ("TX",), (None,)
    ]
    assert values(spark, [("\t a b \n",)], "c string", strip(F.col("c"))) == [("a b",)]


def test_title_case_equals_python(spark):
    words = ["levi's jeans", "u.s. polo assn.", "jack & jones", "3d-print x2y", "ÉTÉ café"]
    got = values(spark, [(w,) for w in words], "c string", title_case(F.col("c")))
    assert [g for (g,) in got] == [w.title() for w in words]


def test_traffic_source(spark):
    rows = [(" YouTube.com ",), ("lm.facebook.com",), ("awin",), ("Bing",), (None,), ("twitter",)]
    got = values(spark, rows, "c string", classify.traffic_source(F.col("c")))
    assert [g for (g,) in got] == ["google", "meta", "rtbhouse", "Bing", None, "twitter"]


def test_medium_device_and_channel(spark):
    got = values(
        spark, [("CPC", "iPad", "TikTok"), ("crm", "watch", "google"), ("(none)", "PC", "dsp")],
        "m string, d string, p string",
        classify.medium_category(F.col("m")), classify.device_type(F.col("d")),
        classify.ad_channel(F.col("p")),
    )
    assert got == [
        ("Paid Search", "Tablet", "Paid Social"), ("Other", "Other", "Other"),
        ("Direct", "Desktop", "DSP"),
    ]


def test_browser_and_system_rules_are_ordered(spark):
    rows = [("Mozilla Chrome Safari",), ("Friendly",), ("MacOSX",), ("iOS 17",), (None,)]
    got = values(
        spark, rows, "c string", classify.browser(F.col("c")),
        classify.operating_system(F.col("c")),
    )
    assert got == [
        ("Chrome", "Mozilla Chrome Safari"), ("Internet Explorer", "Friendly"),
        ("MacOSX", "macOS"), ("iOS 17", "iOS"), ("Unknown", "Unknown"),
    ]


def test_customer_state(spark):
    rows = [(True, 0), (False, 5), (False, 2), (False, 1), (None, 7)]
    got = values(
        spark, rows, "p boolean, n bigint", classify.customer_state(F.col("p"), F.col("n"))
    )
    assert [g for (g,) in got] == [
        "Premium Customer", "Loyal Customer", "Repeat Customer", "New Customer", "Loyal Customer"
    ]
