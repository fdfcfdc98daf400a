"""Scalar expressions against hand-computed answers."""

import math

from conftest import rows, values
from pyspark.sql import functions as F

from cartlens.functions import buckets, dates, labels, text


def one(spark, data, schema, expr):
    return values(spark.createDataFrame(data, schema).coalesce(1).select(expr))


def test_whole_days_round_down(spark):
    data = [(0, 12), (0, 24), (0, 0), (23, 0), (24, 0), (None, 0)]
    ts = lambda c: F.to_timestamp(F.lit("2020-01-10")) + F.make_dt_interval(F.lit(0), F.col(c))
    assert one(spark, data, "a int, b int", dates.whole_days(ts("a"), ts("b"))) == [-1, -1, 0, 0, 1, None]
    assert one(spark, [(0, 36)], "a int, b int", dates.whole_days(ts("a"), ts("b"))) == [-2]


def test_whole_days_of_ntz(spark):
    df = spark.sql("select timestamp_ntz'2020-01-01 00:00:00' as a, timestamp_ntz'2020-01-01 12:00:00' as b")
    assert values(df.select(dates.whole_days(F.col("a"), F.col("b")))) == [-1]


def test_longer_units(spark):
    df = spark.sql("select timestamp'2021-01-01' as a, timestamp'2020-01-01' as b")
    got = df.select(
        dates.days_between(F.col("a"), F.col("b")),
        dates.weeks_between(F.col("a"), F.col("b")),
        dates.months_between_mean(F.col("a"), F.col("b")),
        dates.years_between_mean(F.col("a"), F.col("b")),
    ).first()
    assert got[0] == 366 and math.isclose(got[1], 366 / 7)
    assert math.isclose(got[2], 366 / 30.436875) and math.isclose(got[3], 366 / 365.2425)


def test_parts_of_day(spark):
    hours = [(h,) for h in (0, 5, 6, 7, 8, 11, 12, 17, 18, 22, 23, None)]
    assert one(spark, hours, "h int", dates.day_third(F.col("h"))) == [1, 1, 1, 1, 2, 2, 2, 2, 3, 3, 3, 3]
    assert one(spark, hours, "h int", dates.day_quarter(F.col("h"))) == [1, 1, 2, 2, 2, 2, 3, 3, 4, 4, 1, 1]


def test_weekdays(spark):
    df = spark.sql("select explode(array(timestamp'2024-01-01', timestamp'2024-01-07')) as t")  # Monday, Sunday
    assert rows(df.select(dates.weekday_name(F.col("t")), dates.iso_weekday(F.col("t")))) == [("Monday", 1), ("Sunday", 7)]


def test_day_labels(spark):
    days = [(d,) for d in (-1, 0, 1, 2, 3, 7, 8, 31, 32, None)]
    c = F.col("d")
    assert one(spark, days, "d int", labels.delay_label(c)) == ["Delay"] + ["No Delay"] * 9
    assert one(spark, days, "d int", labels.review_lag_label(c)) == [
        "Before Delivery", "Within 1 day", "Within 1 Week", "Within 1 Week", "Within 1 Week", "Within 1 Week",
        "Within 1 Month", "Within 1 Month", "After 1 Month", "After 1 Month",
    ]
    assert one(spark, days, "d int", labels.answer_lag_label(c)) == [
        "Within 2 days", "Within 1 day", "Within 2 days", "Within 2 days", "Within 1 Week", "Within 1 Week",
        "Within 1 Month", "Within 1 Month", "After 1 Month", "After 1 Month",
    ]


def test_regions(spark):
    states = [("SP",), ("RS",), ("BA",), ("DF",), ("AM",), (None,)]
    assert one(spark, states, "s string", labels.region_of(F.col("s"))) == [
        "southeastern", "southern", "northeastern", "centralwestern", "northern", "northern",
    ]


def test_flags(spark):
    data = [(1, 2), (2, 1), (2, 2), (None, 1), (1, None)]
    assert one(spark, data, "a int, b int", labels.late_flag(F.col("a"), F.col("b"))) == [0, 1, 0, 0, 0]
    assert one(spark, [(180,), (181,), (None,)], "r int", labels.churn_flag(F.col("r"))) == [0, 1, 0]
    assert one(spark, [(0.49,), (0.5,)], "p double", labels.threshold_label(F.col("p"))) == [0, 1]


def test_product_names(spark):
    ids = [("bed bath", "00a0b12"), ("toys", "abc"), ("toys", "a000"), (None, "1"), ("x", "12345678901234567890123456789012")]
    got = one(spark, ids, "c string, i string", text.product_name(F.col("c"), F.col("i")))
    assert got == ["BEDBATH_12", None, "TOYS_0", None, "X_12345678901234567890123456789012"]


def test_location_key(spark):
    got = spark.createDataFrame([(12.5, -3.0), (None, 1.0)], "x double, y double").select(
        text.location_key(F.col("x"), F.col("y")), text.location_key(F.col("x"), F.col("y"), "_")
    )
    assert rows(got) == [("12.5-3.0", "12.5_-3.0"), (None, None)]


def test_cut_edges(spark):
    recency = [(v,) for v in (-2, -1, 0, 59, 60, 119, 120, 219, 220, None)]
    left = buckets.cut(F.col("v"), buckets.RECENCY_EDGES, buckets.RECENCY_LABELS, right=False)
    assert one(spark, recency, "v int", left) == [
        None, "Recent", "Recent", "Recent", "Moderately Recent", "Moderately Recent", "Not So Recent", "Not So Recent",
        "Inactive", None,
    ]
    late = [(v,) for v in (-1, 0, 3, 4)]
    assert one(spark, late, "v int", buckets.cut(F.col("v"), buckets.LATE_EDGES, buckets.LATE_LABELS)) == [
        None, "No Late Deliveries", "Low", "High",
    ]
    money = [(v,) for v in (0.0, 50.0, 51.0, 600.0, 601.0)]
    assert one(spark, money, "v double", buckets.cut(F.col("v"), buckets.MONETARY_EDGES, buckets.MONETARY_LABELS)) == [
        None, "Low", "Medium", "Very High", None,
    ]
    rfm = [(v,) for v in (0, 3, 4, 6, 7, 9)]
    cut = lambda low: buckets.cut(F.col("v"), buckets.RFM_EDGES, buckets.RFM_LABELS, include_lowest=low)
    assert one(spark, rfm, "v int", cut(False)) == [None, "Inactive", "Regular", "Regular", "Engaged", "Engaged"]
    assert one(spark, rfm, "v int", cut(True))[0] == "Inactive"


def test_bin_index_collapses_equal_edges(spark):
    data = [(v,) for v in (1, 1, 1, 1, 2, 2, 75, None)]
    assert one(spark, data, "v int", buckets.bin_index(F.col("v"), [1, 1, 1, 2, 75])) == [0, 0, 0, 0, 0, 0, 1, None]
    assert one(spark, [(5,), (5,)], "v int", buckets.bin_index(F.col("v"), [5, 5, 5, 5, 5])) == [0, 0]


def test_log_is_applied_twice(spark):
    got = one(spark, [(0.0,)], "v double", buckets.log_shifted(F.col("v"), 1.0, 2))[0]
    assert math.isclose(got, math.log1p(math.log1p(1.0) + 1.0))
