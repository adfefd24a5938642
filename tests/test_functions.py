import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from barwright.functions import (
    max_number,
    mean2,
    min_number,
    nanos_to_timestamp,
    normalize_ticker,
    pct_change,
    round2,
    to_day,
)

NAN, INF = float("nan"), float("inf")


def values(spark, data, expression, schema="x double"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in data], schema).select(expression).collect()]


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_round2(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        data = [1.005, 0.125, -0.125, 0.375, INF, -INF, NAN, None]
        even = values(spark, data, round2(F.col("x")))
        assert all(map(same, even, [1.0, 0.12, -0.12, 0.38, INF, -INF, NAN, None]))
        away = values(spark, data, round2(F.col("x"), "half_away"))
        assert all(map(same, away, [1.0, 0.13, -0.13, 0.38, INF, -INF, NAN, None]))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_pct_change_divides_like_ieee(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        cases = [
            ((2.0, 3.0), 50.0),
            ((0.0, 3.0), INF),
            ((0.0, -3.0), -INF),
            ((0.0, 0.0), NAN),
            ((NAN, 1.0), NAN),
            ((0.0, NAN), NAN),
            ((None, 1.0), None),
            ((0.0, None), None),
        ]
        df = spark.createDataFrame([c for c, _ in cases], "o double, c double")
        found = [r[0] for r in df.select(pct_change(F.col("o"), F.col("c"))).collect()]
        assert all(same(f, e) for f, (_, e) in zip(found, cases, strict=True))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_mean2_is_exact_and_falls_back(spark):
    def mean(data):
        return values(spark, data, mean2(F.col("x")))[0]

    assert mean([0.01, 0.02]) == 0.02  # exact tie 0.015 to even
    assert mean([0.1] * 10) == 0.1
    assert mean([1.0, None, 2.0]) == 1.5
    assert mean([None]) is None
    assert math.isnan(mean([1.0, NAN]))
    assert mean([1.0, INF]) == INF
    assert mean([1e300, 1e300]) == 1e300
    assert mean([9.9e12] * 3) == 9.9e12


def test_min_and_max_ignore_nan(spark):
    assert values(spark, [1.0, NAN, 3.0, None], max_number(F.col("x"))) == [3.0]
    assert values(spark, [1.0, NAN, 3.0, None], min_number(F.col("x"))) == [1.0]
    assert math.isnan(values(spark, [NAN, NAN], max_number(F.col("x")))[0])
    assert values(spark, [None], max_number(F.col("x"))) == [None]


def test_normalize_ticker_removes_the_first_match_only(spark):
    names = ["ITUB4.SA", "VSAX3.SA", "ABC", "itub4.SA", "SA.SA", "A.SA.SA", ".SA", "\nSAx", "a\nb.SA\nc", None]
    expected = ["itub4", "x3.sa", "abc", "itub4", "sa", "a.sa", "", "\nsax", "a\nb\nc", None]
    assert values(spark, names, normalize_ticker(F.col("x")), "x string") == expected


def test_to_day(spark):
    def days(data, kind, tz="UTC"):
        df = spark.createDataFrame([(v,) for v in data], "x string").select(F.col("x").cast(kind).alias("x"))
        return [r[0] for r in df.select(to_day(F.col("x"), df.schema["x"].dataType, tz)).collect()]

    first = dt.date(2024, 1, 2)
    assert days(["2024-01-02", "not a day", None], "string") == [first, None, None]
    assert days(["2024-01-02 23:59:59"], "timestamp_ntz") == [first]
    assert days(["2024-01-02T23:00:00Z"], "timestamp") == [first]
    assert days(["2024-01-03T02:59:59Z", "2024-01-03T03:00:00Z"], "timestamp", "America/Sao_Paulo") == [
        first,
        dt.date(2024, 1, 3),
    ]
    assert days(["2024-01-02"], "date") == [first]
    assert days(["1969-12-31T23:00:00Z"], "timestamp") == [dt.date(1969, 12, 31)]


def test_to_day_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.sql("SELECT timestamp'2024-01-02T23:00:00Z' AS x")
        assert df.select(to_day(F.col("x"), df.schema["x"].dataType)).first()[0] == dt.date(2024, 1, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_nanos(spark):
    nanos = [1_704_153_600_123_456_789, -1, 0]
    found = values(spark, nanos, F.unix_micros(nanos_to_timestamp(F.col("x"))), "x bigint")
    assert found == [1_704_153_600_123_456, -1, 0]
