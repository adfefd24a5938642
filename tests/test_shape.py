from decimal import Decimal

import pytest
from conftest import BARS, day, rows, series
from pyspark.sql import functions as F

from barwright.operators import shape
from barwright.operators.clean import clean_bars
from barwright.schema import RAW_COLUMNS


def test_header_names(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    flat = shape.flatten_header(df, [("Date", ""), ("Close", "ITUB4.SA"), ("Ticker", "")])
    assert flat.columns == ["Date", "Close_ITUB4.SA", "Ticker"]


def test_wide_detection_and_ticker_discovery():
    assert not shape.is_wide(["Date", "Ticker", "data_particao", "Close", "adj_close"])
    assert shape.is_wide(["Date", "Volume_X"])
    assert not shape.is_wide(["Stock_Splits", "close_X"])
    columns = ["Date", "Close_B", "Open_B", "Close_A_1", "Low_A_1", "Adj_A"]
    assert shape.wide_tickers(columns) == ["B", "A_1"]


def test_wide_and_long_give_the_same_bars(spark):
    bars = spark.createDataFrame(series("A.SA", 10) + series("B.SA", 12, start=3), BARS)
    wide = shape.long_to_wide(bars, ["A.SA", "B.SA"])
    assert shape.is_wide(wide.columns) and "Close_A.SA" in wide.columns
    assert rows(clean_bars(wide), *RAW_COLUMNS) == rows(bars, *RAW_COLUMNS)
    # the ticker and other columns of the wide row do not matter
    extended = wide.withColumn("Ticker", F.lit("?")).withColumn("note", F.lit(None).cast("string"))
    assert rows(clean_bars(extended), *RAW_COLUMNS) == rows(bars, *RAW_COLUMNS)


def test_wide_volume_as_double_becomes_bigint(spark):
    bars = spark.createDataFrame(series("A", 3), BARS)
    wide = shape.long_to_wide(bars.withColumn("Volume", F.col("Volume").cast("double")), ["A"])
    assert rows(clean_bars(wide), *RAW_COLUMNS) == rows(bars, *RAW_COLUMNS)


def test_missing_series_is_an_error(spark):
    with pytest.raises(ValueError, match="Volume_A"):
        shape.wide_to_long(spark.createDataFrame([], "Date date, Close_A double, Open_A double, High_A double, "
                                                     "Low_A double"))


def test_merged_wide_and_long_rows_both_count(spark):
    a, b = series("A", 4), series("B", 5)
    wide = shape.long_to_wide(spark.createDataFrame(a, BARS), ["A"])
    merged = shape.combine([wide, spark.createDataFrame(b, BARS)])
    assert rows(clean_bars(merged), *RAW_COLUMNS) == rows(spark.createDataFrame(a + b, BARS), *RAW_COLUMNS)


def test_combine(spark):
    assert shape.combine([None, None]) is None
    left = spark.createDataFrame([(1, "a"), (1, "a")], "x int, y string")
    right = spark.createDataFrame([(2.5, 2)], "z double, x int")
    both = shape.combine([left, None, right])
    assert both.columns == ["x", "y", "z"]
    assert rows(both) == rows(spark.createDataFrame([(1, "a", None), (1, "a", None), (2, None, 2.5)],
                                                    "x int, y string, z double"))


def test_clean_drops_missing_keys_and_close_but_not_nan(spark):
    nan = float("nan")
    data = [
        ("2024-01-02", "A", 1.0, 1.0, 1.0, 1.0, 1.0),
        ("2024-01-03", "A", None, 1.0, 1.0, nan, None),
        ("broken", "A", 1.0, 1.0, 1.0, 1.0, 1.0),
        ("2024-01-02", None, 1.0, 1.0, 1.0, 1.0, 1.0),
        ("2024-01-02", "A", 1.0, 1.0, 1.0, None, 1.0),
    ]
    raw = spark.createDataFrame(data, BARS.replace("Date date", "Date string").replace("bigint", "double"))
    cleaned = clean_bars(raw)
    assert dict(cleaned.dtypes)["Volume"] == "bigint" and dict(cleaned.dtypes)["Date"] == "date"
    assert [r[0] for r in rows(cleaned, "Date")] == ["2024-01-02", "2024-01-03"]


def test_clean_names_absent_columns(spark):
    with pytest.raises(ValueError, match="Volume"):
        clean_bars(spark.createDataFrame([], BARS).drop("Volume"))


@pytest.mark.parametrize(
    "kind, good, whole, bad",
    [
        ("double", [0.0, 12.9, -3.0, 9.0e18], [0, 12, -3, 9 * 10**18], [float("nan"), float("inf"), 1e30, 2.0**63, -1e30]),
        ("float", [5.5], [5], [float("nan"), 1e30]),
        ("decimal(38,2)", [Decimal("12.99"), Decimal(2**63 - 1)], [12, 2**63 - 1], [Decimal(2**63), Decimal("1e30")]),
        ("string", ["12", " 12.9", "1e5", str(2**63 - 1)], [12, 12, 100_000, 2**63 - 1], ["NaN", "many", "", str(2**63), "1e40"]),
    ],
)
def test_volumes_are_whole_or_an_error(spark, kind, good, whole, bad):
    kinds = BARS.replace("Volume bigint", f"Volume {kind}")

    def volumes(values):
        data = [(day(k), "A", 1.0, 1.0, 1.0, 1.0, v) for k, v in enumerate(values)]
        return [r["Volume"] for r in clean_bars(spark.createDataFrame(data, kinds)).orderBy("Date").collect()]

    assert volumes([*good, None]) == [*whole, None]
    for value in bad:
        with pytest.raises(Exception, match="volume beyond bigint or no number"):
            volumes([value])


def test_any_price_and_order_key_makes_a_bar(spark):
    import datetime as dt

    from barwright.plans.bars import daily_bars

    lines = [(k, p, 1.0, dt.datetime(2024, 1, 1)) for k, p in [(1, 3e6), (1, -7.5), (2**50, 2.0**40), (2**50, -1.0), (5, 0.0)]]
    frame = spark.createDataFrame(lines, "l_orderkey bigint, l_extendedprice double, l_quantity double, l_shipdate timestamp_ntz")
    bar = daily_bars(frame, F.lit("T")).first()
    assert (bar["Open"], bar["Close"], bar["High"], bar["Low"]) == (-8.0, 2.0**40, 2.0**40, -8.0)


def test_means_beyond_bigint_do_not_depend_on_the_order(spark):
    from barwright.functions import mean2

    values = [(1e15 + k, k % 7) for k in range(3000)]
    frame = spark.createDataFrame(values, "x double, k int")
    assert len({frame.repartition(n, "x").agg(mean2(F.col("x"))).first()[0] for n in (1, 3, 8)}) == 1
