"""Daily bars derived from the line items of a trade table.

Prices are floored to whole numbers, so that sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.schema import RAW_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_ticker() -> Column:
    """Few tickers with many trades a day."""
    return F.concat("l_returnflag", "l_linestatus", F.lit("4.SA"))


def supplier_ticker() -> Column:
    """One ticker per supplier."""
    return F.concat(F.lit("SUP"), F.col("l_suppkey").cast("string"), F.lit(".SA"))


# Order key and price share a decimal of 38 digits: key * 2^64 + price + 2^63, for any whole price of 64 bits.
_SPAN = "decimal(20,0)"


def daily_bars(lines: DataFrame, ticker: Column) -> DataFrame:
    """One bar per ticker and day: first, highest, lowest and last price and the quantity.

    The first price is the lowest one in the day's first order, the last price
    the highest one in its last order. Order and price share one number, so all
    buffers are plain numbers and are combined by hash before the exchange.
    """
    price = F.floor("l_extendedprice")
    span, half = F.lit(str(1 << 64)).cast(_SPAN), F.lit(str(1 << 63)).cast(_SPAN)
    moment = (F.col("l_orderkey").cast("decimal(18,0)") * span + price.cast(_SPAN) + half).cast("decimal(38,0)")

    def price_of(found: Column) -> Column:
        return (F.pmod(found, span.cast("decimal(38,0)")) - half).cast("double")

    return (
        lines.select(
            F.col("l_shipdate").cast("date").alias("Date"),
            ticker.alias("Ticker"),
            price.alias("price"),
            moment.alias("moment"),
            "l_quantity",
        )
        .groupBy("Date", "Ticker")
        .agg(
            price_of(F.min("moment")).alias("Open"),
            F.max("price").cast("double").alias("High"),
            F.min("price").cast("double").alias("Low"),
            price_of(F.max("moment")).alias("Close"),
            F.sum("l_quantity").cast("bigint").alias("Volume"),
        )
        .select(*RAW_COLUMNS)
    )


def dense_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_bars(table(spark, sf_dir, "lineitem"), line_ticker())


def scale_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_bars(table(spark, sf_dir, "lineitem"), supplier_ticker())


def trade_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a bar of its own: a few tickers hold all rows, with many bars a day."""
    price = F.floor("l_extendedprice").cast("double")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("Date"),
        line_ticker().alias("Ticker"),
        *[price.alias(c) for c in ("Open", "High", "Low", "Close")],
        F.col("l_quantity").cast("bigint").alias("Volume"),
    )
