"""Row selection: days, look-back ranges and ticker universes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.schema import LOOKBACK_DAYS


def between_days(
    df: DataFrame, first: dt.date | None, last: dt.date | None, column: str = "Date", market_tz: str = "UTC"
) -> DataFrame:
    """Rows whose day lies in ``first..last`` (inclusive; None is open).

    Timestamps are compared as a half-open range on the column itself, so the
    predicate reaches the Parquet scan.
    """
    col, kind = F.col(column), df.schema[column].dataType

    def bound(day: dt.date):
        if isinstance(kind, T.TimestampNTZType):
            return F.lit(dt.datetime.combine(day, dt.time())).cast("timestamp_ntz")
        if isinstance(kind, T.TimestampType):
            seconds = dt.datetime.combine(day, dt.time(), dt.timezone.utc).timestamp()
            return F.to_utc_timestamp(F.timestamp_seconds(F.lit(int(seconds))), market_tz)
        return F.lit(day)

    if not isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        col = col.try_cast("date")
    if first is not None:
        df = df.where(col >= bound(first))
    if last is not None:
        df = df.where(col < bound(last + dt.timedelta(days=1)))
    return df


def day_before(df: DataFrame, as_of: dt.date, column: str = "Date") -> DataFrame:
    day = as_of - dt.timedelta(days=1)
    return between_days(df, day, day, column)


def lookback(
    df: DataFrame, as_of: dt.date, days: int = LOOKBACK_DAYS, column: str = "Date", include_last: bool = True
) -> DataFrame:
    """The ``days`` days before the day before ``as_of``, and with ``include_last`` that day too."""
    last = as_of - dt.timedelta(days=1)
    return between_days(df, last - dt.timedelta(days=days), last if include_last else last - dt.timedelta(days=1), column)


def in_universe(df: DataFrame, tickers: Sequence[str] | DataFrame, column: str = "Ticker") -> DataFrame:
    """Keep the given tickers: a short list is a predicate, a table is a semi-join.

    The join strategy for a table is left to Spark, which broadcasts it only if its measured size allows.
    """
    if isinstance(tickers, DataFrame):
        listed = tickers.select(F.col(tickers.columns[0]).alias(column))
        kept = df.join(listed, column, "left_semi")
        return kept.select(*[F.col(f"`{c}`") for c in df.columns])
    return df.where(F.col(column).isin(list(tickers)))
