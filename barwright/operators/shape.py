"""Combining raw frames and turning wide bars (one column set per ticker) into long ones."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.schema import RAW_COLUMNS, RAW_KEYS, RAW_PARTITION, RAW_SERIES


def tag_ticker(df: DataFrame, ticker: str) -> DataFrame:
    return df.withColumn("Ticker", F.lit(ticker))


def flatten_header(df: DataFrame, header: Sequence[tuple[str, str]]) -> DataFrame:
    """Name the columns of a frame after a two-level header: ``("Close", "X")`` -> ``Close_X``."""
    return df.toDF(*["_".join(pair).strip("_") if pair[1] else pair[0] for pair in header])


def combine(frames: Iterable[DataFrame | None]) -> DataFrame | None:
    """Outer union by name; columns a frame lacks are null, duplicates stay. None if there is no frame."""
    present = [df for df in frames if df is not None]
    if not present:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def series_of(name: str) -> tuple[str, str] | None:
    """``Close_ITUB4.SA`` -> ``("Close", "ITUB4.SA")``; None if the name is not a wide price column."""
    series, separator, ticker = name.partition("_")
    return (series, ticker) if separator and series in RAW_SERIES else None


def is_wide(columns: Iterable[str]) -> bool:
    return any(series_of(c) for c in columns if c not in (*RAW_KEYS, RAW_PARTITION))


def wide_tickers(columns: Iterable[str]) -> list[str]:
    """Tickers of a wide frame in the order their first column appears."""
    return list(dict.fromkeys(found[1] for found in map(series_of, columns) if found))


def whole_volume(volume: Column, kind: T.DataType) -> Column:
    """Volume as bigint, fractions cut off. A volume that is there but has no whole value (NaN, out of range, text that is no
    number) is an error: neither a made-up volume nor a bar that is missing without notice."""
    if isinstance(kind, T.StringType):
        whole = volume.try_cast("decimal(38,8)").try_cast("bigint")
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        # The greatest bigint has no double of its own; a cast would turn 2^63 into it.
        whole = F.when(F.abs(volume) < float(1 << 63), volume.try_cast("bigint"))
    else:
        whole = volume.try_cast("bigint")
    unfit = F.raise_error(F.concat(F.lit("volume beyond bigint or no number: "), volume.cast("string"))).cast("bigint")
    return F.when(volume.isNotNull(), F.when(whole.isNull(), unfit).otherwise(whole))


def wide_to_long(df: DataFrame, present_only: bool = False) -> DataFrame:
    """One row per date and ticker, in a single pass over the wide rows.

    Other columns, also a ``Ticker`` of the wide row, are dropped. Prices become
    double; volume becomes bigint, as integers with gaps may arrive as double.
    If the frame merges wide and long files, it has the plain columns as well
    and each row yields its long bar too (with a null close where it has none).
    ``present_only`` leaves out bars without a close before they become rows.
    """
    tickers = wide_tickers(df.columns)
    missing = [f"{s}_{t}" for t in tickers for s in RAW_SERIES if f"{s}_{t}" not in df.columns]
    if missing:
        raise ValueError(f"wide bars lack columns: {', '.join(missing)}")

    def bar(ticker, suffix: str):
        # Names contain dots (Close_ITUB4.SA) and need quoting.
        quoted = {s: F.col("`" + f"{s}{suffix}".replace("`", "``") + "`") for s in RAW_SERIES}
        prices = [quoted[s].cast("double").alias(s) for s in ("Open", "High", "Low", "Close")]
        volume = whole_volume(quoted["Volume"], df.schema[f"Volume{suffix}"].dataType).alias("Volume")
        return F.struct(ticker.cast("string").alias("Ticker"), *prices, volume)

    bars = [bar(F.lit(t), f"_{t}") for t in tickers]
    if set(RAW_COLUMNS) <= set(df.columns):
        bars.append(bar(F.col("Ticker"), ""))
    rows = F.array(*bars)
    if present_only:
        rows = F.filter(rows, lambda bar: bar["Close"].isNotNull())
    return df.select("Date", F.inline(rows))


def to_long(df: DataFrame, present_only: bool = False) -> DataFrame:
    """Wide frames become long, long frames stay as they are."""
    return wide_to_long(df, present_only) if is_wide(df.columns) else df


def long_to_wide(df: DataFrame, tickers: Sequence[str]) -> DataFrame:
    """Inverse of ``wide_to_long`` for the given tickers; expects one bar per date and ticker."""
    first = [F.first(s).alias(s) for s in RAW_SERIES]
    pivoted = df.select(*RAW_COLUMNS).groupBy("Date").pivot("Ticker", list(tickers)).agg(*first)
    # pivot names the columns <ticker>_<series>
    return pivoted.toDF("Date", *[f"{s}_{t}" for t in tickers for s in RAW_SERIES])
