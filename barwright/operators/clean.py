"""Typing and null filtering of raw bars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.functions import to_day
from barwright.operators.shape import to_long, whole_volume
from barwright.schema import RAW_COLUMNS, RAW_PARTITION


def clean_bars(raw: DataFrame, market_tz: str = "UTC") -> DataFrame:
    """Long, typed bars with ticker, date and close present.

    Extra columns are kept (the refined table drops rows where one is null).
    Duplicates stay. A NaN close is a value, not a null.
    """
    df = to_long(raw, present_only=True)
    types = {f.name: f.dataType for f in df.schema.fields}
    absent = [c for c in RAW_COLUMNS if c not in types]
    if absent:
        raise ValueError(f"raw bars lack columns: {', '.join(absent)}")
    extras = [F.col(f"`{c}`") for c in df.columns if c not in (*RAW_COLUMNS, RAW_PARTITION)]
    typed = df.select(
        to_day(F.col("Date"), types["Date"], market_tz).alias("Date"),
        F.col("Ticker").cast("string").alias("Ticker"),
        *[F.col(c).cast("double").alias(c) for c in ("Open", "High", "Low", "Close")],
        whole_volume(F.col("Volume"), types["Volume"]).alias("Volume"),
        *extras,
    )
    present = [F.col(c).isNotNull() for c in ("Ticker", "Date", "Close")]
    return typed.where(present[0] & present[1] & present[2])
