"""Dates: non-strict casts, nanosecond inputs, day text and months."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.schema import DAY_FORMAT

_SECONDS_PER_DAY = 86_400


def to_day(col: Column, data_type: T.DataType, market_tz: str = "UTC") -> Column:
    """Date of a value of any type; what cannot be converted becomes null.

    An instant (timestamp with zone) takes its date in ``market_tz``,
    independent of the session time zone.
    """
    if isinstance(data_type, T.DateType):
        return col
    if isinstance(data_type, T.TimestampType):
        seconds = F.unix_seconds(F.from_utc_timestamp(col, market_tz))
        return F.date_from_unix_date(F.floor(seconds / _SECONDS_PER_DAY).cast("int"))
    if isinstance(data_type, (T.StringType, T.TimestampNTZType)):
        return col.try_cast("date")
    return F.lit(None).cast("date")


def nanos_to_timestamp(col: Column) -> Column:
    """Nanoseconds since the epoch (bigint) to a timestamp, rounded down to microseconds."""
    thousand = F.lit(1000).cast("bigint")
    return F.timestamp_micros(F.call_function("div", col - F.pmod(col, thousand), thousand))


def parse_timestamp(text: Column) -> Column:
    """A timestamp from text; text that is not one is an error."""
    parsed = text.try_cast("timestamp_ntz")
    bad = F.raise_error(F.concat(F.lit("not a date: "), text)).cast("timestamp_ntz")
    return F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(bad)


def day_text(col: Column) -> Column:
    return F.date_format(col, DAY_FORMAT)


def month_start(col: Column) -> Column:
    return F.trunc(col, "MM")
