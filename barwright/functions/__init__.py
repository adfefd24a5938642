"""Column functions; all are built-in Spark expressions, none is a UDF."""

from barwright.functions.dates import day_text, month_start, nanos_to_timestamp, parse_timestamp, to_day
from barwright.functions.numeric import max_number, mean2, min_number, pct_change, round2
from barwright.functions.text import normalize_ticker

__all__ = [
    "day_text",
    "max_number",
    "mean2",
    "min_number",
    "month_start",
    "nanos_to_timestamp",
    "normalize_ticker",
    "parse_timestamp",
    "pct_change",
    "round2",
    "to_day",
]
