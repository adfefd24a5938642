"""Ticker names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from barwright.schema import TICKER_SUFFIX_PATTERN

# The dot stands for any character but a newline. Taking the rest of the text
# into the match makes sure that only the first occurrence goes.
_SUFFIX_AND_REST = r"(?s)" + TICKER_SUFFIX_PATTERN.replace(".", r"[^\n]") + r"(.*)$"


def normalize_ticker(ticker: Column) -> Column:
    """Remove the first exchange suffix and lower the case: ``ITUB4.SA`` -> ``itub4``."""
    return F.lower(F.regexp_replace(ticker, _SUFFIX_AND_REST, "$1"))
