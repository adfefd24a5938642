"""The refined table: one row per bar with its rolling features."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.config import FeatureSpec
from barwright.functions import normalize_ticker, pct_change, round2
from barwright.operators.rolling import with_rolling
from barwright.schema import RAW_COLUMNS, RAW_TO_SILVER

_COMPLETE = "_complete"


def no_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of the columns. NaN stays, unlike with ``dropna``."""
    return df.where(reduce(and_, [F.col(f"`{c}`").isNotNull() for c in columns or df.columns]))


def round_floats(df: DataFrame, rounding: str = "half_even") -> DataFrame:
    """Round every float column to two decimals; other columns stay."""
    return df.select(
        *[
            round2(F.col(f"`{f.name}`"), rounding).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def narrow_bars(bars: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The seven bar columns; what the extra ones contribute is one flag, so they are not shuffled."""
    extras = [c for c in bars.columns if c not in RAW_COLUMNS]
    if not extras or spec.null_scope == "features":
        return bars.select(*RAW_COLUMNS)
    complete = reduce(and_, [F.col(f"`{c}`").isNotNull() for c in extras])
    return bars.select(*RAW_COLUMNS, complete.alias(_COMPLETE))


def features(
    bars: DataFrame,
    spec: FeatureSpec = FeatureSpec(),
    one_bar_per_day: bool = False,
) -> DataFrame:
    """Refined columns of every bar, unrounded, with nulls where a window is not full yet."""
    return _named(with_rolling(narrow_bars(bars, spec), spec, one_bar_per_day), spec)


def _named(rolled: DataFrame, spec: FeatureSpec) -> DataFrame:
    named = {
        **{new: F.col(old) for old, new in RAW_TO_SILVER.items()},
        "nome_acao": normalize_ticker(F.col("Ticker")),
        "variacao_pct_dia": pct_change(F.col("Open"), F.col("Close")),
        "amplitude_dia": F.col("High") - F.col("Low"),
    }
    return rolled.select(*[named.get(c, F.col(c)).alias(c) for c in spec.silver_schema.fieldNames()])


def silver(
    bars: DataFrame,
    spec: FeatureSpec = FeatureSpec(),
    one_bar_per_day: bool = False,
) -> DataFrame:
    """Clean bars to the refined table.

    Rows without a full longest window are dropped, so the first 29 bars of
    each ticker do not appear.
    """
    rolled = with_rolling(narrow_bars(bars, spec), spec, one_bar_per_day)
    # The other refined columns are null exactly where one of these is.
    complete = no_nulls(rolled, [c for c in rolled.columns if c != _COMPLETE])
    if _COMPLETE in rolled.columns:
        complete = complete.where(_COMPLETE)
    return round_floats(_named(complete, spec), spec.rounding)
