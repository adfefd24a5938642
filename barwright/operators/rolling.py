"""Rolling features of each ticker's bars, also when one ticker holds a large part of all rows.

A bar depends on at most ``depth`` (29) earlier bars of its ticker. Where a ticker has one bar a day, one exchange by
ticker, one sort and one window pass do it. Otherwise a ticker may hold any share of the rows, and all bars are cut into
contiguous pieces by range over ticker and order:

1. a range exchange over the full bar order, completed by a row number, spreads the rows evenly, copies as well; the
   pieces are written once, since a range exchange that is computed again may cut elsewhere;
2. a segmented scan: where a ticker goes on in a later piece, its last ``depth`` rows of a piece are handed to that successor, by
   equality on ticker and piece; a piece that holds fewer rows of the ticker also passes on what it was handed;
3. one window pass over pieces and what they were handed; handed rows are context only and are dropped again.

A piece has at most two tickers that go on in other pieces, so what step 2 moves grows with the number of pieces. No group is larger
than a piece and ``depth`` rows. The number of pieces follows the bytes that are read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwright.config import FeatureSpec
from barwright.scratch import durable, written

# Bytes of a piece in memory, how much larger rows are there than in their files, and most pieces.
_PIECE_BYTES, _SWELL, _MOST_PIECES = 256 << 20, 4, 100_000
# Ties within a day have no order of their own; this makes results repeatable.
TIE_BREAK = ("Close", "Open", "High", "Low", "Volume")


def rolling_columns(spec: FeatureSpec, partition: list[str], order: list[str]) -> dict:
    """Moving averages, rolling deviation and lags of ``Close``; null until a window is full."""
    w = Window.partitionBy(*partition).orderBy(*order)

    def full(n, value):
        frame = w.rowsBetween(1 - n, Window.currentRow)
        return F.when(F.count("Close").over(frame) >= n, value("Close").over(frame))

    columns = {f"media_movel_{n}d": full(n, F.avg) for n in spec.mean_windows}
    columns[f"volatilidade_{spec.std_window}d"] = full(spec.std_window, F.stddev_samp)
    columns |= {f"lag_{k}d": F.lag("Close", k).over(w) for k in spec.lags}
    return columns


def with_rolling(bars: DataFrame, spec: FeatureSpec, one_bar_per_day: bool = False) -> DataFrame:
    """Add the rolling columns to clean bars.

    ``one_bar_per_day`` states that (Ticker, Date) is unique, so that a ticker
    cannot exceed the number of calendar days.
    """
    if one_bar_per_day:
        return bars.withColumns(rolling_columns(spec, ["Ticker"], ["Date"]))
    order = ["Date", *TIE_BREAK, *[c for c in bars.columns if c not in ("Date", "Ticker", *TIE_BREAK)]]
    return _by_pieces(bars, spec, order)


def ticker_counts(bars: DataFrame) -> DataFrame:
    return bars.groupBy("Ticker").agg(F.count("*").alias("n_bars"))


def piece_count(bars: DataFrame) -> int:
    """How many pieces the bytes of the frame's sources ask for; the shuffle partitions where a source does not know its bytes."""
    leaves = bars._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    spark = bars.sparkSession
    if size >= 1 << 60:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(_MOST_PIECES, max(spark.sparkContext.defaultParallelism, math.ceil(_SWELL * size / _PIECE_BYTES)))


def _by_pieces(bars: DataFrame, spec: FeatureSpec, order: list[str]) -> DataFrame:
    columns = bars.columns
    order = [*order, "_row"]
    numbered = bars.withColumn("_row", F.monotonically_increasing_id())
    cut = numbered.repartitionByRange(spec.pieces or piece_count(bars), "Ticker", *order)
    pieces = written(cut.withColumn("_piece", F.spark_partition_id()), "pieces")
    handed = handed_on(pieces, spec.depth, order).select(*columns, "_row", "_piece", F.lit(False).alias("_own"))
    rows = pieces.withColumn("_own", F.lit(True)).unionByName(handed)
    rolling = rolling_columns(spec, ["_piece", "Ticker"], order)
    return rows.withColumns(rolling).where("_own").select(*columns, *rolling)


def handed_on(pieces: DataFrame, depth: int, order: list[str]) -> DataFrame:
    """For every piece and ticker the ``depth`` rows of the ticker before the piece, with that piece as ``_piece``."""
    along = Window.partitionBy("Ticker").orderBy("_piece")  # a row per piece that holds the ticker
    sizes = pieces.groupBy("Ticker", "_piece").agg(F.count("*").alias("_size"))
    chain = sizes.select(
        "Ticker", "_piece", "_size", F.lag("_piece").over(along).alias("_last"), F.lead("_piece").over(along).alias("_next")
    )
    chain = durable(chain.where("_last IS NOT NULL OR _next IS NOT NULL"))  # at most two rows per piece
    newest = Window.partitionBy("Ticker", "_piece").orderBy(*[F.desc(c) for c in order])
    ending = pieces.join(F.broadcast(chain.where("_next IS NOT NULL").select("Ticker", "_piece", "_next")), ["Ticker", "_piece"])
    # _behind: how many rows of the ticker the row stands before the piece it is handed to.
    tails = ending.withColumn("_behind", F.row_number().over(newest)).where(F.col("_behind") <= depth)
    moving = durable(tails.drop("_piece").withColumnRenamed("_next", "_piece"))
    short = chain.where((F.col("_size") < depth) & F.col("_last").isNotNull() & F.col("_next").isNotNull())
    short = F.broadcast(short.select("Ticker", "_piece", "_size", "_next"))
    handed = moving
    while True:  # at most depth rounds: every short piece on the way holds a row
        moving = moving.join(short, ["Ticker", "_piece"]).withColumn("_behind", F.col("_behind") + F.col("_size"))
        moving = moving.where(F.col("_behind") <= depth).drop("_piece", "_size").withColumnRenamed("_next", "_piece")
        moving = durable(moving)
        if moving.isEmpty():
            return handed
        handed = handed.unionByName(moving)
