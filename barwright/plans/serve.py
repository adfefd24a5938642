"""The usual questions to the published tables; every one has a total order."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.sources.folders import stored_keys
from barwright.sources.tables import day_bound, read_folders


def _newest(df: DataFrame, *first) -> list:
    """The given order, made total by all columns of the frame: what ties is alike in every column."""
    return [*first, *[F.col(f"`{c}`") for c in df.columns]]


def latest_days(silver: DataFrame, ticker: str, as_of: dt.date, days: int = 10) -> DataFrame:
    """A ticker's closes, weekly mean and volatility since ``days`` before ``as_of``, newest first."""
    since = day_bound(silver, "data_pregao", as_of - dt.timedelta(days=days))
    rows = silver.where((F.col("nome_acao") == ticker) & (F.col("data_pregao") >= since)).select(
        "data_pregao", "nome_acao", "fechamento", "media_movel_7d", "volatilidade_7d"
    )
    return rows.orderBy(*_newest(rows, F.desc("data_pregao")))


def monthly_report(gold: DataFrame) -> DataFrame:
    return gold.select(
        "mes_referencia", "nome_acao", "preco_medio_mensal", "volume_total_mensal", "dias_negociacao"
    ).orderBy(F.desc("mes_referencia"), "nome_acao")


def newest_since(silver: DataFrame, since: dt.date, n: int = 10) -> DataFrame:
    """The ``n`` newest rows from ``since`` on."""
    rows = silver.where(F.col("data_pregao") >= day_bound(silver, "data_pregao", since)).select(
        "data_pregao", "nome_acao", "fechamento", "media_movel_7d"
    )
    return rows.orderBy(*_newest(rows, F.desc("data_pregao"))).limit(n)


def newest_bound(
    spark: SparkSession, path: str, stored: T.StructType, partition: str, since: dt.date, n: int = 10
) -> dt.date:
    """The day from which on a written table has ``n`` rows, not before ``since``: an early stop for ``newest_since``.

    Days are opened newest first, twice as many each time, and only counted, until they hold ``n`` rows. All rows of the last
    opened days count, so the order of rows that tie stays total."""
    days = sorted((k for k in stored_keys(spark, path, partition) if k >= since.isoformat()), reverse=True)
    found, at, step = 0, 0, 1
    while at < len(days):
        opened = days[at : at + step]
        found += read_folders(spark, path, stored, partition, opened).limit(n - found).count()
        if found >= n:
            return dt.date.fromisoformat(opened[-1])
        at, step = at + step, 2 * step
    return since


def ticker_since(silver: DataFrame, ticker: str, since: dt.date, n: int = 10) -> DataFrame:
    """The first ``n`` full rows of a ticker from ``since`` on."""
    day = day_bound(silver, "data_pregao", since)
    rows = silver.where((F.col("nome_acao") == ticker) & (F.col("data_pregao") >= day))
    return rows.orderBy(*_newest(rows, F.col("data_pregao"))).limit(n)


def distinct_days(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def rows_per_day(raw: DataFrame, day: str) -> DataFrame:
    return raw.groupBy(day).agg(F.count("*").alias("n_rows"))


def table_stats(df: DataFrame, ticker: str) -> DataFrame:
    """Row count and distinct tickers in one pass."""
    return df.agg(F.count("*").alias("n_rows"), F.countDistinct(ticker).alias("n_tickers"))
