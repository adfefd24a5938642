"""The monthly summary of the refined table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.config import FeatureSpec
from barwright.functions import max_number, mean2, min_number, month_start, round2
from barwright.schema import GOLD_COLUMNS, GOLD_PARTITION


def distinct_days_of_month(day: Column) -> Column:
    """Aggregate: number of different days when all rows share a month.

    One bit per day of the month: exact like a distinct count, but without the
    extra exchange and expansion of one.
    """
    bit = F.call_function("shiftleft", F.lit(1), F.dayofmonth(day) - 1)
    return F.bit_count(F.bit_or(bit)).cast("bigint")


def monthly(silver: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """One row per normalised ticker and month; aggregates the rounded refined values.

    Every aggregate has a fixed-size buffer and is combined before the exchange,
    so a month with very many rows costs no more than another one.
    """
    rounding = spec.rounding
    close, volume = F.col("fechamento"), F.col("volume_negociado")
    months = silver.withColumn("data_pregao", F.col("data_pregao").cast("date")).withColumn(
        GOLD_PARTITION, month_start(F.col("data_pregao"))
    )
    total = F.sum(volume)
    return (
        months.groupBy("nome_acao", GOLD_PARTITION)
        .agg(
            mean2(close, rounding).alias("preco_medio_mensal"),
            round2(min_number(close), rounding).alias("preco_minimo_mensal"),
            round2(max_number(close), rounding).alias("preco_maximo_mensal"),
            total.alias("volume_total_mensal"),
            round2(total.cast("double") / F.nullif(F.count(volume), F.lit(0)), rounding).alias("volume_medio_diario"),
            mean2(F.col("variacao_pct_dia"), rounding).alias("variacao_media_diaria_pct"),
            mean2(F.col(f"volatilidade_{spec.std_window}d"), rounding).alias("volatilidade_media_mensal"),
            distinct_days_of_month(F.col("data_pregao")).alias("dias_negociacao"),
        )
        .select(*GOLD_COLUMNS)
    )
