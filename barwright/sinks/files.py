"""Partitioned Parquet writes that replace only the partitions they contain."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.config import session_conf
from barwright.functions import day_text, parse_timestamp, to_day
from barwright.operators.shape import series_of, whole_volume
from barwright.schema import RAW_PARTITION, RAW_SERIES
from barwright.sources.folders import delete, exists, rename, stored_keys, write_text

MARKER = "_SUCCESS"


# Many small day files cost by number, not by bytes, so adaptive execution may keep small tasks apart here.
_WRITE_CONF = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB"}


def save_partitioned(
    df: DataFrame, path: str, column: str, sort_by: tuple[str, ...] = (), max_records_per_file: int = 0
) -> None:
    """Write ``<path>/<column>=YYYY-MM-DD/``; partitions absent from this run stay untouched."""
    write_partitions(df, path, column, sort_by, max_records_per_file, replace=True)


def write_partitions(
    df: DataFrame, path: str, column: str, sort_by: tuple[str, ...] = (), max_records_per_file: int = 0, replace: bool = False
) -> None:
    """Write ``<path>/<column>=YYYY-MM-DD/`` to a new folder, or in place of the days that are there.

    Rebalancing gives few files per day and lets adaptive execution cut a day
    that is much larger than others into several tasks.
    """
    keyed = df.withColumn(column, day_text(F.col(column)))
    writer = (
        keyed.hint("rebalance", column)
        .sortWithinPartitions(column, *sort_by)
        .write.option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(column)
    )
    if replace:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with session_conf(df.sparkSession, _WRITE_CONF):
        writer.parquet(path)


def _canonical(df: DataFrame) -> DataFrame:
    """Prices as double and volumes as bigint, in long and wide frames: landings never disagree on a type."""

    def typed(field: T.StructField):
        series = (series_of(field.name) or (field.name,))[0]
        column = F.col(f"`{field.name}`")
        if series == "Volume":
            return whole_volume(column, field.dataType).alias(field.name)
        return column.cast("double").alias(field.name) if series in RAW_SERIES else column

    return df.select(*[typed(f) for f in df.schema.fields])


def land_raw(df: DataFrame, path: str, market_tz: str = "UTC", plain: bool = False) -> None:
    """Land raw bars by calendar day. The day is in the directory name only; ``plain`` names it without a key.

    ``Date`` stays as it is, except that text becomes a timestamp. Prices and volumes get one type each.

    Landing a day again replaces it, under new file names, so that file streams notice it.
    A marker at the root tells that all files are there; it is away while files arrive.
    """
    delete(df.sparkSession, f"{path.rstrip('/')}/{MARKER}")
    if isinstance(df.schema["Date"].dataType, T.StringType):
        df = df.withColumn("Date", parse_timestamp(F.col("Date")))
    day = to_day(F.col("Date"), df.schema["Date"].dataType, market_tz)
    keyed = _canonical(df).withColumn(RAW_PARTITION, day)
    if plain:
        staged = f"{path.rstrip('/')}/_landing-{uuid.uuid4().hex[:12]}"
        save_partitioned(keyed, staged, RAW_PARTITION)
        for key in sorted(stored_keys(df.sparkSession, staged, RAW_PARTITION)):
            rename(df.sparkSession, f"{staged}/{RAW_PARTITION}={key}", f"{path.rstrip('/')}/{key}")
        delete(df.sparkSession, staged)
    else:
        save_partitioned(keyed, path, RAW_PARTITION)
    mark_complete(df.sparkSession, path)


def mark_complete(spark: SparkSession, path: str) -> None:
    """An empty ``_SUCCESS``; a write that replaces partitions one by one does not leave one at the root."""
    write_text(spark, f"{path.rstrip('/')}/{MARKER}", "")


def is_complete(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path.rstrip('/')}/{MARKER}")
