"""The refined and monthly tables, by catalog name or by path."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.config import listing_conf, session_conf


def as_stored(schema: T.StructType, partition: str) -> T.StructType:
    """The stored form of a table: the partition key is text and comes last."""
    data = [f for f in schema.fields if f.name != partition]
    return T.StructType([*data, T.StructField(partition, T.StringType())])


def read_partitions(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition: str,
    keys: Collection[str] | None = None,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """A written table with its key as a date; ``keys``, ``first`` and ``last`` prune partitions."""
    with session_conf(spark, listing_conf(spark)):
        df = spark.read.schema(as_stored(schema, partition)).parquet(path)
    if keys is not None:
        df = df.where(F.col(partition).isin(sorted(keys)))
    if first is not None:
        df = df.where(F.col(partition) >= first.isoformat())
    if last is not None:
        df = df.where(F.col(partition) <= last.isoformat())
    return df.withColumn(partition, F.col(partition).cast("date")).select(*schema.fieldNames())


def read_folders(
    spark: SparkSession, path: str, schema: T.StructType, partition: str, keys: Collection[str]
) -> DataFrame:
    """The given partitions of a written table, without a listing of the others."""
    root = path.rstrip("/")
    df = spark.read.schema(as_stored(schema, partition)).option("basePath", root)
    df = df.parquet(*[f"{root}/{partition}={key}" for key in sorted(keys)])
    return df.withColumn(partition, F.col(partition).cast("date")).select(*schema.fieldNames())


def day_bound(df: DataFrame, column: str, day: dt.date) -> Column:
    """``day`` as a literal of the column's type, so that a text partition key is pruned without a cast."""
    text = isinstance(df.schema[column].dataType, T.StringType)
    return F.lit(day.isoformat() if text else day)
