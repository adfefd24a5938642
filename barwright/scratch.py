"""Shared folders for data that a job writes and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one below the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch").rstrip("/")


def durable(frame: DataFrame) -> DataFrame:
    """The frame computed once and kept in the shared folder, so that it stays the same and outlives its executors."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(frame.sparkSession))
    return frame.checkpoint()


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_root(spark)}/barwright-{purpose}-{uuid.uuid4().hex[:12]}"


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """Like ``durable``, as Parquet: smaller, and later reads prune columns."""
    path = new_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
