"""External tables over the written partitions."""

from __future__ import annotations

import logging
from collections.abc import Collection

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.sources.tables import as_stored

log = logging.getLogger(__name__)


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table(spark: SparkSession, name: str, schema: T.StructType, partition: str, path: str) -> None:
    stored = as_stored(schema, partition)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_columns(stored)}) USING PARQUET "
        f"PARTITIONED BY (`{partition}`) LOCATION {_quoted(path)}"
    )


def drop_table(spark: SparkSession, name: str) -> None:
    """Forget an external table; its files stay. A managed table owns its files and is never dropped."""
    if spark.catalog.tableExists(name) and _described(spark, name, "Type").upper() != "EXTERNAL":
        raise ValueError(f"{name} is not an external table: dropping it would delete its data")
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _described(spark: SparkSession, name: str, what: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == what).collect()
    return rows[-1]["data_type"] if rows else ""


def location(spark: SparkSession, name: str) -> str:
    return _described(spark, name, "Location")


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition: str, path: str) -> bool:
    """Create the table, or recreate it if its columns or its location differ; tells whether it did."""
    if spark.catalog.tableExists(name):
        actual = [(f.name, f.dataType) for f in spark.table(name).schema.fields]
        wanted = [(f.name, f.dataType) for f in as_stored(schema, partition).fields]
        same_place = _plain(location(spark, name)) == _plain(path)
        if actual == wanted and same_place:
            return False
        drop_table(spark, name)
    create_table(spark, name, schema, partition, path)
    return True


def _plain(path: str) -> str:
    return path.removeprefix("file:").replace("//", "/").rstrip("/")


def repair(spark: SparkSession, name: str) -> None:
    """Find all partitions below the table's location."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def add_partitions(spark: SparkSession, name: str, partition: str, keys: Collection[str]) -> None:
    """Register the given keys in one statement; those that exist are left alone."""
    if keys:
        parts = " ".join(f"PARTITION (`{partition}`='{key}')" for key in sorted(keys))
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")


def drop_partitions(spark: SparkSession, name: str, partition: str, keys: Collection[str]) -> None:
    if keys:
        parts = ", ".join(f"PARTITION (`{partition}`='{key}')" for key in sorted(keys))
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")


def list_partitions(spark: SparkSession, name: str):
    return spark.sql(f"SHOW PARTITIONS {name}")


def publish(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition: str,
    path: str,
    keys: Collection[str],
    removed: Collection[str] = (),
    discover: bool = True,
) -> None:
    """Make a written table queryable: entry, partitions by discovery, else those of this run.

    Without ``discover`` an existing entry only learns this run's partitions, whose number the caller knows."""
    created = ensure_table(spark, name, schema, partition, path)
    if not (discover or created):
        drop_partitions(spark, name, partition, removed)
        add_partitions(spark, name, partition, keys)
        spark.catalog.refreshTable(name)
        return
    try:
        repair(spark, name)
    except Exception as error:
        log.warning("partition discovery of %s failed, adding this run's partitions: %s", name, error)
        add_partitions(spark, name, partition, keys)
    spark.catalog.refreshTable(name)
