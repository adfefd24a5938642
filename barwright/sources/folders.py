"""Day folders of a tree and small text files, through Hadoop's file system."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Collection

from pyspark.sql import SparkSession

from barwright.schema import RAW_PARTITION

_DAY = re.compile(r"(?:(?P<key>[^=/]+)=)?(?P<day>\d{4}-\d{2}-\d{2})")


def _located(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


class Tree:
    """Moves and deletions below a folder, with one file system for all of them."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._stat2Paths = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths
        self._system, _ = _located(spark, root)

    def names(self, folder: str) -> list[str]:
        """All names in a folder, hidden ones too; empty if there is no such folder."""
        where = self._path(folder)
        if not self._system.exists(where):
            return []
        return [p.getName() for p in self._stat2Paths(self._system.listStatus(where))]

    def move(self, source: str, target: str) -> None:
        """In place of what is there. No source: nothing to do."""
        a, b = self._path(source), self._path(target)
        if not self._system.exists(a):
            return
        self._system.delete(b, True)
        if not self._system.rename(a, b):
            raise OSError(f"cannot move {source} to {target}")

    def remove(self, path: str) -> None:
        self._system.delete(self._path(path), True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without hidden ones; empty if there is no such folder."""
    system, where = _located(spark, path)
    if not system.exists(where):
        return []
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(system.listStatus(where))
    names = [p.getName() for p in paths]
    return sorted(n for n in names if n[0] not in "_.")


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _located(spark, path)
    return system.exists(where)


def modified(spark: SparkSession, path: str) -> int:
    """When the newest file of a path was written, in milliseconds."""
    system, where = _located(spark, path)
    return max([system.getFileStatus(where).getModificationTime(), *[s.getModificationTime() for s in system.listStatus(where)]])


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Move a folder, in place of what is there."""
    system, where = _located(spark, path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    if system.exists(target):
        system.delete(target, True)
    system.rename(where, target)


def delete(spark: SparkSession, path: str) -> None:
    system, where = _located(spark, path)
    system.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    system, where = _located(spark, path)
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, where = _located(spark, path)
    stream = system.create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def day_folders(spark: SparkSession, root: str) -> dict[dt.date, str] | None:
    """Folders of a raw tree by the day of their bars; None if the tree is laid out in another way.

    Both ``<root>/YYYY-MM-DD/`` and ``<root>/data_particao=YYYY-MM-DD/`` name the day of the bars. One listing, of
    one name per day."""
    out = {}
    for name in children(spark, root):
        match = _DAY.fullmatch(name)
        if not match or match["key"] not in (None, RAW_PARTITION):
            return None
        day = dt.date.fromisoformat(match["day"])
        if day in out:
            return None
        out[day] = f"{root.rstrip('/')}/{name}"
    return out or None


def stored_keys(spark: SparkSession, path: str, partition: str) -> set[str]:
    """Values of a written table's partition key."""
    head = partition + "="
    return {name.removeprefix(head) for name in children(spark, path) if name.startswith(head)}
