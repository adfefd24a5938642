"""Column types of raw files: a manifest with one row per file, kept as Parquet beside the raw tree.

A file's footer is read once, in a task, when the file is first seen. A row counts as long as the file still has the size and
time it was read with, so landings that replace files need not touch the manifest; rows of files that are gone fall out when
it is written anew. Files whose columns have the same types share a key; what reaches the driver is one row per key, and, where
types disagree, folders per group, with single files only for folders that mix groups.
"""

from __future__ import annotations

import io
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.config import listing_conf, session_conf
from barwright.scratch import durable
from barwright.sources.folders import children, delete, exists, rename

FILES = "*.parquet"
MANIFEST = "_types"
_ROW = "path string, modified timestamp, length bigint, types map<string,string>"
#: The manifest is written anew when less than this share of its rows is of files that are there.
_LIVE = 0.5


def manifest_path(root: str) -> str:
    return f"{root.rstrip('/')}/{MANIFEST}"


def _listed(spark: SparkSession, paths: Sequence[str], content: bool = False) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", FILES)
    with session_conf(spark, listing_conf(spark)):
        files = reader.load(list(paths))
    return files.select("path", F.col("modificationTime").alias("modified"), "length", *(["content"] if content else []))


def _kinds(metadata) -> dict[str, str]:
    """Types by column. Units that are read as one type have one name; INT96 is not the 64-bit nanoseconds it looks like."""
    schema = metadata.schema.to_arrow_schema()
    old = {metadata.schema.column(k).path for k in range(metadata.num_columns) if metadata.schema.column(k).physical_type == "INT96"}
    kind = lambda f: "int96" if f.name in old else re.sub(r"^timestamp\[(ms|us)", "timestamp[", str(f.type).removeprefix("large_"))
    return {f.name: kind(f) for f in schema}


def _file_system(path: str):
    from pyarrow import fs

    uri = path.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if "://" not in uri else uri)


def _from_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq

    for batch in batches:
        types = []
        for path in batch["path"]:
            system, name = _file_system(path)
            with system.open_input_file(name) as file:
                types.append(_kinds(pq.read_metadata(file)))
        yield batch.assign(types=types)


def _from_content(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq

    for batch in batches:
        types = [_kinds(pq.read_metadata(io.BytesIO(body))) for body in batch["content"]]
        yield batch.drop(columns="content").assign(types=types)


def _reachable(path: str) -> bool:
    """Whether tasks can open footers by themselves; otherwise Hadoop reads the files for them."""
    try:
        _file_system(path)
        return True
    except Exception:
        return False


def file_types(spark: SparkSession, paths: Sequence[str], manifest: str | None = None) -> DataFrame:
    """(path, modified, length, types) of every raw file below the paths; footers are read of files that the manifest lacks."""
    files = _listed(spark, paths)
    old = _stored(spark, manifest)
    if old is None:
        new = files
        known = None
    else:
        same = ["path", "modified", "length"]
        known = files.join(old, same).select(*same, "types")
        new = files.join(old, same, "left_anti")
    first = files.select("path").head()
    if first is None or _reachable(first["path"]):
        read = new.mapInPandas(_from_footers, _ROW)
    else:
        body = _listed(spark, paths, content=True)
        read = body.join(new.select("path"), "path", "left_semi").mapInPandas(_from_content, _ROW)
    return durable(read if known is None else known.unionByName(read))


def _stored(spark: SparkSession, manifest: str | None) -> DataFrame | None:
    if manifest is None or not exists(spark, manifest) or not children(spark, manifest):
        return None
    return spark.read.schema(_ROW).parquet(manifest).dropDuplicates(["path", "modified", "length"])


def refresh_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Bring the manifest of a raw tree up to date and return the rows of the files that are there."""
    manifest = manifest_path(root)
    rows = file_types(spark, [root], manifest)
    old = _stored(spark, manifest)
    if old is None:
        rows.write.mode("append").parquet(manifest)
        return rows
    same = ["path", "modified", "length"]
    new = rows.join(old, same, "left_anti")
    live, kept = rows.count(), old.count()
    if kept * _LIVE > live:
        staged = f"{root.rstrip('/')}/_types-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(staged)
        delete(spark, manifest)
        rename(spark, staged, manifest)
    elif not new.isEmpty():
        new.write.mode("append").parquet(manifest)
    return rows


@dataclass(frozen=True)
class FileGroup:
    """Paths (folders, or files of mixed folders) in which every column has one type, and a file of each combination of columns."""

    paths: tuple[str, ...]
    samples: tuple[str, ...]


def types_to_groups(combinations: Mapping[int, Mapping[str, str]]) -> dict[int, int]:
    """Combinations of column types, by key, to groups within which every column has one type; columns may differ.

    A combination without a column fits any type of it; those that say most come first."""
    kinds: dict[str, set[str]] = {}
    for types in combinations.values():
        for column, kind in types.items():
            kinds.setdefault(column, set()).add(kind)
    conflicts = sorted(c for c, k in kinds.items() if len(k) > 1)
    told = {key: tuple(types.get(c) for c in conflicts) for key, types in combinations.items()}
    merged: list[tuple] = []
    group_of: dict[int, int] = {}
    for key, own in sorted(told.items(), key=lambda item: (item[1].count(None), str(item[1]), item[0])):
        fits = (k for k, other in enumerate(merged) if all(a == b or None in (a, b) for a, b in zip(own, other)))
        k = next(fits, len(merged))
        if k == len(merged):
            merged.append(own)
        merged[k] = tuple(a or b for a, b in zip(own, merged[k]))
        group_of[key] = k
    return group_of


def keyed(files: DataFrame) -> DataFrame:
    """(path, key): equal keys for equal column types."""
    entries = F.array_sort(F.transform(F.map_entries("types"), lambda e: F.concat(e["key"], F.lit("\t"), e["value"])))
    return files.select("path", F.xxhash64(entries).alias("key"), "types")


def file_groups(files: DataFrame, whole: Sequence[str]) -> list[FileGroup]:
    """The files in as few groups as their types allow; a single group is all of ``whole``."""
    rows = keyed(files)
    kinds = rows.groupBy("key").agg(F.min("path").alias("sample"), F.first("types").alias("types")).collect()
    group_of = types_to_groups({r["key"]: r["types"] for r in kinds})
    samples: dict[int, list[str]] = {}
    for r in sorted(kinds, key=lambda r: r["sample"]):
        samples.setdefault(group_of[r["key"]], []).append(r["sample"])
    if len(samples) <= 1:
        return [FileGroup(tuple(whole), tuple(s)) for s in samples.values()]
    pairs = files.sparkSession.createDataFrame(list(group_of.items()), "key bigint, group int")  # a row per key
    placed = rows.join(F.broadcast(pairs), "key").withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]*$", 1))
    folders = placed.groupBy("folder").agg(F.min("group").alias("group"), F.count_distinct("group").alias("groups"))
    out: dict[int, list[str]] = {}
    for r in folders.where("groups = 1").collect():
        out.setdefault(r["group"], []).append(r["folder"])
    mixed = folders.where("groups > 1").select("folder")
    for r in placed.join(mixed, "folder", "left_semi").select("path", "group").collect():
        out.setdefault(r["group"], []).append(r["path"])
    return [FileGroup(tuple(sorted(out[k])), tuple(samples[k])) for k in sorted(out)]
