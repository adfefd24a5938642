"""Raw Parquet bars: any directory layout, changing schemas, nanosecond timestamps."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.config import listing_conf, session_conf
from barwright.functions import nanos_to_timestamp, to_day
from barwright.operators.clean import clean_bars
from barwright.operators.filters import between_days, in_universe
from barwright.operators.shape import combine, is_wide
from barwright.schema import RAW_COLUMNS, RAW_PARTITION
from barwright.sources.manifest import FILES, file_groups, file_types, manifest_path


def scan_files(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None, merge: bool = True
) -> DataFrame:
    """All Parquet files below the paths as one frame.

    Works for ``<root>/YYYY-MM-DD/`` as well as ``<root>/<column>=<value>/``
    trees; directory names are not columns. No file is an error.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", FILES)
    if schema is not None:
        reader = reader.schema(schema)
    with session_conf(spark, listing_conf(spark)):
        df = reader.option("mergeSchema", merge).parquet(*([paths] if isinstance(paths, str) else paths))
    if "Date" in df.columns and isinstance(df.schema["Date"].dataType, T.LongType):
        df = df.withColumn("Date", nanos_to_timestamp(F.col("Date")))
    return df


def raw_frames(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None
) -> list[DataFrame]:
    """The raw files as few frames as their column types allow, normally one.

    Files may have different columns. Their types come from the manifest, and from the footers of files that it
    lacks; Spark merges the schemas of one file per combination of types. Only if a column has different types (a volume that
    is bigint in one file and double in another) are there several frames.
    """
    whole = [paths] if isinstance(paths, str) else list(paths)
    if schema is not None:
        return [scan_files(spark, whole, schema, merge=False)]
    roots = {paths} if isinstance(paths, str) else {p.rstrip("/").rpartition("/")[0] for p in whole}  # of day folders
    manifest = manifest_path(roots.pop()) if len(roots) == 1 else None
    groups = file_groups(file_types(spark, whole, manifest), whole)
    if not groups:
        return [scan_files(spark, whole)]  # says that there are no files
    return [scan_files(spark, g.paths, _read_schema(spark, g.samples), merge=False) for g in groups]


def _read_schema(spark: SparkSession, samples: Sequence[str]) -> T.StructType:
    return spark.read.option("mergeSchema", "true").parquet(*samples).schema


@dataclass(frozen=True)
class RawColumns:
    """What the columns of raw files mean for every row: wide or not, and columns beside the bars'."""

    wide: bool = False
    extras: frozenset[str] = frozenset()

    def text(self) -> str:
        return json.dumps({"wide": self.wide, "extras": sorted(self.extras)})

    @staticmethod
    def parse(text: str) -> RawColumns:
        found = json.loads(text)
        return RawColumns(found["wide"], frozenset(found["extras"]))


def columns_of(frames: Sequence[DataFrame]) -> RawColumns:
    names = {c for df in frames for c in df.columns}
    wide = any(is_wide(df.columns) for df in frames)
    return RawColumns(wide, frozenset() if wide else frozenset(names - {*RAW_COLUMNS, RAW_PARTITION}))


def bars_of(
    frames: Sequence[DataFrame],
    market_tz: str = "UTC",
    universe: Sequence[str] | None = None,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Clean long bars of raw frames. Day bounds reach the Parquet scan as predicates."""
    wide = any(is_wide(df.columns) for df in frames)
    cleaned = []
    for df in frames:
        bars = clean_bars(between_days(df, first, last, market_tz=market_tz), market_tz)
        # Where any file is wide only the bar columns count; otherwise extra columns are carried along.
        cleaned.append(bars.select(*RAW_COLUMNS) if wide else bars)
    bars = combine(cleaned)
    return bars if universe is None else in_universe(bars, list(universe))


def read_bars(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None, **how) -> DataFrame:
    """Clean long bars of all raw files below the paths; ``how`` as for ``bars_of``."""
    return bars_of(raw_frames(spark, paths, schema), **how)


def touched_days(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None, market_tz: str = "UTC"
) -> set[dt.date]:
    """Days of all rows of the files, whether or not their bars count."""
    out: set[dt.date] = set()
    for df in raw_frames(spark, paths, schema):
        day = to_day(F.col("Date"), df.schema["Date"].dataType, market_tz)
        out |= {r[0] for r in df.select(day.alias("d")).distinct().where("d is not null").collect()}
    return out
