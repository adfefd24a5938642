"""Parameters of the transform and the outcome of a run."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from barwright import schema


@dataclass(frozen=True)
class FeatureSpec:
    """What the refined table computes; the defaults give the standard 16 columns."""

    mean_windows: tuple[int, ...] = schema.MEAN_WINDOWS
    std_window: int = schema.STD_WINDOW
    lags: tuple[int, ...] = schema.LAGS
    # "all": a null in any column, also a carried extra one, drops the row; "features": extras are ignored.
    null_scope: str = "all"
    # "half_even" or "half_away".
    rounding: str = "half_even"
    # Pieces that bars are cut into where a ticker may have several a day; None: the session's shuffle partitions.
    pieces: int | None = None

    def __post_init__(self):
        if self.null_scope not in ("all", "features"):
            raise ValueError(f"null_scope: {self.null_scope!r}")
        if self.rounding not in ("half_even", "half_away"):
            raise ValueError(f"rounding: {self.rounding!r}")
        if self.pieces is not None and self.pieces < 1:
            raise ValueError("pieces must be positive")

    @property
    def depth(self) -> int:
        """How many earlier bars of its ticker a bar's features depend on."""
        return max([n - 1 for n in (*self.mean_windows, self.std_window)] + list(self.lags))

    @property
    def silver_schema(self) -> T.StructType:
        return schema.silver_schema(self.mean_windows, self.std_window, self.lags)


@dataclass(frozen=True)
class PipelineConfig:
    raw_path: str
    silver_path: str
    gold_path: str
    database: str = schema.DATABASE
    silver_table: str = schema.SILVER_TABLE
    gold_table: str = schema.GOLD_TABLE
    features: FeatureSpec = field(default_factory=FeatureSpec)
    # Restrict the run to these tickers; None keeps all.
    universe: tuple[str, ...] | None = None
    market_tz: str = "UTC"
    # Known raw schema: skips reading the footers of the raw files.
    raw_schema: T.StructType | None = None
    max_records_per_file: int = 0
    register: bool = True


@dataclass(frozen=True)
class RunResult:
    # "ok", "no_data" or "dry_run"
    status: str
    raw_rows: int = 0
    raw_tickers: int = 0
    silver_rows: int = 0
    gold_rows: int = 0
    tickers: int = 0
    features: int = 0
    catalog_ok: bool | None = None
    catalog_error: str | None = None


def configure_session(spark: SparkSession) -> SparkSession:
    """Session settings for the jobs. Operators do not rely on them."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    # Nanosecond timestamps arrive as bigint and are converted on read.
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    return spark


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set session options around one action."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def listing_conf(spark: SparkSession) -> dict[str, str]:
    """List many day directories in a few tasks per core instead of one task each."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    return {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)}
