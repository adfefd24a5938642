"""The batch job raw -> refined -> monthly -> catalog, and its incremental form."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Collection
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwright import schema
from barwright.config import PipelineConfig, RunResult
from barwright.operators.gold import monthly
from barwright.operators.rolling import TIE_BREAK, ticker_counts
from barwright.operators.shape import combine
from barwright.operators.silver import silver
from barwright.plans.serve import table_stats
from barwright.sinks import catalog
from barwright.sinks.commits import Commit, recover
from barwright.sources.folders import day_folders, read_text, stored_keys, write_text
from barwright.sources.manifest import refresh_manifest
from barwright.sources.raw import RawColumns, bars_of, columns_of, raw_frames
from barwright.sources.tables import read_folders, read_partitions

log = logging.getLogger(__name__)

# How far an incremental run first looks back, in calendar days per bar it needs.
_DAYS_PER_BAR = 3
_MAX_LISTED_TICKERS = 1_000
# Ranges of days that one refresh treats apart.
_MAX_SPANS = 8


def run(spark: SparkSession, cfg: PipelineConfig, dry_run: bool = False) -> RunResult:
    """Recompute both tables from all raw bars, so late and corrected bars count.

    Only partitions with rows in this run are replaced. ``dry_run`` reads and
    counts, and publishes nothing.
    """
    if not dry_run:
        recover_tables(spark, cfg)
    if not dry_run and cfg.raw_schema is None:
        refresh_manifest(spark, cfg.raw_path)
    frames = raw_frames(spark, cfg.raw_path, cfg.raw_schema)
    bars = bars_of(frames, cfg.market_tz, cfg.universe)
    # A row per ticker, for the run's statistics.
    counts = ticker_counts(bars).persist()
    try:
        rows, tickers = counts.agg(F.sum("n_bars"), F.count("*")).first()
        if not rows:
            return RunResult("no_data")
        if dry_run:
            return RunResult("dry_run", raw_rows=rows, raw_tickers=tickers)
        _keep_columns(spark, cfg, frames)
        return _publish(spark, cfg, silver(bars, cfg.features), rows, tickers)
    finally:
        counts.unpersist()


def run_changed(spark: SparkSession, cfg: PipelineConfig, touched: DataFrame | Collection[dt.date]) -> RunResult:
    """Recompute what the touched days can change, with the result of a full run.

    ``touched`` are the days that landings wrote, or bars of those days; a day whose bars were withdrawn counts as well.
    A bar changes its own and the next 29 refined rows of its ticker, and the months they lie in. Days that lie close together
    form a span. For each span the run rewrites the refined days from its first day to the last row it can reach, out of the
    bars of that range and the 29 before it per ticker, removes days that are empty now, and then does the same for
    the months. Only the day folders of these ranges are opened.
    """
    recover_tables(spark, cfg)
    days = sorted(_days_of(touched))
    if not days:
        return RunResult("no_data")
    depth = cfg.features.depth
    read = _reader(spark, cfg, days)
    if read is None:  # the new files have columns that the older ones lack: every row is concerned
        return run(spark, cfg)
    changes, raw_rows, raw_tickers = _Changes(), 0, 0
    spans = _spans(days, _DAYS_PER_BAR * depth)
    while spans:
        since, until = spans.pop(0)
        last = _last_reached(read, until, depth)
        while spans and spans[0][0] <= last:
            until = spans.pop(0)[1]
            last = _last_reached(read, until, depth)
        recent = read(first=since - dt.timedelta(days=_DAYS_PER_BAR * depth), last=last)
        before = F.col("Date") < since
        counts = (
            recent.groupBy("Ticker")
            .agg(F.count("*").alias("n_bars"), F.count(F.when(before, 1)).alias("n_before"))
            .persist()
        )
        try:
            affected = counts.where(F.col("n_bars") > F.col("n_before"))
            rows, tickers = affected.agg(F.sum(F.col("n_bars") - F.col("n_before")), F.count("*")).first()
            raw_rows, raw_tickers = raw_rows + (rows or 0), max(raw_tickers, tickers)
            bars = _with_history(read, recent, affected, since, depth)
            fresh = silver(bars, cfg.features).where(F.col("data_pregao").between(since, last))
            _write_span(spark, cfg, fresh, since, last, changes)
        finally:
            counts.unpersist()
    return _result(spark, cfg, changes, raw_rows, raw_tickers, discover=False)


def _days_of(touched: DataFrame | Collection[dt.date]) -> set[dt.date]:
    if not isinstance(touched, DataFrame):
        return set(touched)
    return {r[0] for r in touched.select("Date").where("Date is not null").distinct().collect()}  # days of the calendar


def _spans(days: list[dt.date], gap: int) -> list[tuple[dt.date, dt.date]]:
    """Days at most ``gap`` apart form a span; the closest spans are joined until there are at most ``_MAX_SPANS``."""
    spans = [[d, d] for d in days[:1]]
    for d in days[1:]:
        if (d - spans[-1][1]).days <= gap:
            spans[-1][1] = d
        else:
            spans.append([d, d])
    while len(spans) > _MAX_SPANS:
        k = min(range(len(spans) - 1), key=lambda i: spans[i + 1][0] - spans[i][1])
        spans[k : k + 2] = [[spans[k][0], spans[k + 1][1]]]
    return [(a, b) for a, b in spans]


def _reader(spark: SparkSession, cfg: PipelineConfig, days: list[dt.date]):
    """``read(first, last)``: clean bars of a range of days, from the folders of that range where the tree is laid out by day.

    Columns that any raw file has count for all rows (a null there drops a row), so the columns seen so far are kept
    beside the refined table. None if the touched days bring columns that were not known."""
    how = {"market_tz": cfg.market_tz, "universe": cfg.universe}
    folders = day_folders(spark, cfg.raw_path)
    known = _known_columns(spark, cfg)
    if folders is None or known is None:
        frames = raw_frames(spark, cfg.raw_path, cfg.raw_schema)
        _keep_columns(spark, cfg, frames)
        return partial(bars_of, frames, **how)

    def frames_of(first: dt.date | None = None, last: dt.date | None = None) -> list[DataFrame]:
        wanted = [f for d, f in folders.items() if (first is None or d >= first) and (last is None or d <= last)]
        return raw_frames(spark, wanted, cfg.raw_schema) if wanted else []

    touched = [folders[d] for d in days if d in folders]
    new = columns_of(raw_frames(spark, touched, cfg.raw_schema)) if touched else RawColumns()
    if new.wide > known.wide or not (known.wide or new.extras <= known.extras):
        return None
    extras = () if known.wide else sorted(known.extras)
    shape = [*schema.RAW_COLUMNS, *extras]

    def read(first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        frames = frames_of(first, last)
        if not frames:
            fields = ", ".join(f"`{c}` {t}" for c, t in schema.BAR_TYPES.items())
            bars = spark.createDataFrame([], fields)
        else:
            bars = bars_of(frames, first=first, last=last, **how)
        lacking = [F.lit(None).cast("string").alias(c) for c in shape if c not in bars.columns]
        return bars.select("*", *lacking).select(*[F.col(f"`{c}`") for c in shape])

    return read


def _columns_file(cfg: PipelineConfig) -> str:
    return f"{cfg.silver_path.rstrip('/')}/_raw_columns.json"


def _known_columns(spark: SparkSession, cfg: PipelineConfig) -> RawColumns | None:
    text = read_text(spark, _columns_file(cfg))
    return RawColumns.parse(text) if text else None


def _keep_columns(spark: SparkSession, cfg: PipelineConfig, frames: list[DataFrame]) -> None:
    write_text(spark, _columns_file(cfg), columns_of(frames).text())


def _last_reached(read, until: dt.date, depth: int) -> dt.date:
    """The last day on which any ticker has one of its ``depth`` bars after ``until``.

    All tickers count, since a day that is landed again may also lose bars.
    """
    later = read(first=until + dt.timedelta(days=1)).select("Ticker", "Date")
    # The rank limit is applied before the exchange too: no task passes on more than depth bars of a ticker.
    oldest = Window.partitionBy("Ticker").orderBy("Date")
    reached = later.withColumn("_rank", F.row_number().over(oldest)).where(F.col("_rank") <= depth)
    return reached.agg(F.max("Date")).first()[0] or until


def _with_history(read, recent: DataFrame, counts: DataFrame, since: dt.date, depth: int) -> DataFrame:
    """``recent`` bars plus what is missing of the ``depth`` bars before ``since`` of each ticker.

    The recent range normally holds them; older files are searched only for
    tickers that are short of bars there, such as thinly traded or new ones.
    """
    start = since - dt.timedelta(days=_DAYS_PER_BAR * depth)
    short = counts.where(F.col("n_before") < depth).select("Ticker", "n_before")
    listed = [r["Ticker"] for r in short.limit(_MAX_LISTED_TICKERS + 1).collect()]
    if not listed:
        return recent
    earlier = read(last=start - dt.timedelta(days=1))
    if len(listed) <= _MAX_LISTED_TICKERS:
        earlier = earlier.where(F.col("Ticker").isin(listed))
    newest = Window.partitionBy("Ticker").orderBy(*[F.desc(c) for c in ("Date", *TIE_BREAK)])
    last_bars = earlier.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= depth)
    missing = last_bars.join(short, "Ticker").where(F.col("_rank") <= depth - F.col("n_before"))
    return recent.unionByName(missing.drop("_rank", "n_before"), allowMissingColumns=True)


@dataclass
class _Changes:
    """Keys of the partitions that a run wrote and removed."""

    days: set[str] = field(default_factory=set)
    months: set[str] = field(default_factory=set)
    gone_days: set[str] = field(default_factory=set)
    gone_months: set[str] = field(default_factory=set)


def _how(cfg: PipelineConfig) -> dict:
    return {"sort_by": ("nome_acao",), "max_records_per_file": cfg.max_records_per_file}


def recover_tables(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Complete what an earlier run had decided but not finished."""
    recover(spark, cfg.silver_path, [cfg.silver_path, cfg.gold_path])


def _publish(spark: SparkSession, cfg: PipelineConfig, refined: DataFrame, raw_rows: int, raw_tickers: int) -> RunResult:
    """Write the refined rows of a full run, their months, and the catalog."""
    change = Commit(spark, cfg.silver_path)
    place, days = change.stage(refined, cfg.silver_path, schema.SILVER_PARTITION, **_how(cfg))
    changes = _Changes(days, {day[:7] + "-01" for day in days})
    if days:
        # The monthly table reads the written one: durable, and only the columns it needs.
        source = read_partitions(spark, place, cfg.features.silver_schema, schema.SILVER_PARTITION)
        change.stage(monthly(source, cfg.features), cfg.gold_path, schema.GOLD_PARTITION, **_how(cfg))
    change.finish()
    return _result(spark, cfg, changes, raw_rows, raw_tickers, discover=True)


def _write_span(
    spark: SparkSession, cfg: PipelineConfig, refined: DataFrame, since: dt.date, last: dt.date, changes: _Changes
) -> None:
    """Replace the refined rows of ``since..last`` and the months of that range, what is empty now included, in one change."""
    change = Commit(spark, cfg.silver_path)
    place, days = change.stage(refined, cfg.silver_path, schema.SILVER_PARTITION, **_how(cfg))
    stored = stored_keys(spark, cfg.silver_path, schema.SILVER_PARTITION)
    gone = {d for d in stored - days if since.isoformat() <= d <= last.isoformat()}
    change.remove(cfg.silver_path, schema.SILVER_PARTITION, gone)
    first_month, last_month = since.isoformat()[:7], last.isoformat()[:7]
    kept = {d for d in (stored | days) - gone if first_month <= d[:7] <= last_month}
    months = {d[:7] + "-01" for d in kept}
    if kept:
        # New days from where they are staged, the others of their months from the table.
        parts = [(place, kept & days), (cfg.silver_path, kept - days)]
        source = combine(
            read_folders(spark, path, cfg.features.silver_schema, schema.SILVER_PARTITION, keys) for path, keys in parts if keys
        )
        change.stage(monthly(source, cfg.features), cfg.gold_path, schema.GOLD_PARTITION, **_how(cfg))
    old_months = stored_keys(spark, cfg.gold_path, schema.GOLD_PARTITION)
    gone_months = {m for m in old_months - months if first_month <= m[:7] <= last_month}
    change.remove(cfg.gold_path, schema.GOLD_PARTITION, gone_months)
    change.finish()
    changes.days |= days
    changes.months |= months
    changes.gone_days |= gone
    changes.gone_months |= gone_months


def _result(
    spark: SparkSession, cfg: PipelineConfig, changes: _Changes, raw_rows: int, raw_tickers: int, discover: bool
) -> RunResult:
    silver_schema = cfg.features.silver_schema
    result = {"raw_rows": raw_rows, "raw_tickers": raw_tickers, "features": len(silver_schema)}
    if not (changes.days or changes.gone_days or changes.months):
        return RunResult("ok", **result)
    reader = read_partitions if discover else read_folders
    n_silver, gold_rows, tickers = 0, 0, 0
    if changes.days:
        n_silver = reader(spark, cfg.silver_path, silver_schema, schema.SILVER_PARTITION, changes.days).count()
    if changes.months:
        gold = reader(spark, cfg.gold_path, schema.GOLD_SCHEMA, schema.GOLD_PARTITION, changes.months)
        gold_rows, tickers = table_stats(gold, "nome_acao").first()
    ok, error = _register(spark, cfg, changes, discover) if cfg.register else (None, None)
    return RunResult(
        "ok", **result, silver_rows=n_silver, gold_rows=gold_rows, tickers=tickers, catalog_ok=ok, catalog_error=error
    )


def _register(spark: SparkSession, cfg: PipelineConfig, changes: _Changes, discover: bool) -> tuple[bool, str | None]:
    """Catalog entries; a failure is reported but does not undo the written data."""
    silver_name, gold_name = f"{cfg.database}.{cfg.silver_table}", f"{cfg.database}.{cfg.gold_table}"
    silver_schema = cfg.features.silver_schema
    try:
        catalog.publish(
            spark, silver_name, silver_schema, schema.SILVER_PARTITION, cfg.silver_path, changes.days, changes.gone_days, discover
        )
        catalog.publish(
            spark, gold_name, schema.GOLD_SCHEMA, schema.GOLD_PARTITION, cfg.gold_path, changes.months, changes.gone_months, discover
        )
        return True, None
    except Exception as error:
        log.warning("catalog update failed, data is written: %s", error)
        return False, str(error)
