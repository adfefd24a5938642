"""The registered queries: every operator of the engine over the whole given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright import schema
from barwright.config import PipelineConfig
from barwright.functions import day_text, month_start, normalize_ticker, parse_timestamp, pct_change, round2
from barwright.operators import filters, shape
from barwright.operators.clean import clean_bars
from barwright.operators.gold import monthly
from barwright.operators.silver import features, silver
from barwright.plans import serve
from barwright.plans.bars import (
    daily_bars,
    dense_bars,
    line_ticker,
    scale_bars,
    supplier_ticker,
    table,
    trade_bars,
)
from barwright.plans.job import run
from barwright.scratch import new_folder
from barwright.sinks import catalog
from barwright.sinks.files import is_complete, land_raw, save_partitioned
from barwright.sources.folders import modified, stored_keys
from barwright.sources.manifest import refresh_manifest
from barwright.sources.raw import read_bars, scan_files
from barwright.streaming.refresh import refresh_on_new_files

AS_OF = dt.date(2001, 6, 30)
SINCE = dt.date(2001, 1, 1)
SPLIT_AT = dt.date(1998, 1, 1)
NEWEST = dt.date(2001, 9, 1)
LATE_FIRST, LATE_LAST = dt.date(1998, 6, 1), dt.date(1998, 6, 30)
TICKER = "no4"
UNIVERSE = ("AF4.SA", "NO4.SA", "RF4.SA")
# Days on which a ticker that the tables do not have is landed, and withdrawn later.
GHOST_FIRST, GHOST_LAST = dt.date(1996, 2, 1), dt.date(1996, 4, 15)
GHOST_ALONE = dt.date(1990, 1, 1)

_done: dict[tuple, object] = {}


def _once(make: Callable, spark: SparkSession, sf_dir: str):
    """What ``make`` wrote for this application and state of the input, written on first use."""
    key = (make.__name__, spark.sparkContext.applicationId, sf_dir, modified(spark, f"{sf_dir}/lineitem.parquet"))
    if key not in _done:
        _done[key] = make(spark, sf_dir)
    return _done[key]


def _dense_tickers(spark: SparkSession, sf_dir: str) -> list[str]:
    """Tickers of the dense bars: flag and status combinations, a handful at any scale."""
    tickers = table(spark, sf_dir, "lineitem").select(line_ticker().alias("t")).distinct()
    return sorted(r["t"] for r in tickers.collect())


def _landing(spark: SparkSession, sf_dir: str) -> str:
    path = new_folder(spark, "raw")
    land_raw(dense_bars(spark, sf_dir), path)
    return path


def _wide_landing(spark: SparkSession, sf_dir: str) -> str:
    """Wide files by day; older ones with volumes as double, newer ones without the last ticker."""
    path = new_folder(spark, "wide")
    tickers = _dense_tickers(spark, sf_dir)
    bars = dense_bars(spark, sf_dir)
    older = filters.between_days(bars, None, SPLIT_AT - dt.timedelta(days=1))
    newer = filters.between_days(bars, SPLIT_AT, None)
    wide = shape.long_to_wide(older.withColumn("Volume", F.col("Volume").cast("double")), tickers)
    # As other producers write: with the types that the frames have. Own landings have one type per column.
    for part, place in (
        (wide, path + "/older"),
        (shape.long_to_wide(newer, tickers[:-1]), path + "/newer"),
        (shape.long_to_wide(newer.where(F.col("Ticker") == tickers[-1]), tickers[-1:]), path + "/more"),
    ):
        save_partitioned(part.withColumn(schema.RAW_PARTITION, F.col("Date")), place, schema.RAW_PARTITION)
    refresh_manifest(spark, path)
    return path


def _config(spark: SparkSession, raw: str) -> PipelineConfig:
    lake = new_folder(spark, "lake")
    name = lake.rsplit("-", 1)[1]
    return PipelineConfig(
        raw_path=raw,
        silver_path=f"{lake}/refined",
        gold_path=f"{lake}/agg",
        silver_table=f"{schema.SILVER_TABLE}_{name}",
        gold_table=f"{schema.GOLD_TABLE}_{name}",
    )


def _lake(spark: SparkSession, sf_dir: str) -> PipelineConfig:
    cfg = _config(spark, _once(_landing, spark, sf_dir))
    result = run(spark, cfg)
    if not result.catalog_ok:
        raise RuntimeError(result.catalog_error)
    return cfg


def _streamed_lake(spark: SparkSession, sf_dir: str) -> PipelineConfig:
    """Arrivals of raw files: history with a gap and with bars that should not be there; the missing month (late); the newest
    days; the days of the wrong bars again, once without them, once with their closes withdrawn."""
    raw, checkpoint = new_folder(spark, "raw"), new_folder(spark, "stream")
    cfg = _config(spark, raw)
    bars = dense_bars(spark, sf_dir)
    day = F.col("Date")
    late = day.between(LATE_FIRST, LATE_LAST)
    wrong_days = day.between(GHOST_FIRST, GHOST_LAST)
    ghost = bars.where(wrong_days).withColumn("Ticker", F.lit("ZZ9.SA")).dropDuplicates(["Date"])
    alone = ghost.where(day == GHOST_FIRST).withColumn("Date", F.lit(GHOST_ALONE))
    history = bars.where(~late & (day < NEWEST)).unionByName(ghost).unionByName(alone)
    withdrawn = alone.withColumn("Close", F.lit(None).cast("double"))
    for arrival in (history, bars.where(late), bars.where(day >= NEWEST), bars.where(wrong_days), withdrawn):
        land_raw(arrival, raw)
        refresh_on_new_files(spark, cfg, checkpoint).awaitTermination()
    return cfg


def _silver_table(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    return spark.table(f"{cfg.database}.{cfg.silver_table}")


def _gold_table(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    return spark.table(f"{cfg.database}.{cfg.gold_table}")


def _scale_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(scale_bars(spark, sf_dir), one_bar_per_day=True)


def _dense_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(dense_bars(spark, sf_dir), one_bar_per_day=True)


def _rolling(*columns: str):
    """Rounded rolling columns of every bar, with nulls while a window is not full."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = features(scale_bars(spark, sf_dir), one_bar_per_day=True)
        return df.select("nome_acao", "data_pregao", *[round2(F.col(c)).alias(c) for c in columns])

    return query


def _monthly(*columns: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return monthly(_scale_silver(spark, sf_dir)).select("nome_acao", "mes_referencia", *columns)

    return query


def scan_raw_count(spark, sf_dir):
    return scan_files(spark, _once(_landing, spark, sf_dir)).agg(F.count("*").alias("n_rows"))


def bars_head(spark, sf_dir):
    return dense_bars(spark, sf_dir).orderBy("Ticker", "Date").limit(5)


def clean(spark, sf_dir):
    """Line items with text dates, some of them unreadable, and missing closes."""
    lines = table(spark, sf_dir, "lineitem")
    number = F.col("l_linenumber")
    raw = lines.select(
        F.when(number == 7, "no date").otherwise(day_text(F.col("l_shipdate"))).alias("Date"),
        F.when(number != 6, line_ticker()).alias("Ticker"),
        *[F.col("l_extendedprice").alias(c) for c in ("Open", "High", "Low")],
        F.when(number != 5, F.col("l_extendedprice")).alias("Close"),
        F.col("l_quantity").alias("Volume"),
    )
    return clean_bars(raw)


def tickers_normalized(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    both = lines.select(line_ticker().alias("Ticker")).distinct().union(
        lines.select(supplier_ticker().alias("Ticker")).distinct()
    )
    return both.withColumn("nome_acao", normalize_ticker(F.col("Ticker")))


def intraday_pct(spark, sf_dir):
    pct = round2(pct_change(F.col("Open"), F.col("Close"))).alias("variacao_pct_dia")
    return dense_bars(spark, sf_dir).select("Ticker", "Date", pct)


def amplitude(spark, sf_dir):
    return dense_bars(spark, sf_dir).select("Ticker", "Date", (F.col("High") - F.col("Low")).alias("amplitude_dia"))


def silver_warmup(spark, sf_dir):
    return _scale_silver(spark, sf_dir).groupBy("nome_acao").agg(F.count("*").alias("n_rows"))


def silver_round(spark, sf_dir):
    doubles = [f.name for f in schema.SILVER_SCHEMA.fields if f.dataType.simpleString() == "double"]
    return _dense_silver(spark, sf_dir).select("nome_acao", "data_pregao", *doubles)


def silver_hot_ticker(spark, sf_dir):
    """Refined rows of single trades: a few tickers hold all rows, days have many bars, bars have copies."""
    return silver(trade_bars(spark, sf_dir))


def gold_hot_ticker(spark, sf_dir):
    return monthly(silver_hot_ticker(spark, sf_dir))


def wide_to_long(spark, sf_dir):
    wide = shape.long_to_wide(dense_bars(spark, sf_dir), _dense_tickers(spark, sf_dir))
    return clean_bars(wide).select(*schema.RAW_COLUMNS)


def long_to_wide(spark, sf_dir):
    """Column names without dots here, to keep the result's names plain."""
    bars = dense_bars(spark, sf_dir).withColumn("Ticker", normalize_ticker(F.col("Ticker")))
    return shape.long_to_wide(bars, [t.removesuffix(".SA").lower() for t in _dense_tickers(spark, sf_dir)])


def long_to_wide_roundtrip(spark, sf_dir):
    """Bars to wide files of different schemas and back through the raw reader."""
    return read_bars(spark, _once(_wide_landing, spark, sf_dir)).select(*schema.RAW_COLUMNS)


def union_by_name(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    left = daily_bars(lines, line_ticker()).select("Date", "Ticker", "Open", "Close")
    right = daily_bars(lines, supplier_ticker()).select("Ticker", "Date", "Close", "Volume")
    return shape.combine([left, None, right])


def tag_and_combine(spark, sf_dir):
    """Per-instrument frames without a ticker, tagged and combined; the bars are aggregated once and written."""
    bars = spark.read.parquet(_written_bars(spark, sf_dir))
    frames = [
        shape.tag_ticker(bars.where(F.col("Ticker") == t).drop("Ticker"), t) for t in _dense_tickers(spark, sf_dir)
    ]
    return shape.combine(frames).select(*schema.RAW_COLUMNS)


def _written_bars(spark: SparkSession, sf_dir: str) -> str:
    """Dense bars in one folder per ticker, so that a ticker's frame reads its own files."""
    path = new_folder(spark, "bars")
    dense_bars(spark, sf_dir).write.partitionBy("Ticker").parquet(path)
    return path


def distinct_dates(spark, sf_dir):
    return serve.distinct_days(dense_bars(spark, sf_dir), "Date")


def raw_partition_counts(spark, sf_dir):
    bars = dense_bars(spark, sf_dir).withColumn(schema.RAW_PARTITION, day_text(F.col("Date")))
    return serve.rows_per_day(bars, schema.RAW_PARTITION)


def landed_partition_counts(spark, sf_dir):
    """The same counts from the directories that a landing wrote."""
    landed = spark.read.option("basePath", _once(_landing, spark, sf_dir)).parquet(_once(_landing, spark, sf_dir))
    day = F.col(schema.RAW_PARTITION).cast("string")
    return serve.rows_per_day(landed.withColumn(schema.RAW_PARTITION, day), schema.RAW_PARTITION)


def d1_slice(spark, sf_dir):
    lines = filters.day_before(table(spark, sf_dir, "lineitem"), AS_OF, column="l_shipdate")
    return daily_bars(lines, supplier_ticker())


def lookback_180d(spark, sf_dir):
    lines = filters.lookback(table(spark, sf_dir, "lineitem"), AS_OF, column="l_shipdate")
    return daily_bars(lines, supplier_ticker())


def universe_filter(spark, sf_dir):
    return filters.in_universe(dense_bars(spark, sf_dir), UNIVERSE)


def universe_table(spark, sf_dir):
    """Universe given as a table: suppliers with a positive balance."""
    listed = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0)
    tickers = listed.select(F.concat(F.lit("SUP"), F.col("s_suppkey").cast("string"), F.lit(".SA")).alias("Ticker"))
    return filters.in_universe(scale_bars(spark, sf_dir), tickers)


def q_latest_days(spark, sf_dir):
    return serve.latest_days(_dense_silver(spark, sf_dir), TICKER, AS_OF)


def q_monthly_all(spark, sf_dir):
    return serve.monthly_report(monthly(_dense_silver(spark, sf_dir)))


def q_since_topn(spark, sf_dir):
    return serve.newest_since(_scale_silver(spark, sf_dir), SINCE)


def q_ticker_since(spark, sf_dir):
    return serve.ticker_since(_dense_silver(spark, sf_dir), TICKER, SINCE)


def table_latest_days(spark, sf_dir):
    """The same question in SQL to the registered table, whose day is a text key."""
    cfg = _once(_lake, spark, sf_dir)
    return spark.sql(
        f"SELECT data_pregao, nome_acao, fechamento, media_movel_7d, volatilidade_7d "
        f"FROM {cfg.database}.{cfg.silver_table} WHERE nome_acao = '{TICKER}' "
        f"AND data_pregao >= date_add(DATE'{AS_OF}', -10) ORDER BY data_pregao DESC"
    )


def table_since_topn(spark, sf_dir):
    """Only the newest days that hold ten rows are opened."""
    cfg = _once(_lake, spark, sf_dir)
    bound = serve.newest_bound(spark, cfg.silver_path, schema.SILVER_SCHEMA, schema.SILVER_PARTITION, SINCE)
    newest = _silver_table(spark, cfg).where(F.col(schema.SILVER_PARTITION) >= bound.isoformat())
    return serve.newest_since(newest, SINCE)


def table_ticker_since(spark, sf_dir):
    return serve.ticker_since(_silver_table(spark, _once(_lake, spark, sf_dir)), TICKER, SINCE)


def table_monthly_all(spark, sf_dir):
    return serve.monthly_report(_gold_table(spark, _once(_lake, spark, sf_dir)))


def lake_silver(spark, sf_dir):
    return _silver_table(spark, _once(_lake, spark, sf_dir))


def lake_gold(spark, sf_dir):
    return _gold_table(spark, _once(_lake, spark, sf_dir))


def lake_partitions(spark, sf_dir):
    cfg = _once(_lake, spark, sf_dir)
    days = catalog.list_partitions(spark, f"{cfg.database}.{cfg.silver_table}")
    return days.union(catalog.list_partitions(spark, f"{cfg.database}.{cfg.gold_table}"))


def partition_overwrite(spark, sf_dir):
    """Months from a bound on written again with doubled volume; the months before stay as they were."""
    path = new_folder(spark, "overwrite")
    bars = dense_bars(spark, sf_dir).withColumn("month", month_start(F.col("Date")))
    save_partitioned(bars, path, "month")
    newer = bars.where(F.col("month") >= SINCE)
    save_partitioned(newer.withColumn("Volume", F.col("Volume") * 2), path, "month")
    return spark.read.parquet(path).groupBy("Date").agg(F.sum("Volume").alias("volume"))


def run_stats(spark, sf_dir):
    cfg = _once(_lake, spark, sf_dir)
    tables = {
        "raw": (read_bars(spark, cfg.raw_path), "Ticker"),
        "refined": (_silver_table(spark, cfg), "nome_acao"),
        "monthly": (_gold_table(spark, cfg), "nome_acao"),
    }
    return shape.combine(
        serve.table_stats(df, ticker).select(
            F.lit(name).alias("table_name"), "n_rows", "n_tickers", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, (df, ticker) in tables.items()
    )


def dry_run_counts(spark, sf_dir):
    result = run(spark, _config(spark, _once(_landing, spark, sf_dir)), dry_run=True)
    row = (result.raw_rows, result.raw_tickers, result.status == "dry_run")
    return spark.createDataFrame([row], "n_rows bigint, n_tickers bigint, dry_run boolean")


def table_recreated(spark, sf_dir):
    """An external table with other columns becomes the refined one."""
    cfg = _once(_lake, spark, sf_dir)
    name = f"{cfg.database}.{cfg.silver_table}_again"
    catalog.create_table(spark, name, schema.GOLD_SCHEMA, schema.GOLD_PARTITION, cfg.gold_path)
    catalog.publish(spark, name, schema.SILVER_SCHEMA, schema.SILVER_PARTITION, cfg.silver_path, [])
    return spark.table(name)


def table_dropped(spark, sf_dir):
    """What is left after a table was dropped: no entry, all rows."""
    cfg = _once(_lake, spark, sf_dir)
    name = f"{cfg.database}.{cfg.gold_table}_dropped"
    catalog.publish(spark, name, schema.GOLD_SCHEMA, schema.GOLD_PARTITION, cfg.gold_path, [])
    catalog.drop_table(spark, name)
    rows = spark.read.parquet(cfg.gold_path).agg(F.count("*").alias("n_rows"))
    return rows.select(F.lit(spark.catalog.tableExists(name)).alias("has_entry"), "n_rows")


def partitions_added(spark, sf_dir):
    """A table that knows only the partitions it was told of."""
    cfg = _once(_lake, spark, sf_dir)
    name = f"{cfg.database}.{cfg.silver_table}_newest"
    keys = {k for k in stored_keys(spark, cfg.silver_path, schema.SILVER_PARTITION) if k >= NEWEST.isoformat()}
    catalog.create_table(spark, name, schema.SILVER_SCHEMA, schema.SILVER_PARTITION, cfg.silver_path)
    catalog.add_partitions(spark, name, schema.SILVER_PARTITION, keys)
    return spark.table(name)


def catalog_failure(spark, sf_dir):
    """A catalog that fails leaves the written data and says so."""
    cfg = replace(_config(spark, _once(_landing, spark, sf_dir)), database="no_such_database")
    result = run(spark, cfg)
    rows = spark.read.parquet(cfg.silver_path).agg(F.count("*").alias("n_rows"))
    return rows.select(F.lit(result.status).alias("status"), F.lit(result.catalog_ok).alias("catalog_ok"), "n_rows")


def landing_marker(spark, sf_dir):
    """The completion marker of a landing, and the rows it stands for."""
    path = _once(_landing, spark, sf_dir)
    return scan_files(spark, path).agg(F.count("*").alias("n_rows"), F.lit(is_complete(spark, path)).alias("complete"))


def empty_batch(spark, sf_dir):
    """A run that finds no bars writes nothing."""
    cfg = replace(_config(spark, _once(_landing, spark, sf_dir)), universe=("NOBODY.SA",))
    result = run(spark, cfg)
    written = bool(stored_keys(spark, cfg.silver_path, schema.SILVER_PARTITION))
    raw = read_bars(spark, cfg.raw_path).agg(F.count("*").alias("n_raw"))
    return raw.select("n_raw", F.lit(result.status).alias("status"), F.lit(written).alias("written"))


def flattened_header(spark, sf_dir):
    """Columns under a two-level header, as (series, ticker), named after both."""
    bars = dense_bars(spark, sf_dir).withColumn("Ticker", normalize_ticker(F.col("Ticker")))
    tickers = [t.removesuffix(".SA").lower() for t in _dense_tickers(spark, sf_dir)]
    wide = shape.long_to_wide(bars, tickers)
    header = [("Date", ""), *[(s, t) for t in tickers for s in schema.RAW_SERIES]]
    return shape.flatten_header(wide, header)


def parsed_timestamps(spark, sf_dir):
    """Text dates and times of the line items as timestamps, counted by day."""
    lines = table(spark, sf_dir, "lineitem")
    text = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")
    day = parse_timestamp(F.when(F.col("l_linenumber") % 2 == 0, text).otherwise(F.substring(text, 1, 10)))
    return lines.select(day.cast("date").alias("day")).groupBy("day").agg(F.count("*").alias("n_rows"))


def plain_layout(spark, sf_dir):
    """Bars landed under plain day folders and read back."""
    path = new_folder(spark, "plain")
    land_raw(dense_bars(spark, sf_dir), path, plain=True)
    return read_bars(spark, path).select(*schema.RAW_COLUMNS)


def tied_newest(spark, sf_dir):
    """The newest rows where tickers share a name and bars are repeated: ties are broken by every column."""
    bars = dense_bars(spark, sf_dir)
    alike = bars.withColumn("Ticker", F.regexp_replace("Ticker", r"\.SA$", "")).withColumn("Volume", F.col("Volume") + 1)
    refined = silver(bars.unionByName(alike).unionByName(bars))
    return serve.newest_since(refined, SINCE, 25)


def stream_equals_batch(spark, sf_dir):
    return _silver_table(spark, _once(_streamed_lake, spark, sf_dir))


def stream_gold_equals_batch(spark, sf_dir):
    return _gold_table(spark, _once(_streamed_lake, spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_raw_count": scan_raw_count,
    "bars_head": bars_head,
    "clean_bars": clean,
    "normalize_ticker": tickers_normalized,
    "intraday_pct": intraday_pct,
    "amplitude": amplitude,
    "ma_7": _rolling("media_movel_7d"),
    "ma_14": _rolling("media_movel_14d"),
    "ma_30": _rolling("media_movel_30d"),
    "vol_7": _rolling("volatilidade_7d"),
    "lags": _rolling("lag_1d", "lag_2d", "lag_3d"),
    "silver_warmup": silver_warmup,
    "silver_round": silver_round,
    "silver_full": _scale_silver,
    "silver_dense": _dense_silver,
    "silver_hot_ticker": silver_hot_ticker,
    "gold_price": _monthly("preco_medio_mensal", "preco_minimo_mensal", "preco_maximo_mensal"),
    "gold_volume": _monthly("volume_total_mensal", "volume_medio_diario"),
    "gold_risk": _monthly("variacao_media_diaria_pct", "volatilidade_media_mensal"),
    "gold_days": _monthly("dias_negociacao"),
    "gold_full": lambda spark, sf_dir: monthly(_scale_silver(spark, sf_dir)).orderBy("nome_acao", "mes_referencia"),
    "gold_dense": lambda spark, sf_dir: monthly(_dense_silver(spark, sf_dir)),
    "gold_hot_ticker": gold_hot_ticker,
    "wide_to_long": wide_to_long,
    "long_to_wide": long_to_wide,
    "long_to_wide_roundtrip": long_to_wide_roundtrip,
    "union_by_name": union_by_name,
    "tag_and_combine": tag_and_combine,
    "distinct_dates": distinct_dates,
    "raw_partition_counts": raw_partition_counts,
    "landed_partition_counts": landed_partition_counts,
    "d1_slice": d1_slice,
    "lookback_180d": lookback_180d,
    "universe_filter": universe_filter,
    "universe_table": universe_table,
    "q_latest_days": q_latest_days,
    "q_monthly_all": q_monthly_all,
    "q_since_topn": q_since_topn,
    "q_ticker_since": q_ticker_since,
    "table_latest_days": table_latest_days,
    "table_monthly_all": table_monthly_all,
    "table_since_topn": table_since_topn,
    "table_ticker_since": table_ticker_since,
    "lake_silver": lake_silver,
    "lake_gold": lake_gold,
    "lake_partitions": lake_partitions,
    "partition_overwrite": partition_overwrite,
    "run_stats": run_stats,
    "dry_run_counts": dry_run_counts,
    "table_recreated": table_recreated,
    "table_dropped": table_dropped,
    "partitions_added": partitions_added,
    "catalog_failure": catalog_failure,
    "landing_marker": landing_marker,
    "empty_batch": empty_batch,
    "flattened_header": flattened_header,
    "parsed_timestamps": parsed_timestamps,
    "plain_layout": plain_layout,
    "tied_newest": tied_newest,
    "stream_equals_batch": stream_equals_batch,
    "stream_gold_equals_batch": stream_gold_equals_batch,
}
