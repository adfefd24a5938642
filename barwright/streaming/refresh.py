"""File-triggered refresh with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barwright.config import PipelineConfig, RunResult, listing_conf, session_conf
from barwright.plans.job import run, run_changed
from barwright.schema import RAW_PARTITION
from barwright.sinks.files import is_complete
from barwright.sources.raw import touched_days


# Fixed value: what the file listing source offers. Only the path is selected, so no content is read.
_DAY_FOLDER = rf"/(?:{RAW_PARTITION}=)?(\d{{4}}-\d{{2}}-\d{{2}})/[^/]*$"
_FILE_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def refresh_on_new_files(
    spark: SparkSession,
    cfg: PipelineConfig,
    checkpoint: str,
    full: bool = False,
    files_per_batch: int = 10_000,
    on_result: Callable[[int, RunResult], None] | None = None,
    need_marker: bool = True,
) -> StreamingQuery | None:
    """Start a query that processes the raw files that arrived since the last one and then stops.

    The stream carries file names only, whatever the files' schemas. What is
    recomputed follows from the day folders that were written, so late, corrected and withdrawn bars are right;
    ``full`` recomputes everything. A batch that is repeated after a failure
    rewrites the same partitions. While the raw tree lacks its completion marker (a landing is under way) nothing is
    started and the answer is None; the files then belong to the next call.
    """

    if need_marker and not is_complete(spark, cfg.raw_path):
        return None

    def refresh(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        day = F.try_to_date(F.regexp_extract("path", _DAY_FOLDER, 1), "yyyy-MM-dd")
        found = {r[0] for r in batch.select(day).distinct().collect()}  # days of the calendar
        if not found:
            return
        if full:
            result = run(session, cfg)
        else:
            days = found - {None}
            if None in found:  # files outside day folders: the days of their rows, also of those without a close
                paths = [r["path"] for r in batch.where(day.isNull()).select("path").collect()]
                days |= touched_days(session, paths, cfg.raw_schema, cfg.market_tz)
            result = run_changed(session, cfg, days)
        if on_result:
            on_result(batch_id, result)

    reader = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_LISTING)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
    )
    if not full:  # a full run takes all files at once
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # The query keeps the options it was started with.
    with session_conf(spark, listing_conf(spark)):
        files = reader.load(cfg.raw_path).select("path")
        writer = files.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start()
