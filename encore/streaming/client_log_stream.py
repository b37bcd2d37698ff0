"""Incremental client-log landing with Structured Streaming.

New log files dropped into a folder are split per event and appended as text under
``<sink>/event=<name>/``; the play table is appended as parquet.  Progress is kept in a
checkpoint folder under ``spark.checkpoint.dir`` so a restarted or re-run job (or one
that lost executors) resumes exactly where it stopped.  ``availableNow`` processes what
is there and stops, which fits a daily schedule.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from encore.functions.dates import check_day
from encore.plans.client_log import PLAY_EVENT, client_log_parse, client_log_records
from encore.session import ensure_checkpoint_dir
from encore.sources.scans import DAY_COL


def _checkpoint(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def land_client_log(spark: SparkSession, source_dir: str, records_dir: str, checkpoint: str | None = None,
                    event_name: str = PLAY_EVENT, available_now: bool = True,
                    max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream raw log files into per-event text folders (keyed fan-out)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(source_dir)
    out = client_log_records(lines, event_name)
    w = (out.writeStream.format("text").partitionBy("event").outputMode("append")
            .option("checkpointLocation", _checkpoint(spark, "client_log_records", checkpoint)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(records_dir)


def land_play_table(spark: SparkSession, source_dir: str, table_dir: str, checkpoint: str | None = None,
                    event_name: str = PLAY_EVENT, available_now: bool = True, day: str | None = None) -> StreamingQuery:
    """Stream raw log files into the typed play table (parquet, append, one partition per
    ``data_dt``), as the daily jobs read it.  The day is ``day`` if given, else the yyyyMMdd
    folder that the file lies in; files in no such folder go to the NULL partition."""
    if day is not None:
        data_dt = F.lit(check_day(day))
    else:
        data_dt = F.nullif(F.regexp_extract("_metadata.file_path", r"/(?:data_dt=)?(\d{8})/[^/]*$", 1), F.lit(""))
    lines = spark.readStream.format("text").load(source_dir).select("value", data_dt.alias(DAY_COL))
    plays = client_log_parse(lines, event_name, keep=[DAY_COL])
    w = (plays.writeStream.format("parquet").partitionBy(DAY_COL).outputMode("append")
              .option("checkpointLocation", _checkpoint(spark, "play_table", checkpoint)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(table_dir)
