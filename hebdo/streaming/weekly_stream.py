"""Weekly rollup of landed report files as a Structured Streaming job.

The batch flows rewrite the whole series; this job keeps it up to date
incrementally: new report files landing in a folder are read as a stream,
event time is the report date, and each Monday-based week is emitted once the
watermark has passed its end (late reports within the watermark still count).
State is one partial aggregate per (key, week) -- bounded by keys x open
weeks -- and lives in the checkpoint under the shared checkpoint folder, so
the job restarts where it stopped after an executor or driver loss.

Weeks: Spark's event-time windows are aligned to 1970-01-01 (a Thursday);
``startTime='4 days'`` moves the 7-day windows to start on Mondays.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.operators.dedupe import top1_per_group
from hebdo.operators.rollup import measure_aggregate
from hebdo.session import checkpoint_dir

WEEK_LENGTH = "7 days"
MONDAY_OFFSET = "4 days"


def monday_window(ts: Column | str) -> Column:
    """7-day event-time window starting on Monday 00:00."""
    return F.window(ts, WEEK_LENGTH, startTime=MONDAY_OFFSET)


def weekly_window_aggregate(df: DataFrame, ts_col: str, keys: list[str], measures: list[str],
                            null_policy: str = "keep", reports_col: str | None = "reports",
                            week_col: str = "epiweek") -> DataFrame:
    """Sum ``measures`` per ``keys`` and Monday week; works on batch and on
    streaming DataFrames (the streaming aggregate keeps partial sums as state)."""
    aggs = [measure_aggregate(m, "sum", null_policy) for m in measures]
    if reports_col:
        aggs.append(F.count(F.lit(1)).alias(reports_col))
    out = df.groupBy(monday_window(ts_col).alias("__week"), *keys).agg(*aggs)
    start = F.col("__week.start")
    if isinstance(df.schema[ts_col].dataType, T.TimestampNTZType):
        monday = F.to_date(start)
    else:   # an instant: take its UTC calendar date, whatever the session zone
        monday = F.date_from_unix_date(F.floor(F.unix_seconds(start) / 86400).cast("int"))
    return out.select(monday.alias(week_col), *keys,
                      *[m for m in measures], *([reports_col] if reports_col else []))


def report_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                  date_col: str = "report_date", ts_col: str = "report_ts",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed tidy report files as a stream with an event-time column."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(path)
    # watermarks need an instant: UTC midnight of the report date
    return stream.withColumn(ts_col, F.timestamp_seconds(F.unix_date(F.col(date_col)).cast("long") * 86400))


def weekly_rollup_stream(stream: DataFrame, keys: list[str], measures: list[str], ts_col: str = "report_ts",
                         watermark: str = "14 days", null_policy: str = "keep",
                         dedupe_by: str | None = None, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """Watermarked weekly aggregate; with ``append`` output a week is written
    exactly once, after ``watermark`` has passed its end.

    ``dedupe_by`` first keeps one report per key and day -- the one with the
    largest ``dedupe_by`` value (W1, ties by ``tie_break``) -- as a stateful
    aggregate on (keys, event time), chained before the weekly one: the
    archived flow's order (de-duplicate per day, then sum per week).
    """
    stream = stream.withWatermark(ts_col, watermark)
    if dedupe_by:
        stream = top1_per_group(stream, [*keys, ts_col], dedupe_by, tie_break=list(tie_break))
    return weekly_window_aggregate(stream, ts_col, keys, measures, null_policy)


def start_weekly_rollup(spark: SparkSession, source_path: str, schema: T.StructType | str, sink_path: str,
                        keys: list[str], measures: list[str], checkpoint_location: str | None = None,
                        watermark: str = "14 days", available_now: bool = True, fmt: str = "parquet",
                        dedupe_by: str | None = None, tie_break: tuple[str, ...] = ()):
    """Run the incremental rollup into a Parquet folder; returns the query handle.

    The default checkpoint location is stable across application restarts --
    under the configured ``spark.checkpoint.dir`` (not the per-application
    folder Spark creates inside it), keyed by the sink path -- so a restarted
    job resumes from its last committed batch.
    """
    if checkpoint_location is None:
        root = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
        key = hashlib.sha1(sink_path.encode("utf-8")).hexdigest()[:16]
        checkpoint_location = os.path.join(root, "hebdo-streams", f"weekly-rollup-{key}")
    location = checkpoint_location
    weekly = weekly_rollup_stream(report_stream(spark, source_path, schema, fmt), keys, measures,
                                  watermark=watermark, dedupe_by=dedupe_by, tie_break=tie_break)
    writer = (weekly.writeStream.format("parquet").outputMode("append")
              .option("path", sink_path).option("checkpointLocation", location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
