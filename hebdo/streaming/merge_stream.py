"""The weekly rollup of a stream as a merge.

Each micro-batch of report rows is folded into a published weekly series that
readers see at any time, open weeks included:

* rows of weeks that are closed -- older than the latest week of all earlier
  batches by more than ``allowed_weeks`` -- go to a side table, unchanged;
* the others become one partial sum a key and week, written under the number
  of the micro-batch;
* the weeks that the batch touches are summed again from all partial sums and
  overwrite the partitions of their years.

Everything is keyed by the batch number that the stream's checkpoint gives:
a batch that ran before, wholly or in part, writes the same partitions again,
so a restart after a failure at any point neither loses nor doubles a row.
What counts as closed is decided from the batches before this one, for the
same reason.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.functions.dates import week_start
from hebdo.session import materialize

BATCH_COL, YEAR_COL, WEEK_COL, REPORTS_COL = "batch", "iso_year", "epiweek", "reports"


@dataclass(frozen=True)
class WeeklyMerge:
    """Where a merged series lives and how it is summed."""
    root: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    date_col: str = "report_date"
    allowed_weeks: int = 2

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def _overwrite(df: DataFrame, path: str, by: Sequence[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _stored(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The rows of a folder that may not be there yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _sums(target: WeeklyMerge, reports) -> list:
    return [F.sum(m).alias(m) for m in target.measures] + [reports.alias(REPORTS_COL)]


def closed_before(spark: SparkSession, target: WeeklyMerge, batch: int):
    """The first week that is still open for a batch; None while there is no earlier one."""
    stored = _stored(spark, target.path("partial"), f"{WEEK_COL} date, {BATCH_COL} bigint")
    latest = stored.where(F.col(BATCH_COL) < batch).agg(F.max(WEEK_COL).alias("w"))
    return latest.select(F.date_sub("w", 7 * target.allowed_weeks).alias("w")).first()["w"]


def merge_batch(target: WeeklyMerge, rows: DataFrame, batch: int) -> None:
    """Fold one micro-batch into the series; repeating it changes nothing."""
    spark = rows.sparkSession
    week = week_start(target.date_col)
    open_from = closed_before(spark, target, batch)
    dated = rows.withColumns({WEEK_COL: week, YEAR_COL: F.year(week), BATCH_COL: F.lit(batch).cast("long")})
    # a row without a date has no week: it goes to the side table as well
    late = F.col(WEEK_COL).isNull() if open_from is None else (
        F.col(WEEK_COL).isNull() | (F.col(WEEK_COL) < F.lit(open_from)))
    dated = materialize(dated)
    _overwrite(dated.where(late).drop(WEEK_COL, YEAR_COL), target.path("late"), [BATCH_COL])
    partial = dated.where(~late).groupBy(*target.keys, WEEK_COL, YEAR_COL, BATCH_COL).agg(
        *_sums(target, F.count(F.lit(1))))
    partial = materialize(partial)
    _overwrite(partial, target.path("partial"), [YEAR_COL, BATCH_COL])
    publish_weeks(target, partial)


def publish_weeks(target: WeeklyMerge, partial: DataFrame) -> None:
    """Sum the weeks of ``partial`` again from all stored partial sums and publish them."""
    spark = partial.sparkSession
    years = [r[0] for r in partial.select(YEAR_COL).distinct().collect()]           # a few dozen at most
    if not years:
        return
    weeks = partial.select(F.col(WEEK_COL).alias("__week")).distinct()
    touched = F.col(WEEK_COL) == F.col("__week")
    stored = _stored(spark, target.path("partial"), partial.schema).where(F.col(YEAR_COL).isin(years))
    fresh = stored.join(weeks, touched, "left_semi").groupBy(*target.keys, WEEK_COL, YEAR_COL).agg(
        *_sums(target, F.sum(REPORTS_COL)))
    series = _stored(spark, target.path("series"), fresh.schema).where(F.col(YEAR_COL).isin(years))
    rest = series.join(weeks, touched, "left_anti")
    _overwrite(materialize(rest.select(*fresh.columns).unionByName(fresh)), target.path("series"), [YEAR_COL])


def merged_series(spark: SparkSession, target: WeeklyMerge) -> DataFrame:
    """The published weekly series: keys, epiweek, measures, reports."""
    return spark.read.parquet(target.path("series")).select(*target.keys, WEEK_COL, *target.measures, REPORTS_COL)


def late_rows(spark: SparkSession, target: WeeklyMerge) -> DataFrame:
    """The side table: report rows that came after their week was closed, with their batch."""
    return spark.read.parquet(target.path("late"))


def start_weekly_merge(stream: DataFrame, target: WeeklyMerge, checkpoint_location: str, available_now: bool = True):
    """Run the merge over a stream of report rows; returns the query handle.

    ``checkpoint_location`` belongs to the target: it numbers the batches that the target's folders are
    keyed by, so both are kept or dropped together."""
    writer = stream.writeStream.foreachBatch(lambda rows, batch: merge_batch(target, rows, batch)).option(
        "checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
