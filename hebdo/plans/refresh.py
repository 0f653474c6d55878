"""X13/X14 kept up to date: only the weeks that new rows touch are computed again.

The store has two Parquet folders.  ``reports`` holds the merged report rows,
partitioned by the year of their week and by batch; ``series`` holds the
published weekly rows, partitioned by ``iso_year``.  A refresh

1. writes the batch's rows to their own partitions (running a batch again
   replaces them),
2. finds the weeks that the rows touch,
3. reads the reports of those weeks -- the years prune partitions -- and
   computes the weeks with the same function as a full run,
4. puts them beside the untouched weeks of the touched years and overwrites
   those years' partitions only.

Every step can run again: a refresh that failed half-way is repaired by
repeating the batch.  One refresh runs at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.functions.dates import week_start
from hebdo.session import materialize

BATCH_COL, YEAR_COL, WEEK_COL = "batch", "iso_year", "epiweek"

#: report rows of whole weeks (with ``epiweek``) -> the weekly rows to publish
Weekly = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class SeriesStore:
    """Folders of a refreshed series and the function that makes weekly rows of report rows."""
    root: str
    weekly: Weekly
    date_col: str = "report_date"

    @property
    def reports_path(self) -> str:
        return f"{self.root}/reports"

    @property
    def series_path(self) -> str:
        return f"{self.root}/series"

    def reports(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.reports_path)

    def series(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.series_path)


def _overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def refresh(store: SeriesStore, batch: int, rows: DataFrame) -> DataFrame:
    """Add a batch of report rows to the store; the touched weeks (``epiweek``, ``iso_year``).

    Rows without a date belong to no week: they are kept in no partition and published nowhere, as
    in a full run; split them off before (Q1).  A batch is repeated whole or not at all."""
    spark = rows.sparkSession
    week = week_start(store.date_col)
    dated = rows.where(F.col(store.date_col).isNotNull()).withColumns({WEEK_COL: week, YEAR_COL: F.year(week),
                                                                       BATCH_COL: F.lit(batch).cast("long")})
    _overwrite_partitions(dated, store.reports_path, [YEAR_COL, BATCH_COL])
    reports = store.reports(spark)
    touched = materialize(reports.where(F.col(BATCH_COL) == batch).select(YEAR_COL, WEEK_COL).distinct())
    years = [r[0] for r in touched.select(YEAR_COL).distinct().collect()]          # a few dozen at most
    if not years:
        return touched
    weeks = touched.select(F.col(WEEK_COL).alias("__week"))
    in_touched = F.col(WEEK_COL) == F.col("__week")
    open_reports = reports.where(F.col(YEAR_COL).isin(years)).join(weeks, in_touched, "left_semi")
    # sources may be tagged with the year; the weekly function makes its own
    fresh = store.weekly(open_reports.drop(YEAR_COL, BATCH_COL))
    if _exists(spark, store.series_path):
        rest = store.series(spark).where(F.col(YEAR_COL).isin(years)).join(weeks, in_touched, "left_anti")
        fresh = rest.select(*fresh.columns).unionByName(fresh)
    _overwrite_partitions(materialize(fresh), store.series_path, [YEAR_COL])
    return touched
