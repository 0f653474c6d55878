"""A3/F9 from file statistics: the latest week of published Parquet files without reading their rows.

The largest value of a column is in the footers of the files.  Spark answers
``max`` from them (aggregate push-down) when it reads the files through its
newer scan; that setting belongs to the session, so the question is asked in a
session of its own and the caller's stays as it is.  The answer then filters
the rows as a constant, which reaches the scan: the data is read once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Session settings under which ``max`` is answered from footers.
FOOTER_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_max(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row with the largest value of a date, number or truth column (``latest``), from the footers."""
    session = spark.newSession()
    for key, value in FOOTER_SETTINGS.items():
        session.conf.set(key, value)
    return session.read.parquet(path).agg(F.max(column).alias("latest"))


def latest_week(spark: SparkSession, path: str, week_col: str = "epiweek") -> dt.date | None:
    """The latest week of published files; None if there are no rows."""
    return footer_max(spark, path, week_col).first()["latest"]


def read_before_latest_week(spark: SparkSession, path: str, week_col: str = "epiweek") -> DataFrame:
    """F9 on published files: the rows strictly before their latest week, in one scan."""
    latest = latest_week(spark, path, week_col)
    rows = spark.read.parquet(path)
    return rows.limit(0) if latest is None else rows.where(F.col(week_col) < F.lit(latest))
