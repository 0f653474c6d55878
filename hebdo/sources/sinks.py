"""Writing the published series."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def write_single_csv(df: DataFrame, path: str, order_by: list[str]) -> None:
    """One CSV file with a header, NULL as an empty field, rows in ``order_by``
    order (one task sorts and writes them; the exchange in front of it keeps the
    work before it parallel).  Meant for the published weekly series (countries
    x weeks rows); large outputs go to ``write_parquet`` or ``versions``."""
    (df.repartition(1).sortWithinPartitions(*order_by)
       .write.mode("overwrite").option("header", True).csv(path))


def write_csv_file(df: DataFrame, file_path: str, order_by: list[str]) -> None:
    """One named CSV file (``.../historical_clean_data.csv``) instead of a
    folder: the single ordered part is written to a sibling staging folder
    and renamed onto ``file_path`` with the Hadoop FileSystem of that path
    (local, HDFS or object store alike)."""
    spark = df.sparkSession
    staging = f"{file_path}.staging-{uuid.uuid4().hex}"
    write_single_csv(df, staging, order_by)
    jvm = spark._jvm
    path_cls = jvm.org.apache.hadoop.fs.Path
    target, folder = path_cls(file_path), path_cls(staging)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = [st.getPath() for st in fs.listStatus(folder) if st.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one CSV part in {staging}, found {len(parts)}")
    # the old file steps aside until the new one is in place
    aside = path_cls(f"{staging}/previous") if fs.exists(target) else None
    if aside is not None and not fs.rename(target, aside):
        raise RuntimeError(f"could not replace {file_path}")
    if not fs.rename(parts[0], target):
        if aside is not None:
            fs.rename(aside, target)
        raise RuntimeError(f"could not move {parts[0]} to {file_path}")
    fs.delete(folder, True)      # the staging folder this function created, with the old file


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet, partitioned (e.g. by ``iso_year``) so readers prune by year."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_partitioned_by(df: DataFrame, path: str, column: str) -> None:
    """Both sides of a split (e.g. valid / quarantined by ``date_issue``) in ONE
    pass over the input: Spark writes one sub-folder per value."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)
