"""S9/K1 at scale: versions of a published series behind one pointer.

A version is a folder of Parquet parts in publication order: rows are dealt to
parts by ranges of the order columns and sorted inside them, so no task holds
more than a part.  Before it is published the written files themselves are
checked: every part is sorted, and no part begins before the one in front of
it ends.  The manifest beside the parts holds their rows and first and last
keys.

The pointer file ``CURRENT`` names the version that readers see.  It is written
aside and renamed over the old one in one step, after the checks; a failure at
any earlier point leaves the old version in place and readable.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

POINTER = "CURRENT"
MANIFEST = "_manifest"              # the reader of the parts skips names that begin with "_"
PART_ROWS = 5_000_000


class BrokenOrder(RuntimeError):
    """The written parts are not in publication order."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, root: str) -> str | None:
    """The name of the version that readers see; None before the first one."""
    fs, pointer = _file_system(spark, root), _path(spark, f"{root}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _point_to(spark: SparkSession, root: str, version: str) -> None:
    fs = _file_system(spark, root)
    aside = _path(spark, f"{root}/{POINTER}-{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    stream.write(bytearray(version.encode("utf-8")))
    stream.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    qualified = fs.makeQualified(aside)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(qualified, fs.makeQualified(_path(spark, f"{root}/{POINTER}")), options)


def _key(order_by: Sequence[str]):
    return F.struct(*[F.col(c) for c in order_by])


def _placed(parts: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Each row's part, its place in it and its key; parts are numbered in their names."""
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)-", 1).cast("int")
    return parts.select(number.alias("part"), F.col("_metadata.row_index").alias("place"), _key(order_by).alias("key"))


def part_ranges(parts: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """(part, n_rows, n_unsorted, first_key, last_key) of the written parts, from one read of them."""
    inside = Window.partitionBy("part").orderBy("place")
    rows = _placed(parts, order_by)
    # keys compare as the sort does: by column, NULL first
    rows = rows.withColumn("before", F.lag("key").over(inside))
    return rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("before") > F.col("key")).alias("n_unsorted"),
        F.min("key").alias("first_key"), F.max("key").alias("last_key"))


def _numbered(ranges: DataFrame) -> DataFrame:
    """Parts numbered without gaps (empty parts have no file), one small row each."""
    return ranges.withColumn("nth", F.row_number().over(Window.orderBy("part")))


def check_order(ranges: DataFrame) -> None:
    """Raise ``BrokenOrder`` unless all parts are sorted and follow one another."""
    if ranges.where("n_unsorted > 0").head(1):
        raise BrokenOrder("a part is not sorted")
    numbered = _numbered(ranges)
    after = numbered.select((F.col("nth") - 1).alias("nth"), F.col("first_key").alias("next_key"))
    if numbered.join(after, "nth").where("last_key > next_key").head(1):
        raise BrokenOrder("a part begins before the one in front of it ends")


def publish_version(df: DataFrame, root: str, order_by: Sequence[str], part_rows: int = PART_ROWS) -> str:
    """Write ``df`` as a new version under ``root``, check it and point readers to it; its name."""
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    folder = f"{root}/{version}"
    n_parts = max(1, -(-df.count() // part_rows))
    if n_parts == 1:
        ordered = df.repartition(1).sortWithinPartitions(*order_by)
    else:
        ordered = df.repartitionByRange(n_parts, *order_by).sortWithinPartitions(*order_by)
    ordered.write.mode("error").parquet(folder)
    written = spark.read.schema(df.schema).parquet(folder)
    ranges = part_ranges(written, order_by)
    manifest = f"{folder}/{MANIFEST}"
    ranges.write.mode("error").parquet(manifest)
    check_order(spark.read.schema(ranges.schema).parquet(manifest))
    _point_to(spark, root, version)
    return version


def read_version(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The rows of a version, by default the current one."""
    version = version or current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no version is published under {root}")
    return spark.read.parquet(f"{root}/{version}")


def read_manifest(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    version = version or current_version(spark, root)
    return spark.read.parquet(f"{root}/{version}/{MANIFEST}")


def read_in_order(spark: SparkSession, root: str, position_col: str = "position", version: str | None = None) -> DataFrame:
    """A version's rows with their place in the publication order (from 1), without sorting them:
    the rows of all earlier parts, from the manifest, plus the place inside the part."""
    version = version or current_version(spark, root)
    parts = _numbered(read_manifest(spark, root, version))          # one small row a part
    earlier = Window.orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)).alias("__start"))
    rows = read_version(spark, root, version)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)-", 1).cast("int")
    placed = rows.select("*", number.alias("part"), F.col("_metadata.row_index").alias("__place"))
    # one small row a part: the rows stay where they are
    return placed.join(F.broadcast(starts), "part").withColumn(position_col, F.col("__start") + F.col("__place") + 1).drop(
        "part", "__start", "__place")
