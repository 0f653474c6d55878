"""How rows arrive: pages of an API (S3) and a stream that is merged into the weekly series (2.11b)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.plans import feeds
from hebdo.plans.catalog.registry import register
from hebdo.plans.catalog.rollups import EVENTS_WEEKLY
from hebdo.session import materialize, remove_folder, scratch_folder
from hebdo.sources.paged import FORMAT, PagedJson
from hebdo.sources.versions import publish_version, read_in_order, read_manifest
from hebdo.streaming.merge_stream import WeeklyMerge, merged_series, start_weekly_merge

PAGE_LIMIT = 2_000
PART_PAGES = 250                # pages of rows that one task sorts
ARRIVALS = 3


def land_pages(rows: DataFrame, order_by: list[str], path: str, limit: int) -> None:
    """Rows as the pages that an API with ``limit`` and ``offset`` answers, one folder a page."""
    spark, root = rows.sparkSession, scratch_folder(rows.sparkSession, "page-order")
    publish_version(rows, root, order_by, part_rows=PART_PAGES * limit)
    placed = read_in_order(spark, root)
    n = read_manifest(spark, root).agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    paged = placed.withColumn("offset", F.floor((F.col("position") - 1) / limit) * limit).drop("position")
    paged.repartition("offset").write.mode("error").partitionBy("offset").json(path)
    if n % limit == 0:                                      # the page that shows the end
        spark.createDataFrame([], "end int").coalesce(1).write.mode("error").json(f"{path}/offset={n}")
    remove_folder(spark, root)


@register("paged_api_scan", """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
       CAST(floor(value) AS BIGINT) AS admissions
FROM events""")
def paged_api_scan(spark: SparkSession, d: str) -> DataFrame:
    e = feeds.table(spark, d, "events").select(
        "event_id", "event_type", F.to_date("ts").cast("string").alias("date"),
        F.floor("value").cast("bigint").alias("admissions"))
    path = scratch_folder(spark, "pages")
    land_pages(e, ["event_id"], path, PAGE_LIMIT)
    spark.dataSource.register(PagedJson)
    schema = "event_id string, event_type string, date string, admissions bigint"
    out = materialize(spark.read.format(FORMAT).schema(schema).option("limit", PAGE_LIMIT).load(path))
    remove_folder(spark, path)
    return out


@register("streamed_weekly_merge", f"""
WITH {EVENTS_WEEKLY}
SELECT event_type, epiweek, new_hospitalization, reports FROM events_weekly""")
def streamed_weekly_merge(spark: SparkSession, d: str) -> DataFrame:
    """Events landed in a few files, streamed one file a batch and merged; no week closes meanwhile."""
    e = feeds.table(spark, d, "events").select(
        "event_id", "event_type", F.to_date("ts").alias("report_date"),
        F.floor("value").cast("bigint").alias("new_hospitalization"))
    root = scratch_folder(spark, "streamed-series")
    landed = f"{root}/landed"
    e.repartition(ARRIVALS).write.parquet(landed)
    target = WeeklyMerge(f"{root}/target", ("event_type",), ("new_hospitalization",), allowed_weeks=5_200)
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    start_weekly_merge(stream, target, f"{root}/checkpoint").awaitTermination()
    out = materialize(merged_series(spark, target))
    remove_folder(spark, root)
    return out
