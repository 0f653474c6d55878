"""Documents: GeoJSON features, nested JSON records, header records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.functions import dates as D
from hebdo.functions.text import bytes_to_text
from hebdo.plans import feeds
from hebdo.sources.readers import explode_features, flatten_structs, geojson_schema, promote_header_record
from hebdo.plans.catalog.registry import register


# ---------------------------------------------------------------------------
# Documents: GeoJSON features, nested JSON records
# ---------------------------------------------------------------------------

# Events per generated document.  Pages are ranges of event_id, the table's key,
# so every document holds at most PAGE_SIZE events whatever the value skew.
PAGE_SIZE = 200


@register("geojson_inline", f"""
SELECT 'page-' || CAST(event_id // {PAGE_SIZE} AS VARCHAR) AS name, event_id, user_id,
       CAST(ts AS DATE) AS report_date, CAST(floor(value) AS BIGINT) AS new_hospitalization
FROM events""")
def geojson_inline(spark: SparkSession, d: str) -> DataFrame:
    e = feeds.table(spark, d, "events")
    feature = F.struct(F.lit("Feature").alias("type"),
                       F.struct(D.wall_clock_epoch_ms("ts").alias("Date"),
                                F.col("event_id"), F.col("user_id"),
                                F.floor("value").cast("bigint").alias("SUM_no_new_admissions")).alias("properties"))
    page = F.concat(F.lit("page-"), F.floor(F.col("event_id") / PAGE_SIZE).cast("string"))
    docs = (e.groupBy(page.alias("name"))
             .agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"),
                                     F.collect_list(feature).alias("features"))).alias("body"))
             .select("name", F.encode("body", "UTF-8").alias("payload")))
    props = T.StructType([T.StructField(n, T.LongType())
                          for n in ("Date", "event_id", "user_id", "SUM_no_new_admissions")])
    schema = geojson_schema(props)
    parsed = docs.select("name", F.from_json(bytes_to_text("payload"), schema).alias("fc"))
    rows = explode_features(parsed, "fc", keep=["name"])
    return rows.select("name", "event_id", "user_id", D.epoch_ms_to_date("Date").alias("report_date"),
                       F.col("SUM_no_new_admissions").alias("new_hospitalization"))


@register("json_flatten", f"""
SELECT event_id, user_id AS user_user_id, event_type AS user_event_type,
       CAST(json_extract(props, '$.k') AS BIGINT) AS props_k,
       'page-' || CAST(event_id // {PAGE_SIZE} AS VARCHAR) AS page
FROM events""")
def json_flatten(spark: SparkSession, d: str) -> DataFrame:
    e = feeds.table(spark, d, "events")
    record = F.struct(F.col("event_id"), F.struct("user_id", "event_type").alias("user"),
                      F.from_json("props", "k bigint").alias("props"))
    page = F.concat(F.lit("page-"), F.floor(F.col("event_id") / PAGE_SIZE).cast("string"))
    docs = e.groupBy(page.alias("page")).agg(F.to_json(F.collect_list(record)).alias("body"))
    schema = ("array<struct<event_id: bigint, user: struct<user_id: bigint, event_type: string>, "
              "props: struct<k: bigint>>>")
    records = docs.select("page", F.inline(F.from_json("body", schema)))
    # "_" rather than R's "." so that no output name needs quoting downstream
    return flatten_structs(records, sep="_")


# ---------------------------------------------------------------------------
# Header-record promotion (S8): documents whose first record holds the names
# ---------------------------------------------------------------------------

@register("header_record_promotion", f"""
SELECT CAST(event_id AS VARCHAR) AS "event_id", event_type AS "event_type", CAST(CAST(ts AS DATE) AS VARCHAR) AS "Дата"
FROM events""")
def header_record_promotion(spark: SparkSession, d: str) -> DataFrame:
    names = ["event_id", "event_type", "Дата"]
    e = feeds.table(spark, d, "events")
    record = F.array(F.col("event_id").cast("string"), F.col("event_type"), F.to_date("ts").cast("string"))
    page = F.floor(F.col("event_id") / PAGE_SIZE)
    header = F.array(*[F.lit(n) for n in names])
    docs = (e.groupBy(page.alias("page"))
             .agg(F.to_json(F.concat(F.array(header), F.collect_list(record))).alias("body")))
    records = docs.select(F.explode(F.from_json("body", "array<array<string>>")).alias("rec"))
    return promote_header_record(records, "rec", names)


