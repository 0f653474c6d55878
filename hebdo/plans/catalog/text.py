"""Text clean-up, recoding and safe casts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.functions.casts import to_double, to_int_truncating
from hebdo.functions.text import normalize_label, recode
from hebdo.plans import feeds
from hebdo.plans.catalog.registry import register


# ---------------------------------------------------------------------------
# Text and casts
# ---------------------------------------------------------------------------

@register("text_cleanup", """
WITH raw AS (
  SELECT c_custkey,
         ' ' || chr(9) || CASE c_custkey % 3 WHEN 0 THEN upper(c_mktsegment) WHEN 1 THEN lower(c_mktsegment)
                                              ELSE c_mktsegment END || ' ' || chr(10) AS raw_label
  FROM customer)
SELECT c_custkey, raw_label, lower(trim(raw_label, ' ' || chr(9) || chr(10) || chr(13))) AS label,
       lower(trim(raw_label, ' ' || chr(9) || chr(10) || chr(13))) = 'building' AS is_building
FROM raw""")
def text_cleanup(spark: SparkSession, d: str) -> DataFrame:
    c = feeds.table(spark, d, "customer")
    seg = F.col("c_mktsegment")
    cased = (F.when(F.col("c_custkey") % 3 == 0, F.upper(seg))
             .when(F.col("c_custkey") % 3 == 1, F.lower(seg)).otherwise(seg))
    raw = c.select("c_custkey", F.concat(F.lit(" \t"), cased, F.lit(" \n")).alias("raw_label"))
    label = normalize_label("raw_label")
    return raw.select("c_custkey", "raw_label", label.alias("label"), (label == "building").alias("is_building"))


@register("safe_casts", """
WITH raw AS (
  SELECT o_orderkey,
         CASE o_orderkey % 5
           WHEN 0 THEN CAST(o_orderkey % 1000 AS VARCHAR) || '.' || CAST(o_custkey % 10 AS VARCHAR)
           WHEN 1 THEN ' ' || CAST(o_orderkey % 100 AS VARCHAR) || ' '
           WHEN 2 THEN 'abc'
           WHEN 3 THEN '1e20'
           ELSE '-' || CAST(o_orderkey % 50 AS VARCHAR) || '.7' END AS raw_value
  FROM orders)
SELECT o_orderkey, raw_value, TRY_CAST(raw_value AS DOUBLE) AS as_double,
       TRY_CAST(trunc(TRY_CAST(raw_value AS DOUBLE)) AS INTEGER) AS as_int
FROM raw""")
def safe_casts(spark: SparkSession, d: str) -> DataFrame:
    o = feeds.table(spark, d, "orders")
    k = F.col("o_orderkey")
    raw = (F.when(k % 5 == 0, F.concat((k % 1000).cast("string"), F.lit("."), (F.col("o_custkey") % 10).cast("string")))
           .when(k % 5 == 1, F.concat(F.lit(" "), (k % 100).cast("string"), F.lit(" ")))
           .when(k % 5 == 2, F.lit("abc"))
           .when(k % 5 == 3, F.lit("1e20"))
           .otherwise(F.concat(F.lit("-"), (k % 50).cast("string"), F.lit(".7"))))
    r = o.select("o_orderkey", raw.alias("raw_value"))
    return r.select("o_orderkey", "raw_value", to_double("raw_value").alias("as_double"),
                    to_int_truncating("raw_value").alias("as_int"))


@register("recode_passthrough", """
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer)
SELECT c_custkey, segment,
       CASE segment WHEN 'AUTOMOBILE' THEN 'AUTO' WHEN 'MACHINERY' THEN 'MACH' ELSE segment END AS segment_code
FROM c""")
def recode_passthrough(spark: SparkSession, d: str) -> DataFrame:
    c = feeds.table(spark, d, "customer")
    seg = feeds.null_when(F.col("c_custkey") % 11 == 0, F.col("c_mktsegment"))
    r = c.select("c_custkey", seg.alias("segment"))
    return r.withColumn("segment_code", recode("segment", {"AUTOMOBILE": "AUTO", "MACHINERY": "MACH"}))


