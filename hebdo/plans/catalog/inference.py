"""Types inferred from text, over orders written the way a CSV file holds them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.operators.infer import apply_types, collect_types, decide_types, infer_types, merge_type_states, type_state
from hebdo.plans import feeds
from hebdo.plans.catalog.registry import register

TOLERANCE = 0.005


def text_orders(spark: SparkSession, d: str) -> DataFrame:
    """Every order as text: numbers of three widths, dates in four layouts, flags, gaps and a few bad values."""
    o = feeds.table(spark, d, "orders")
    k, ts = F.col("o_orderkey"), F.col("o_orderdate")
    return o.select(
        k.cast("string").alias("order_key"),
        (F.col("o_custkey") * 10_000_000_000).cast("string").alias("account"),
        feeds.null_when(k % 9 == 0, F.concat(F.floor("o_totalprice").cast("bigint").cast("string"), F.lit(".5")))
        .alias("price"),
        F.when(k % 5 == 0, "NA").otherwise(F.date_format(ts, "yyyy-MM-dd")).alias("iso_day"),
        F.date_format(ts, "MM/dd/yyyy").alias("us_day"),
        F.date_format(ts, "dd/MM/yyyy").alias("eu_day"),
        F.concat(F.date_format(ts, "yyyy-MM"), F.lit("-01")).alias("month"),
        F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit("T00:00:00.000")).alias("stamp"),
        F.when(k % 2 == 0, "T").otherwise("F").alias("closed"),
        F.when(k % 500 == 17, "n/a").otherwise((k % 13).cast("string")).alias("admissions"),
        F.when(k % 50 == 17, "n/a").otherwise((k % 13).cast("string")).alias("icu"),
        F.col("o_orderpriority").alias("priority"),
        F.lit(None).cast("string").alias("comment"))


TEXT_ORDERS = """
text_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CAST(o_custkey * 10000000000 AS VARCHAR) AS account,
         CASE WHEN o_orderkey % 9 <> 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || '.5' END AS price,
         CASE WHEN o_orderkey % 5 = 0 THEN 'NA' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso_day,
         strftime(o_orderdate, '%m/%d/%Y') AS us_day, strftime(o_orderdate, '%d/%m/%Y') AS eu_day,
         strftime(o_orderdate, '%Y-%m') || '-01' AS month, strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00.000' AS stamp,
         CASE WHEN o_orderkey % 2 = 0 THEN 'T' ELSE 'F' END AS closed,
         CASE WHEN o_orderkey % 500 = 17 THEN 'n/a' ELSE CAST(o_orderkey % 13 AS VARCHAR) END AS admissions,
         CASE WHEN o_orderkey % 50 = 17 THEN 'n/a' ELSE CAST(o_orderkey % 13 AS VARCHAR) END AS icu,
         o_orderpriority AS priority, CAST(NULL AS VARCHAR) AS comment
  FROM orders)"""

_COLUMNS = ("order_key", "account", "price", "iso_day", "us_day", "eu_day", "month", "stamp", "closed", "admissions",
            "icu", "priority", "comment")
_TESTS = (("boolean", None, "v IN ('T', 'TRUE', 'true', 'True', 'F', 'FALSE', 'false', 'False')"),
          ("int", None, r"regexp_matches(v, '^[+-]?[0-9]+$') AND TRY_CAST(v AS INTEGER) IS NOT NULL"),
          ("bigint", None, r"regexp_matches(v, '^[+-]?[0-9]+$') AND TRY_CAST(v AS BIGINT) IS NOT NULL"),
          ("double", None, r"regexp_matches(v, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$')"),
          ("date", "yyyy-M-d", r"regexp_matches(v, '^\d+-\d+-\d+$') AND try_strptime(v, '%Y-%m-%d') IS NOT NULL"),
          ("date", "yyyy/M/d", "try_strptime(v, '%Y/%m/%d') IS NOT NULL"),
          ("date", "M/d/yyyy", "try_strptime(v, '%m/%d/%Y') IS NOT NULL"),
          ("date", "d/M/yyyy", "try_strptime(v, '%d/%m/%Y') IS NOT NULL"),
          ("date", "d.M.yyyy", "try_strptime(v, '%d.%m.%Y') IS NOT NULL"),
          ("timestamp_ntz", "ISO 8601", r"regexp_matches(v, '^\d+-\d+-\d+[T ]\d+:') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL"))


def inference_sql(tolerance: float) -> str:
    values = " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS name, CASE WHEN trim({c}) NOT IN ('', 'NA') THEN trim({c}) END AS v "
        f"FROM text_orders" for i, c in enumerate(_COLUMNS))
    misses = ", ".join(f"count(v) - count(*) FILTER (WHERE {t}) AS m{i}" for i, (_, _, t) in enumerate(_TESTS))
    least = "least(" + ", ".join(f"m{i}" for i in range(len(_TESTS))) + ")"
    pick = " ".join(f"WHEN (n = 0 OR {least} <= floor(n * {tolerance})) AND m{i} = {least} THEN {i}"
                    for i in range(len(_TESTS)))
    kinds = " ".join(f"WHEN {i} THEN '{k}'" for i, (k, _, _) in enumerate(_TESTS))
    formats = " ".join(f"WHEN {i} THEN '{f}'" for i, (_, f, _) in enumerate(_TESTS) if f)
    return f"""
WITH {TEXT_ORDERS},
vals AS ({values}),
state AS (SELECT position, name, count(*) AS n_rows, count(v) AS n, {misses} FROM vals GROUP BY position, name),
c AS (SELECT *, {least} AS least_misses, CASE {pick} ELSE {len(_TESTS)} END AS chosen FROM state)
SELECT CAST(position AS INTEGER) AS position, name AS "column", CASE chosen {kinds} ELSE 'string' END AS type,
       CASE chosen {formats} END AS format, n_rows, n_rows - n AS n_missing,
       CASE WHEN chosen = {len(_TESTS)} THEN 0 ELSE least_misses END AS n_rejected,
       chosen = 6 AND m6 = m7 AS ambiguous
FROM c"""


@register("csv_type_inference", inference_sql(0.0))
def csv_type_inference(spark: SparkSession, d: str) -> DataFrame:
    return infer_types(text_orders(spark, d))


@register("csv_type_inference_tolerant", inference_sql(TOLERANCE))
def csv_type_inference_tolerant(spark: SparkSession, d: str) -> DataFrame:
    """The same from states of the priorities' rows (as of files), merged afterwards."""
    rows = text_orders(spark, d)
    states = type_state(rows.withColumn("file", F.col("priority")), by=["file"]).drop("file")
    return decide_types(merge_type_states(states), TOLERANCE)


@register("csv_typed_rows", f"""
WITH {TEXT_ORDERS}
SELECT CAST(order_key AS INTEGER) AS order_key, CAST(account AS BIGINT) AS account, CAST(price AS DOUBLE) AS price,
       CAST(try_strptime(iso_day, '%Y-%m-%d') AS DATE) AS iso_day, CAST(strptime(us_day, '%m/%d/%Y') AS DATE) AS us_day,
       CAST(strptime(eu_day, '%d/%m/%Y') AS DATE) AS eu_day, CAST(month AS DATE) AS month,
       CAST(CAST(stamp AS TIMESTAMP) AS VARCHAR) AS stamp, closed = 'T' AS closed,
       TRY_CAST(admissions AS INTEGER) AS admissions, icu, priority, CAST(NULL AS BOOLEAN) AS comment
FROM text_orders""")
def csv_typed_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = text_orders(spark, d)
    typed = apply_types(rows, collect_types(infer_types(rows, TOLERANCE)))
    return typed.withColumn("stamp", F.date_format("stamp", "yyyy-MM-dd HH:mm:ss"))
