"""Row slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.functions import dates as D
from hebdo.functions.casts import to_int_truncating
from hebdo.functions.text import normalize_label
from hebdo.operators.columns import computed_once
from hebdo.operators.filters import (drop_zero, exclude_values, keep_all, keep_equal, keep_on_or_after,
                                     keep_values)
from hebdo.plans import feeds
from hebdo.plans.catalog.registry import register
from hebdo.plans.catalog.sql import PARSED_DATES, RENDERED_DATES


# ---------------------------------------------------------------------------
# Slices (F1-F7)
# ---------------------------------------------------------------------------

@register("slice_exclusion", """
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer)
SELECT c_custkey, segment FROM c WHERE segment NOT IN ('AUTOMOBILE', 'MACHINERY')""")
def slice_exclusion(spark: SparkSession, d: str) -> DataFrame:
    c = feeds.table(spark, d, "customer")
    r = c.select("c_custkey", feeds.null_when(F.col("c_custkey") % 9 == 0, F.col("c_mktsegment")).alias("segment"))
    return exclude_values(r, "segment", ["AUTOMOBILE", "MACHINERY"])


@register("slice_inclusion", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE (o_orderstatus = 'F' OR o_orderstatus = 'P') AND o_orderpriority = '1-URGENT'""")
def slice_inclusion(spark: SparkSession, d: str) -> DataFrame:
    o = feeds.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return keep_equal(keep_values(o, "o_orderstatus", ["F", "P"]), "o_orderpriority", "1-URGENT")


@register("slice_membership", """
WITH s AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS report_date,
         lpad(CAST((year(o_orderdate) % 100) * 100 + (year(o_orderdate) + 1) % 100 AS VARCHAR), 4, '0') AS season,
         ' ' || CASE WHEN o_orderkey % 2 = 0 THEN 'Week' ELSE 'Month' END || ' ' AS time_period,
         CASE WHEN o_orderkey % 3 = 0 THEN 'Overall' ELSE 'Age' END AS strata
  FROM orders)
SELECT o_orderkey, season, report_date FROM s
WHERE lower(trim(time_period)) = 'week' AND TRY_CAST(trunc(TRY_CAST(season AS DOUBLE)) AS INTEGER) IN (9697, 9798)
  AND strata = 'Overall'""")
def slice_membership(spark: SparkSession, d: str) -> DataFrame:
    o = feeds.table(spark, d, "orders")
    y = F.year("o_orderdate")
    season = F.lpad(((y % 100) * 100 + (y + 1) % 100).cast("string"), 4, "0")
    period = F.concat(F.lit(" "), F.when(F.col("o_orderkey") % 2 == 0, "Week").otherwise("Month"), F.lit(" "))
    strata = F.when(F.col("o_orderkey") % 3 == 0, "Overall").otherwise("Age")
    s = o.select("o_orderkey", F.to_date("o_orderdate").alias("report_date"), season.alias("season"),
                 period.alias("time_period"), strata.alias("strata"))
    s = keep_all(s, normalize_label("time_period") == "week",
                 to_int_truncating("season").isin([9697, 9798]), F.col("strata") == "Overall")
    return s.select("o_orderkey", "season", "report_date")


@register("date_lower_bound", f"""
WITH {RENDERED_DATES}, {PARSED_DATES}
SELECT p.o_orderkey, p.report_date, o_orderkey % 13 AS new_hospitalization
FROM parsed p
WHERE p.report_date IS NOT NULL AND p.report_date >= DATE '1999-05-04' AND o_orderkey % 13 <> 0""")
def date_lower_bound(spark: SparkSession, d: str) -> DataFrame:
    raw = feeds.rendered_order_dates(spark, d).withColumn("new_hospitalization", F.col("o_orderkey") % 13)
    date = F.coalesce(D.parse_date_leading("raw_date"), D.parse_month_first("raw_date"))
    p = computed_once(drop_zero(raw, "new_hospitalization"), "o_orderkey", date.alias("report_date"),
                      "new_hospitalization")
    return keep_on_or_after(p, "report_date", "1999-05-04")


