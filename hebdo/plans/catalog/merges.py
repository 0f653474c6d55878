"""Merging sources, pages and measures; reference enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.operators.columns import project_for_join, typed_null
from hebdo.operators.combine import (distinct_rows, enrich, full_join_on_values, join_facts_to_dimension,
                                     outer_merge_measures, union_by_name)
from hebdo.operators.rollup import add_week_start
from hebdo.plans import feeds
from hebdo.plans.catalog.registry import register
from hebdo.plans.catalog.sql import ORDERS_REPORTS, ORDER_PAGES, PLACES


# ---------------------------------------------------------------------------
# Merging (J1 J2a J2b J3 U1 U2 J4 P5 P9)
# ---------------------------------------------------------------------------

def _status_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    r = feeds.orders_reports(spark, d)
    country = feeds.null_when(F.col("o_orderkey") % 17 == 0, F.col("country_name"))
    left = r.filter(F.col("o_orderstatus") != "O").select(country.alias("country_name"), "report_date",
                                                          "new_hospitalization")
    right = r.filter(F.col("o_orderstatus") == "O").select(country.alias("country_name"), "report_date", "new_icu")
    return left, right


@register("two_measure_outer_merge", f"""
WITH {ORDERS_REPORTS},
r AS (SELECT CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE country_name END AS country_name, report_date,
             o_orderstatus, new_hospitalization, new_icu FROM orders_reports),
l AS (SELECT country_name, report_date, new_hospitalization FROM r WHERE o_orderstatus <> 'O'),
rr AS (SELECT country_name, report_date, new_icu FROM r WHERE o_orderstatus = 'O')
SELECT COALESCE(l.country_name, rr.country_name) AS country_name,
       COALESCE(l.report_date, rr.report_date) AS report_date,
       CAST(COALESCE(SUM(l.new_hospitalization), 0) AS BIGINT) AS new_hospitalization,
       CAST(COALESCE(SUM(rr.new_icu), 0) AS BIGINT) AS new_icu
FROM l FULL OUTER JOIN rr
  ON l.country_name IS NOT DISTINCT FROM rr.country_name AND l.report_date IS NOT DISTINCT FROM rr.report_date
GROUP BY 1, 2""")
def two_measure_outer_merge(spark: SparkSession, d: str) -> DataFrame:
    left, right = _status_sides(spark, d)
    return outer_merge_measures(left, right, ["country_name", "report_date"], null_policy="zero")


@register("full_join_on_values", f"""
WITH {ORDER_PAGES}
SELECT COALESCE(page1.report_date, page2.report_date) AS report_date, COALESCE(page1.value, page2.value) AS value,
       CAST(count(*) AS BIGINT) AS n_rows
FROM page1 FULL OUTER JOIN page2
  ON page1.report_date IS NOT DISTINCT FROM page2.report_date AND page1.value IS NOT DISTINCT FROM page2.value
GROUP BY 1, 2""")
def full_join_on_values_query(spark: SparkSession, d: str) -> DataFrame:
    p1, p2 = feeds.order_pages(spark, d)
    keys = ["report_date", "value"]
    # o_custkey / o_orderkey are non-key columns on both pages; projecting
    # to the key first means no same-named columns meet in the join
    return full_join_on_values(project_for_join(p1, keys, []), project_for_join(p2, keys, []), keys)


@register("union_pages", f"""
WITH {ORDER_PAGES}
SELECT report_date, CAST(COALESCE(SUM(value), 0) AS BIGINT) AS new_hospitalization, CAST(count(*) AS BIGINT) AS n_rows
FROM (SELECT * FROM page1 UNION ALL SELECT * FROM page2) GROUP BY report_date""")
def union_pages(spark: SparkSession, d: str) -> DataFrame:
    p1, p2 = feeds.order_pages(spark, d)
    u = union_by_name(p1, p2)
    return u.groupBy("report_date").agg(F.coalesce(F.sum("value"), F.lit(0)).alias("new_hospitalization"),
                                        F.count(F.lit(1)).alias("n_rows"))


@register("union_sources", f"""
WITH {ORDERS_REPORTS}
SELECT country_name, report_date, new_hospitalization, new_icu FROM orders_reports WHERE o_orderstatus <> 'O'
UNION ALL
SELECT country_name, report_date, new_hospitalization, CAST(NULL AS BIGINT) FROM orders_reports WHERE o_orderstatus = 'O'
UNION ALL
SELECT 'LINE-' || l_returnflag, CAST(l_shipdate AS DATE), CAST(trunc(l_quantity) AS BIGINT), CAST(NULL AS BIGINT)
FROM lineitem""")
def union_sources(spark: SparkSession, d: str) -> DataFrame:
    r = feeds.orders_reports(spark, d)
    a = r.filter(F.col("o_orderstatus") != "O").select("country_name", "report_date", "new_hospitalization", "new_icu")
    b = r.filter(F.col("o_orderstatus") == "O").select("country_name", "report_date", "new_hospitalization")
    li = feeds.table(spark, d, "lineitem")
    c = li.select(F.concat(F.lit("LINE-"), "l_returnflag").alias("country_name"),
                  F.to_date("l_shipdate").alias("report_date"),
                  F.col("l_quantity").cast("bigint").alias("new_hospitalization"),
                  typed_null("bigint").alias("new_icu"))
    return union_by_name(a, b, c)


@register("distinct_reference", """
SELECT DISTINCT c_nationkey, c_mktsegment FROM customer""")
def distinct_reference(spark: SparkSession, d: str) -> DataFrame:
    return distinct_rows(feeds.table(spark, d, "customer").select("c_nationkey", "c_mktsegment"))


@register("enrich_reference", f"""
WITH {ORDERS_REPORTS}, {PLACES},
weekly AS (
  SELECT n.n_name AS country, CAST(date_trunc('week', r.report_date) AS DATE) AS epiweek,
         CAST(SUM(r.new_hospitalization) AS BIGINT) AS new_hospitalization
  FROM orders_reports r JOIN customer c ON r.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY ALL),
ref AS (SELECT DISTINCT ADM0_NAME AS country, WHO_REGION, ISO_3_CODE FROM places)
SELECT w.country, w.epiweek, w.new_hospitalization, ref.WHO_REGION, ref.ISO_3_CODE
FROM weekly w LEFT JOIN ref ON w.country IS NOT DISTINCT FROM ref.country""")
def enrich_reference(spark: SparkSession, d: str) -> DataFrame:
    r = add_week_start(feeds.orders_reports(spark, d), "report_date").select("o_custkey", "epiweek",
                                                                              "new_hospitalization")
    cn = join_facts_to_dimension(r, feeds.customer_nations(spark, d, "country"), "o_custkey", "c_custkey",
                                 ["o_custkey", "epiweek"], ["new_hospitalization"])
    weekly = cn.groupBy("country", "epiweek").agg(F.sum("new_hospitalization").alias("new_hospitalization"))
    p = feeds.places(spark, d)
    ref = union_by_name(p, p).select(F.col("ADM0_NAME").alias("country"), "WHO_REGION", "ISO_3_CODE")
    return enrich(weekly, ref, "country", how="left", dedupe_reference=True)


