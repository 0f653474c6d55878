"""Weekly rollups, top-1, group size, latest week, stock measures, window rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.operators.columns import select_renamed, with_constants
from hebdo.operators.dedupe import top1_per_group
from hebdo.operators.filters import drop_latest_week
from hebdo.operators.nulls import fill_missing
from hebdo.operators.rollup import frequency_label, rows_per_group, weekly_rollup
from hebdo.plans import feeds
from hebdo.streaming.weekly_stream import weekly_window_aggregate
from hebdo.plans.catalog.registry import register
from hebdo.plans.catalog.sql import ORDERS_REPORTS


# ---------------------------------------------------------------------------
# Weekly rollups
# ---------------------------------------------------------------------------

@register("weekly_sum_zero_fill", f"""
WITH {ORDERS_REPORTS}
SELECT 'orders' AS source, country_name, CAST(date_trunc('week', report_date) AS DATE) AS epiweek,
       CAST(COALESCE(SUM(COALESCE(new_hospitalization, 0)), 0) AS BIGINT) AS new_hospitalization,
       CAST(COALESCE(SUM(new_icu), 0) AS BIGINT) AS new_icu
FROM orders_reports GROUP BY ALL""")
def weekly_sum_zero_fill(spark: SparkSession, d: str) -> DataFrame:
    r = select_renamed(feeds.orders_reports(spark, d),
                       {"country_name": "country_name", "report_date": "report_date",
                        "new_hospitalization": "new_hospitalization", "new_icu": "new_icu"})
    r = with_constants(fill_missing(r, 0, subset=["new_hospitalization"]), {"source": "orders"})
    return weekly_rollup(r, ["source", "country_name"], "report_date",
                         ["new_hospitalization", "new_icu"], null_policy="zero")


@register("weekly_sum_null_preserving", f"""
WITH {ORDERS_REPORTS}
SELECT country_name, CAST(date_trunc('week', report_date) AS DATE) AS epiweek,
       CAST(SUM(new_hospitalization) AS BIGINT) AS new_hospitalization,
       CAST(SUM(new_icu) AS BIGINT) AS new_icu,
       CAST(count(*) AS BIGINT) AS reports,
       CASE WHEN count(*) = 1 THEN 'weekly' ELSE 'daily' END AS freq
FROM orders_reports GROUP BY ALL""")
def weekly_sum_null_preserving(spark: SparkSession, d: str) -> DataFrame:
    w = weekly_rollup(feeds.orders_reports(spark, d), ["country_name"], "report_date",
                      ["new_hospitalization", "new_icu"], null_policy="keep", reports_col="reports")
    return w.withColumn("freq", frequency_label("reports"))


# ---------------------------------------------------------------------------
# Top-1, group size, latest week
# ---------------------------------------------------------------------------

@register("top1_per_group", """
WITH o AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS report_date,
                  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 10 END AS value FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY value DESC NULLS LAST, o_orderkey) AS rn FROM o)
SELECT o_custkey, o_orderkey, report_date, value FROM r WHERE rn = 1""")
def top1_per_group_query(spark: SparkSession, d: str) -> DataFrame:
    o = feeds.table(spark, d, "orders")
    k = F.col("o_orderkey")
    rows = o.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("report_date"),
                    feeds.null_when(k % 7 == 0, k % 10).alias("value"))
    return top1_per_group(rows, ["o_custkey"], "value", tie_break=["o_orderkey"])


EVENTS_WEEKLY = """
events_weekly AS (
  SELECT event_type, CAST(date_trunc('week', CAST(ts AS DATE)) AS DATE) AS epiweek,
         CAST(SUM(CAST(floor(value) AS BIGINT)) AS BIGINT) AS new_hospitalization,
         CAST(count(*) AS BIGINT) AS reports
  FROM events GROUP BY ALL)"""


def _events_weekly(spark: SparkSession, d: str) -> DataFrame:
    e = feeds.table(spark, d, "events").select(
        "event_type", F.to_date("ts").alias("report_date"),
        F.floor("value").cast("bigint").alias("new_hospitalization"))
    return weekly_rollup(e, ["event_type"], "report_date", ["new_hospitalization"], reports_col="reports")


@register("group_size_label", f"""
WITH {EVENTS_WEEKLY}
SELECT event_type, epiweek, new_hospitalization, freq_time,
       CASE WHEN freq_time = 1 THEN 'weekly' WHEN freq_time > 1 THEN 'daily' END AS freq
FROM (SELECT *, count(*) OVER (PARTITION BY event_type, epiweek) AS freq_time FROM events_weekly)""")
def group_size_label(spark: SparkSession, d: str) -> DataFrame:
    w = _events_weekly(spark, d).drop("reports")
    w = rows_per_group(w, ["event_type", "epiweek"], "freq_time")
    return w.withColumn("freq", frequency_label("freq_time"))


@register("drop_latest_week", f"""
WITH {EVENTS_WEEKLY}
SELECT event_type, epiweek, new_hospitalization, reports FROM events_weekly
WHERE epiweek < (SELECT max(epiweek) FROM events_weekly)""")
def drop_latest_week_query(spark: SparkSession, d: str) -> DataFrame:
    return drop_latest_week(_events_weekly(spark, d), "epiweek", materialize_input=True)


# ---------------------------------------------------------------------------
# The streaming job's weekly window aggregate, run in batch (D1 + A2 + A4b)
# ---------------------------------------------------------------------------

@register("weekly_window_rollup", f"""
SELECT CAST(date_trunc('week', ts) AS DATE) AS epiweek, event_type,
       CAST(SUM(CAST(floor(value) AS BIGINT)) AS BIGINT) AS new_hospitalization, CAST(count(*) AS BIGINT) AS reports
FROM events GROUP BY ALL""")
def weekly_window_rollup(spark: SparkSession, d: str) -> DataFrame:
    e = feeds.table(spark, d, "events").select("ts", "event_type",
                                               F.floor("value").cast("bigint").alias("new_hospitalization"))
    return weekly_window_aggregate(e, "ts", ["event_type"], ["new_hospitalization"])


# ---------------------------------------------------------------------------
# Stock measures (B10): weekly peak and last reported value
# ---------------------------------------------------------------------------

@register("weekly_stock_measures", """
WITH r AS (
  SELECT event_type, CAST(ts AS DATE) AS report_date,
         CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS occupied
  FROM events),
ranked AS (
  SELECT event_type, CAST(date_trunc('week', report_date) AS DATE) AS epiweek, occupied,
         row_number() OVER (PARTITION BY event_type, CAST(date_trunc('week', report_date) AS DATE)
                            ORDER BY occupied IS NOT NULL DESC, report_date DESC, occupied DESC) AS rn
  FROM r)
SELECT event_type, epiweek, max(occupied) AS peak_occupied,
       max(CASE WHEN rn = 1 THEN occupied END) AS last_occupied
FROM ranked GROUP BY ALL""")
def weekly_stock_measures(spark: SparkSession, d: str) -> DataFrame:
    e = feeds.table(spark, d, "events").select(
        "event_type", F.to_date("ts").alias("report_date"),
        feeds.null_when(F.col("event_id") % 9 == 0, F.floor("value").cast("bigint")).alias("occupied"))
    e = e.withColumn("peak_occupied", F.col("occupied")).withColumnRenamed("occupied", "last_occupied")
    return weekly_rollup(e, ["event_type"], "report_date", {"peak_occupied": "max", "last_occupied": "last"})


@register("drop_latest_week_per_group", f"""
WITH {ORDERS_REPORTS},
weekly AS (
  SELECT o_orderstatus, country_name, CAST(date_trunc('week', report_date) AS DATE) AS epiweek,
         CAST(SUM(new_hospitalization) AS BIGINT) AS new_hospitalization
  FROM orders_reports GROUP BY ALL)
SELECT o_orderstatus, country_name, epiweek, new_hospitalization FROM (
  SELECT *, max(epiweek) OVER (PARTITION BY o_orderstatus, country_name) AS latest FROM weekly)
WHERE epiweek < latest""")
def drop_latest_week_per_group(spark: SparkSession, d: str) -> DataFrame:
    """F9 per group: each (status, priority) series loses its own last week."""
    weekly = weekly_rollup(feeds.orders_reports(spark, d), ["o_orderstatus", "country_name"], "report_date",
                           ["new_hospitalization"])
    return drop_latest_week(weekly, "epiweek", per=["o_orderstatus", "country_name"], materialize_input=True)


