"""Feeds through specs: measures from parts, plausible windows, sentinel rows, table pairs."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.operators.columns import clean_column_names
from hebdo.plans import feeds
from hebdo.plans.normalize import normalize_measure_pair, normalize_paged, normalize_source, quarantined_rows
from hebdo.plans.specs import DateSpec, MeasureSpec, SourceSpec
from hebdo.plans.catalog.registry import register
from hebdo.plans.catalog.sql import STATE_FEED, STATE_ROWS, state_rows_sql
from hebdo.plans.catalog.feed_specs import STATE_SPEC


# ---------------------------------------------------------------------------
# Measures from parts (P6 P7 N1 N2 F2 F7 via a feed spec), names
# ---------------------------------------------------------------------------

@register("adult_plus_child", f"""
WITH {STATE_FEED}, {STATE_ROWS}
SELECT country_name, report_date, CAST(COALESCE(SUM(new_hospitalization), 0) AS BIGINT) AS new_hospitalization
FROM state_rows WHERE new_hospitalization <> 0 GROUP BY ALL""")
def adult_plus_child(spark: SparkSession, d: str) -> DataFrame:
    return normalize_source(feeds.state_feed(spark, d), STATE_SPEC)


def _chained_pages_sql(n: int) -> str:
    """Full joins of the state pages p1..pn on (country, date, value), one after the other."""
    keys = ("country_name", "report_date", "new_hospitalization")
    parts = [state_rows_sql(f"p{i}", f"l_linenumber % {n} = {i - 1}") for i in range(1, n + 1)]
    chain = ["j1 AS (SELECT * FROM p1 WHERE new_hospitalization <> 0)"]
    for i in range(2, n + 1):
        both = ", ".join(f"COALESCE(a.{k}, b.{k}) AS {k}" for k in keys)
        on = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
        chain.append(f"j{i} AS (SELECT {both} FROM j{i - 1} a FULL OUTER JOIN "
                     f"(SELECT * FROM p{i} WHERE new_hospitalization <> 0) b ON {on})")
    return ",".join(parts) + ",\n" + ",\n".join(chain)


STATE_PAGES = 4


@register("state_pages_full_join", f"""
WITH {STATE_FEED}, {_chained_pages_sql(STATE_PAGES)}
SELECT country_name, report_date, CAST(COALESCE(SUM(new_hospitalization), 0) AS BIGINT) AS new_hospitalization
FROM j{STATE_PAGES} GROUP BY ALL""")
def state_pages_full_join(spark: SparkSession, d: str) -> DataFrame:
    # all pages come from one scan; the line number tells the page
    state = feeds.state_feed(spark, d).withColumn("page", F.col("l_linenumber") % STATE_PAGES)
    return normalize_paged(state, STATE_SPEC, "page")


@register("clean_names", """
SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_totalprice AS total_price_percent,
       o_orderpriority AS order_priority, o_orderstatus AS number_status,
       o_orderdate AS admissions_for_covid_19_in_the_week_ending, o_orderkey AS order_key_2
FROM orders""")
def clean_names_query(spark: SparkSession, d: str) -> DataFrame:
    o = feeds.table(spark, d, "orders")
    awkward = o.select(F.col("o_orderkey").alias("Order Key"), F.col("o_custkey").alias("custKey"),
                       F.col("o_totalprice").alias("Total Price (%)"), F.col("o_orderpriority").alias("Order-Priority"),
                       F.col("o_orderstatus").alias("# Status"),
                       F.col("o_orderdate").alias("Admissions for COVID-19 in the week ending"),
                       F.col("o_orderkey").alias("Order.Key"))
    return clean_column_names(awkward)


# ---------------------------------------------------------------------------
# A feed with a plausible date window (Q1 inside normalize_source)
# ---------------------------------------------------------------------------

STATE_SPEC_WINDOWED = dataclasses.replace(STATE_SPEC, name="state_windowed",
                                          plausible=("1995-03-01", "2001-06-30"))

STATE_WINDOW_ROWS = f"""
{STATE_FEED},
{state_rows_sql("all_rows", "TRUE", "date AS raw_date,")}"""


@register("feed_plausible_window", f"""
WITH {STATE_WINDOW_ROWS}
SELECT country_name, report_date, CAST(COALESCE(SUM(new_hospitalization), 0) AS BIGINT) AS new_hospitalization
FROM all_rows
WHERE report_date BETWEEN DATE '1995-03-01' AND DATE '2001-06-30' AND new_hospitalization <> 0
GROUP BY ALL""")
def feed_plausible_window(spark: SparkSession, d: str) -> DataFrame:
    return normalize_source(feeds.state_feed(spark, d), STATE_SPEC_WINDOWED)


@register("feed_quarantine", f"""
WITH {STATE_WINDOW_ROWS}
SELECT country_name, report_date, new_hospitalization, raw_date,
       CASE WHEN report_date IS NULL AND raw_date IS NOT NULL THEN 'unparsed'
            WHEN report_date IS NULL THEN 'missing'
            WHEN report_date < DATE '1995-03-01' THEN 'before_min'
            WHEN report_date > DATE '2001-06-30' THEN 'after_max' END AS date_issue,
       'state_windowed' AS feed
FROM all_rows
WHERE report_date IS NULL OR report_date NOT BETWEEN DATE '1995-03-01' AND DATE '2001-06-30'""")
def feed_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return quarantined_rows(feeds.state_feed(spark, d), STATE_SPEC_WINDOWED)


# ---------------------------------------------------------------------------
# A sentinel-style feed through a spec: labels, integer membership, month-first
# dates, a lower bound, row-level output (no daily sum), typed missing measure
# ---------------------------------------------------------------------------

SENTINEL_SPEC = SourceSpec(
    name="sentinel", date=DateSpec("time", "formats", ("M/d/yyyy",)),
    measures=(MeasureSpec("new_hospitalization", ("estimate",)),),
    country="UNITED STATES OF AMERICA", labels=("time_period",),
    equals=(("time_period", "week"), ("strata", "Overall")), include=(("season", (2324, 2425)),),
    min_date="2024-01-05", aggregate_daily=False, missing_measures=("new_icu",),
    constants=(("WHO_REGION", "AMRO"), ("ISO_3_CODE", "USA")))


def sentinel_feed(spark: SparkSession, d: str) -> DataFrame:
    e = feeds.table(spark, d, "events")
    k = F.col("event_id")
    return e.select(
        F.when(k % 4 == 0, "2223").otherwise("2324").alias("season"),
        F.concat(F.lit(" "), F.when(k % 3 == 0, "Month").otherwise("Week"), F.lit(" ")).alias("time_period"),
        F.when(k % 10 == 0, "n/a").otherwise(F.floor(F.col("value") * 10).cast("string")).alias("estimate"),
        F.when(F.col("user_id") % 5 == 0, "Age").otherwise("Overall").alias("strata"),
        F.date_format("ts", "MM/dd/yyyy").alias("time"))


@register("sentinel_feed_rows", """
WITH s AS (
  SELECT CASE WHEN event_id % 4 = 0 THEN '2223' ELSE '2324' END AS season,
         ' ' || CASE WHEN event_id % 3 = 0 THEN 'Month' ELSE 'Week' END || ' ' AS time_period,
         CASE WHEN event_id % 10 = 0 THEN 'n/a' ELSE CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR) END AS estimate,
         CASE WHEN user_id % 5 = 0 THEN 'Age' ELSE 'Overall' END AS strata,
         strftime(ts, '%m/%d/%Y') AS time
  FROM events),
t AS (
  SELECT 'UNITED STATES OF AMERICA' AS country_name, CAST(try_strptime(trim(time), '%m/%d/%Y') AS DATE) AS report_date,
         TRY_CAST(trunc(TRY_CAST(estimate AS DOUBLE)) AS BIGINT) AS new_hospitalization
  FROM s
  WHERE lower(trim(time_period)) = 'week' AND strata = 'Overall'
    AND TRY_CAST(trunc(TRY_CAST(season AS DOUBLE)) AS INTEGER) IN (2324, 2425))
SELECT country_name, report_date, new_hospitalization, CAST(NULL AS BIGINT) AS new_icu,
       'AMRO' AS WHO_REGION, 'USA' AS ISO_3_CODE
FROM t WHERE report_date >= DATE '2024-01-05'""")
def sentinel_feed_rows(spark: SparkSession, d: str) -> DataFrame:
    return normalize_source(sentinel_feed(spark, d), SENTINEL_SPEC)


# ---------------------------------------------------------------------------
# A feed published as two tables (admissions / ICU) through two specs
# ---------------------------------------------------------------------------

PAIR_ADMISSIONS = SourceSpec(
    name="pair_admissions", date=DateSpec("date", "leading"),
    measures=(MeasureSpec("new_hospitalization", ("admissions",)),), country_column="area")
PAIR_ICU = SourceSpec(
    name="pair_icu", date=DateSpec("date", "formats", ("d/M/yyyy",)),
    measures=(MeasureSpec("new_icu", ("icu",)),), country_column="area")


def pair_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = feeds.table(spark, d, "orders")
    k = F.col("o_orderkey")
    admissions = o.filter(F.col("o_orderstatus") != "O").select(
        F.col("o_orderpriority").alias("area"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        feeds.null_when(k % 7 == 0, (k % 13).cast("string")).alias("admissions"))
    icu = o.filter(F.col("o_orderstatus") == "O").select(
        F.col("o_orderpriority").alias("area"), F.date_format("o_orderdate", "d/M/yyyy").alias("date"),
        feeds.null_when(F.dayofmonth("o_orderdate") <= 7, (F.col("o_custkey") % 4).cast("string")).alias("icu"))
    return admissions, icu


@register("measure_pair_feed", """
WITH l AS (
  SELECT o_orderpriority AS country_name, CAST(o_orderdate AS DATE) AS report_date,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 13 END AS new_hospitalization
  FROM orders WHERE o_orderstatus <> 'O'),
r AS (
  SELECT o_orderpriority AS country_name, CAST(o_orderdate AS DATE) AS report_date,
         CASE WHEN day(o_orderdate) <= 7 THEN NULL ELSE o_custkey % 4 END AS new_icu
  FROM orders WHERE o_orderstatus = 'O')
SELECT COALESCE(l.country_name, r.country_name) AS country_name,
       COALESCE(l.report_date, r.report_date) AS report_date,
       CAST(COALESCE(SUM(l.new_hospitalization), 0) AS BIGINT) AS new_hospitalization,
       CAST(COALESCE(SUM(r.new_icu), 0) AS BIGINT) AS new_icu
FROM l FULL OUTER JOIN r
  ON l.country_name IS NOT DISTINCT FROM r.country_name AND l.report_date IS NOT DISTINCT FROM r.report_date
GROUP BY 1, 2""")
def measure_pair_feed(spark: SparkSession, d: str) -> DataFrame:
    admissions, icu = pair_tables(spark, d)
    return normalize_measure_pair(admissions, PAIR_ADMISSIONS, icu, PAIR_ICU)
