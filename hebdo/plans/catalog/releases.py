"""End to end: the current (X14), archived (X13) and US-only (X15) weekly series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.functions.casts import to_int_truncating
from hebdo.functions.text import normalize_label
from hebdo.operators.columns import typed_null, with_constants
from hebdo.operators.combine import join_facts_to_dimension, merge_side_totals
from hebdo.operators.filters import keep_equal, keep_on_or_after
from hebdo.plans import feeds
from hebdo.plans.normalize import normalize_pages, normalize_source
from hebdo.plans.release import archived_weekly_series, current_weekly_series
from hebdo.plans.catalog.registry import register
from hebdo.plans.catalog.sql import ORDERS_REPORTS, PLACES, STATE_FEED, STATE_ROWS, WEEKLY_CODE_FEED, sql_iso_monday
from hebdo.plans.catalog.feed_specs import STATE_SPEC, WEEK_CODE_SPEC


# ---------------------------------------------------------------------------
# End-to-end: current (X14) and archived (X13) weekly series
# ---------------------------------------------------------------------------

CURRENT_SQL = f"""
WITH {ORDERS_REPORTS}, {PLACES},
nz AS (
  SELECT p.WHO_REGION, p.ISO_3_CODE, upper(p.ADM0_NAME) AS country, r.report_date,
         CAST(COALESCE(SUM(r.new_hospitalization), 0) AS BIGINT) AS new_hospitalization,
         CAST(COALESCE(SUM(r.new_icu), 0) AS BIGINT) AS new_icu,
         1 AS src_ord, CAST(NULL AS BIGINT) AS row_id
  FROM orders_reports r JOIN customer c ON r.o_custkey = c.c_custkey JOIN places p ON c.c_nationkey = p.n_nationkey
  GROUP BY p.WHO_REGION, p.ISO_3_CODE, upper(p.ADM0_NAME), r.report_date),
cdc AS (
  SELECT 'AMRO' AS WHO_REGION, 'USA' AS ISO_3_CODE, 'UNITED STATES OF AMERICA' AS country,
         CAST(ts AS DATE) AS report_date, CAST(trunc(value) AS BIGINT) AS new_hospitalization,
         CAST(NULL AS BIGINT) AS new_icu, 2 AS src_ord, event_id AS row_id
  FROM events
  WHERE lower(trim(' ' || upper(event_type) || ' ')) = 'purchase' AND CAST(ts AS DATE) >= DATE '2024-01-03'),
u AS (SELECT *, CAST(date_trunc('week', report_date) AS DATE) AS epiweek
      FROM (SELECT * FROM nz UNION ALL SELECT * FROM cdc)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY epiweek, country
                               ORDER BY new_hospitalization DESC NULLS LAST, src_ord, report_date, row_id NULLS FIRST) AS rn
  FROM u)
SELECT WHO_REGION, ISO_3_CODE, country, epiweek, new_hospitalization, new_icu,
       CAST(year(epiweek) AS INTEGER) AS iso_year, CAST(weekofyear(epiweek) AS INTEGER) AS iso_week_number
FROM ranked WHERE rn = 1"""


def current_release_sources(spark: SparkSession, d: str) -> list[DataFrame]:
    """The two feeds of the current flow: a daily national feed summed per
    date (orders by customer nation) and an event-level feed (purchases)."""
    r = feeds.orders_reports(spark, d).select("o_custkey", "report_date", "new_hospitalization", "new_icu")
    rows = join_facts_to_dimension(r, feeds.customer_places(spark, d), "o_custkey", "c_custkey",
                                   ["o_custkey", "report_date"], ["new_hospitalization", "new_icu"])
    rows = rows.withColumn("country", F.upper("ADM0_NAME"))
    nz = (rows.groupBy("WHO_REGION", "ISO_3_CODE", "country", "report_date")
              .agg(F.coalesce(F.sum("new_hospitalization"), F.lit(0)).alias("new_hospitalization"),
                   F.coalesce(F.sum("new_icu"), F.lit(0)).alias("new_icu")))
    e = feeds.table(spark, d, "events")
    label = F.concat(F.lit(" "), F.upper("event_type"), F.lit(" "))
    cdc = e.select("event_id", label.alias("time_period"), F.to_date("ts").alias("report_date"), "value")
    cdc = keep_on_or_after(keep_equal(cdc.withColumn("time_period", normalize_label("time_period")),
                                      "time_period", "purchase"), "report_date", "2024-01-03")
    cdc = with_constants(cdc.select(F.col("event_id").alias("row_id"), "report_date",
                                    to_int_truncating("value", "bigint").alias("new_hospitalization")),
                         {"WHO_REGION": "AMRO", "ISO_3_CODE": "USA", "country": "UNITED STATES OF AMERICA",
                          "new_icu": typed_null("bigint")})
    return [nz, cdc]


@register("current_release", CURRENT_SQL)
def current_release(spark: SparkSession, d: str) -> DataFrame:
    return current_weekly_series(current_release_sources(spark, d), row_id_col="row_id")


ARCHIVED_FEEDS_SQL = {
    "s1": (("ORDERS_REPORTS",), f"""
base AS (
  SELECT n.n_name AS country_name, r.report_date, r.o_orderstatus, r.new_hospitalization, r.new_icu
  FROM orders_reports r JOIN customer c ON r.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
l AS (SELECT country_name, report_date, new_hospitalization FROM base WHERE o_orderstatus <> 'O'),
rr AS (SELECT country_name, report_date, new_icu FROM base WHERE o_orderstatus = 'O'),
s1 AS (
  SELECT COALESCE(l.country_name, rr.country_name) AS country_name, COALESCE(l.report_date, rr.report_date) AS report_date,
         CAST(COALESCE(SUM(l.new_hospitalization), 0) AS BIGINT) AS new_hospitalization,
         CAST(COALESCE(SUM(rr.new_icu), 0) AS BIGINT) AS new_icu, 1 AS src_ord
  FROM l FULL OUTER JOIN rr
    ON l.country_name IS NOT DISTINCT FROM rr.country_name AND l.report_date IS NOT DISTINCT FROM rr.report_date
  GROUP BY 1, 2)"""),
    "s2": (("STATE_FEED", "STATE_ROWS"), f"""
s2 AS (
  SELECT country_name, report_date, CAST(COALESCE(SUM(new_hospitalization), 0) AS BIGINT) AS new_hospitalization,
         CAST(NULL AS BIGINT) AS new_icu, 2 AS src_ord
  FROM state_rows WHERE new_hospitalization <> 0 GROUP BY 1, 2)"""),
    "s3": (("WEEKLY_CODE_FEED",), f"""
s3rows AS (
  SELECT CASE geoRegion WHEN 'CH' THEN 'Switzerland' ELSE geoRegion END AS country_name,
         {sql_iso_monday('TRY_CAST(substr(date, 1, 4) AS INTEGER)', 'TRY_CAST(substr(date, 5, 2) AS INTEGER)')} AS report_date,
         TRY_CAST(trunc(TRY_CAST(entries AS DOUBLE)) AS BIGINT) AS new_hospitalization
  FROM weekly_code_feed
  WHERE geoRegion = 'CH' AND altersklasse_covid19 = 'all' AND primary_hosp_reason = 'covid'
    AND TRY_CAST(substr(date, 5, 2) AS INTEGER) <> 53),
s3 AS (
  SELECT country_name, report_date, CAST(COALESCE(SUM(new_hospitalization), 0) AS BIGINT) AS new_hospitalization,
         CAST(NULL AS BIGINT) AS new_icu, 3 AS src_ord
  FROM s3rows GROUP BY 1, 2)"""),
}

ARCHIVED_FINISH_SQL = """
daily AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY report_date, country_name
                                 ORDER BY new_hospitalization DESC NULLS LAST, src_ord) AS rn FROM merged)
  WHERE rn = 1),
weekly AS (
  SELECT country_name, CAST(date_trunc('week', report_date) AS DATE) AS epiweek,
         CAST(SUM(new_hospitalization) AS BIGINT) AS new_hospitalization, CAST(SUM(new_icu) AS BIGINT) AS new_icu,
         CAST(count(*) AS BIGINT) AS freq_time
  FROM daily GROUP BY 1, 2),
named AS (
  SELECT CASE country_name
           WHEN 'United States of America' THEN 'UNITED STATES OF AMERICA' WHEN 'Norway' THEN 'NORWAY'
           WHEN 'United Kingdom' THEN 'THE UNITED KINGDOM' WHEN 'Switzerland' THEN 'SWITZERLAND'
           WHEN 'Bulgaria' THEN 'BULGARIA' WHEN 'Ireland' THEN 'IRELAND' WHEN 'New Zealand' THEN 'NEW ZEALAND'
           WHEN 'Denmark' THEN 'DENMARK' WHEN 'Canada' THEN 'CANADA' WHEN 'Puerto Rico' THEN 'PUERTO RICO'
           WHEN 'United States Virgin Islands' THEN 'UNITED STATES VIRGIN ISLANDS' ELSE country_name END AS country,
         CAST(year(epiweek) AS INTEGER) AS iso_year,
         CAST((dayofyear(epiweek) - 1) // 7 + 1 AS INTEGER) AS iso_week_number,
         epiweek, CASE WHEN freq_time = 1 THEN 'weekly' ELSE 'daily' END AS freq, freq_time,
         new_hospitalization, new_icu
  FROM weekly),
ref AS (SELECT DISTINCT ADM0_NAME AS country, n_nationkey, WHO_REGION, ISO_3_CODE FROM places),
joined AS (SELECT named.*, ref.n_nationkey, ref.WHO_REGION, ref.ISO_3_CODE
           FROM named LEFT JOIN ref ON named.country IS NOT DISTINCT FROM ref.country)
SELECT * FROM joined WHERE epiweek < (SELECT max(epiweek) FROM joined)"""


def archived_sql(feeds_sql: tuple[str, ...] = ("s1", "s2", "s3")) -> str:
    """Oracle of the archived flow over the given feeds (only their CTEs)."""
    shared = {"ORDERS_REPORTS": ORDERS_REPORTS, "STATE_FEED": STATE_FEED, "STATE_ROWS": STATE_ROWS,
              "WEEKLY_CODE_FEED": WEEKLY_CODE_FEED}
    needed = []
    for f in feeds_sql:
        for part in ARCHIVED_FEEDS_SQL[f][0]:
            if part not in needed:
                needed.append(part)
    ctes = [PLACES] + [shared[n] for n in needed] + [ARCHIVED_FEEDS_SQL[f][1] for f in feeds_sql]
    merged = " UNION ALL ".join(f"SELECT * FROM {f}" for f in feeds_sql)
    return "WITH " + ",".join(ctes) + f",\nmerged AS ({merged}),\n" + ARCHIVED_FINISH_SQL.lstrip()


def archived_release_sources(spark: SparkSession, d: str) -> list[DataFrame]:
    """Three feeds: admissions and ICU from two tables merged per date (J1),
    a state feed delivered in two pages (J2b), a weekly feed keyed by ISO
    week codes (D6)."""
    r = feeds.orders_reports(spark, d)
    # One pass over orders: each row carries the admissions side (status F/P)
    # and the ICU side (status O) as conditional measures and 0/1 row counts;
    # they are summed per (customer, date) only if the customer join must
    # shuffle.  merge_side_totals weighs by the counts, so the result equals
    # the full join of the raw rows on (country, date).
    admissions = F.col("o_orderstatus") != "O"
    sides = r.select("o_custkey", "report_date",
                     F.when(admissions, F.col("new_hospitalization")).alias("new_hospitalization"),
                     admissions.cast("bigint").alias("n_admissions"),
                     F.when(~admissions, F.col("new_icu")).alias("new_icu"),
                     (~admissions).cast("bigint").alias("n_icu"))
    base = join_facts_to_dimension(sides, feeds.customer_nations(spark, d), "o_custkey", "c_custkey",
                                   ["o_custkey", "report_date"],
                                   ["new_hospitalization", "n_admissions", "new_icu", "n_icu"])
    s1 = merge_side_totals(base, ["country_name", "report_date"], ["new_hospitalization"], ["new_icu"],
                           "n_admissions", "n_icu", null_policy="zero")
    s2 = normalize_pages([feeds.state_feed(spark, d)], STATE_SPEC, mode="union")
    s3 = normalize_source(feeds.weekly_code_feed(spark, d), WEEK_CODE_SPEC)
    return [s1, s2, s3]


@register("archived_release", archived_sql())
def archived_release(spark: SparkSession, d: str) -> DataFrame:
    return archived_weekly_series(archived_release_sources(spark, d), reference=feeds.places(spark, d),
                                  reference_key="ADM0_NAME", freq_mode="reports", latest_week="global")


@register("us_only_release", archived_sql(("s2",)))
def us_only_release(spark: SparkSession, d: str) -> DataFrame:
    """The archived finalisation over the paged state feed alone."""
    s2 = normalize_pages([feeds.state_feed(spark, d)], STATE_SPEC, mode="union")
    return archived_weekly_series([s2], reference=feeds.places(spark, d), reference_key="ADM0_NAME")


