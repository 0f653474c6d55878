"""The national feed specs themselves, on frames shaped from the driver's tables.

Order and ship dates are moved by a fixed number of days, so that they cross
the first plausible report date of the specs.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.functions.dates import day_count_week
from hebdo.operators.combine import union_by_name
from hebdo.plans import feeds
from hebdo.plans import national_feeds as NF
from hebdo.plans.catalog.registry import register
from hebdo.plans.catalog.sql import PLACES, STATE_FEED
from hebdo.plans.normalize import normalize_measure_pair, normalize_paged, normalize_source, to_report_rows
from hebdo.plans.release import OUTPUT_LEGACY_REGION, OUTPUT_LEGACY_SHORT, archived_weekly_series
from hebdo.sources.readers import promote_header_record

SHIFT_DAYS = 9500
LAST_DATE = "2024-01-31"

SHIFTED = f"""
shifted AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, CAST(o_orderdate AS DATE) + {SHIFT_DAYS} AS day
            FROM orders)"""


def shifted(spark: SparkSession, d: str) -> DataFrame:
    o = feeds.table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("s"),
                    F.date_add(F.to_date("o_orderdate"), SHIFT_DAYS).alias("day"))


def _admissions():
    return feeds.null_when(F.col("k") % 7 == 0, (F.col("k") % 13).cast("string"))


def _icu():
    return F.when(F.col("c") % 5 == 0, "n/a").otherwise((F.col("c") % 4).cast("string"))


ADMISSIONS_SQL = "CASE WHEN k % 7 = 0 THEN NULL ELSE k % 13 END"
ICU_SQL = "CASE WHEN c % 5 = 0 THEN NULL ELSE c % 4 END"


def _sum(expr: str, name: str) -> str:
    return f"CAST(COALESCE(SUM({expr}), 0) AS BIGINT) AS {name}"


# --- X1 / X1b: a slice, leading dates, two measures ---------------------------

def _nz(spark: SparkSession, d: str) -> DataFrame:
    label = F.when(F.col("k") % 3 == 0, "Age").otherwise("Sex")
    return shifted(spark, d).select(label.alias("variable_label"), F.date_format("day", "yyyy-MM-dd").alias(NF.NZ_DATE),
                                    _admissions().alias("hospitalisations"), _icu().alias("icu"))


def _nz_sql(country: str, more: str = "") -> str:
    return f"""
WITH {SHIFTED}
SELECT '{country}' AS country_name, day AS report_date, {_sum(ADMISSIONS_SQL, "new_hospitalization")},
       {_sum(ICU_SQL, "new_icu")}{more}
FROM shifted WHERE k % 3 <> 0 AND day >= DATE '2019-12-01' GROUP BY day"""


@register("nz_current_feed", _nz_sql("NEW ZEALAND", ", 'WPRO' AS WHO_REGION, 'NZL' AS ISO_3_CODE"))
def nz_current_feed(spark: SparkSession, d: str) -> DataFrame:
    return normalize_source(_nz(spark, d), NF.NZ_CURRENT)


@register("nz_archived_feed", _nz_sql("New Zealand"))
def nz_archived_feed(spark: SparkSession, d: str) -> DataFrame:
    return normalize_source(_nz(spark, d), NF.NZ_ARCHIVED)


# --- X3 + X4: states and territories from one scan ----------------------------

US_SQL = f"""
WITH {STATE_FEED},
us AS (
  SELECT CASE WHEN state NOT IN ('PR', 'VI', 'MP', 'PW', 'FM', 'MH', 'GU', 'AS') THEN 'United States of America'
              WHEN state = 'PR' THEN 'Puerto Rico' WHEN state = 'VI' THEN 'United States Virgin Islands' END AS country_name,
         CAST(substr(date, 1, 10) AS DATE) + {SHIFT_DAYS} AS report_date, l_linenumber % 2 AS page,
         TRY_CAST(trunc(TRY_CAST(COALESCE(previous_day_admission_adult_covid_confirmed, '0') AS DOUBLE)
                      + TRY_CAST(COALESCE(previous_day_admission_pediatric_covid_confirmed, '0') AS DOUBLE)) AS BIGINT)
           AS new_hospitalization
  FROM state_feed),
kept AS (SELECT * FROM us WHERE country_name IS NOT NULL AND report_date >= DATE '2019-12-01' AND new_hospitalization <> 0)"""


def _us(spark: SparkSession, d: str) -> DataFrame:
    raw = feeds.state_feed(spark, d)
    day = F.date_add(F.to_date(F.substring("date", 1, 10)), SHIFT_DAYS)
    raw = raw.withColumn("date", F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00.000")))
    return NF.with_us_country(raw.withColumn("page", F.col("l_linenumber") % 2))


@register("us_pages_feed", f"""{US_SQL}
SELECT country_name, report_date, {_sum("new_hospitalization", "new_hospitalization")} FROM kept GROUP BY ALL""")
def us_pages_feed(spark: SparkSession, d: str) -> DataFrame:
    return normalize_source(_us(spark, d), NF.US_PAGES)


@register("us_pages_joined_feed", f"""{US_SQL},
a AS (SELECT * FROM kept WHERE page = 0), b AS (SELECT * FROM kept WHERE page = 1),
j AS (SELECT COALESCE(a.country_name, b.country_name) AS country_name, COALESCE(a.report_date, b.report_date) AS report_date,
             COALESCE(a.new_hospitalization, b.new_hospitalization) AS n
      FROM a FULL OUTER JOIN b ON a.country_name = b.country_name AND a.report_date = b.report_date
        AND a.new_hospitalization = b.new_hospitalization)
SELECT country_name, report_date, {_sum("n", "new_hospitalization")} FROM j GROUP BY ALL""")
def us_pages_joined_feed(spark: SparkSession, d: str) -> DataFrame:
    return normalize_paged(_us(spark, d), NF.US_PAGES, "page")


# --- X5: %W week codes with a week 53 that is dropped -------------------------

@register("switzerland_feed", f"""
WITH {SHIFTED},
codes AS (SELECT k, c, year(day) AS y, (dayofyear(day) - 1) // 7 + 1 AS w FROM shifted),
r AS (SELECT make_date(y, 1, 1) + CAST((8 - isodow(make_date(y, 1, 1))) % 7 + 7 * (w - 1) AS INTEGER) AS report_date, k
      FROM codes WHERE c % 4 <> 0 AND k % 5 <> 0 AND k % 11 <> 0 AND w <> 53)
SELECT 'Switzerland' AS country_name, report_date, {_sum(ADMISSIONS_SQL, "new_hospitalization")}
FROM r WHERE report_date >= DATE '2019-12-01' GROUP BY report_date""")
def switzerland_feed(spark: SparkSession, d: str) -> DataFrame:
    code = F.concat(F.year("day").cast("string"), F.lpad(day_count_week("day").cast("string"), 2, "0"))
    raw = shifted(spark, d).select(
        F.when(F.col("c") % 4 == 0, "ZH").otherwise("CH").alias("geoRegion"),
        F.when(F.col("k") % 5 == 0, "10-19").otherwise("all").alias("altersklasse_covid19"),
        F.when(F.col("k") % 11 == 0, "other").otherwise("covid").alias("primary_hosp_reason"),
        code.alias("date"), _admissions().alias("entries"))
    return normalize_source(raw, NF.switzerland("monday_week"))


# --- X7: epoch milliseconds as text, two tables joined -------------------------

@register("ireland_feed", f"""
WITH {SHIFTED},
l AS (SELECT day, {ADMISSIONS_SQL} AS h FROM shifted WHERE s <> 'O' AND day >= DATE '2019-12-01'),
r AS (SELECT day, {ICU_SQL} AS i FROM shifted WHERE s = 'O' AND day >= DATE '2019-12-01')
SELECT 'Ireland' AS country_name, COALESCE(l.day, r.day) AS report_date, {_sum("h", "new_hospitalization")},
       {_sum("i", "new_icu")}
FROM l FULL OUTER JOIN r ON l.day = r.day GROUP BY 2""")
def ireland_feed(spark: SparkSession, d: str) -> DataFrame:
    ms = (F.unix_date("day").cast("bigint") * 86_400_000).cast("string")
    rows = shifted(spark, d).withColumn("ms", F.when(F.col("k") % 2 == 0, ms).otherwise(F.concat(ms, F.lit(".0"))))
    hosp = rows.where("s <> 'O'").select(F.col("ms").alias("Date"),
                                         F.concat(_admissions(), F.lit(".0")).alias("SUM_no_new_admissions_covid19_p"))
    icu = rows.where("s = 'O'").select(F.col("ms").alias("extract"), _icu().alias("adcconf"))
    return normalize_measure_pair(hosp, NF.IRELAND_ADMISSIONS, icu, NF.IRELAND_ICU)


# --- X8, X10, and the archived finish in compat mode with the layouts O3 and O4 ---

def _denmark(spark: SparkSession, d: str) -> DataFrame:
    bad = F.when(F.col("k") % 19 == 0, "not reported").otherwise(F.date_format("day", "yyyy/MM/dd"))
    return shifted(spark, d).select(bad.alias("dato"), _admissions().alias("total"))


def _canada(spark: SparkSession, d: str) -> DataFrame:
    return shifted(spark, d).select(F.date_format("day", "yyyy-MM-dd").alias("date"),
                                    _admissions().alias("covid_newother"), _icu().alias("covid_newicu"))


DENMARK_CTE = f"""
dk AS (SELECT 'Denmark' AS country_name, day AS report_date, {_sum(ADMISSIONS_SQL, "new_hospitalization")}
       FROM shifted WHERE k % 19 <> 0 AND day >= DATE '2019-12-01' GROUP BY day)"""
CANADA_CTE = f"""
ca AS (SELECT 'Canada' AS country_name, day AS report_date, {_sum(ADMISSIONS_SQL, "new_hospitalization")},
              {_sum(ICU_SQL, "new_icu")}
       FROM shifted WHERE day >= DATE '2019-12-01' GROUP BY day)"""


@register("denmark_feed", f"WITH {SHIFTED}, {DENMARK_CTE} SELECT * FROM dk")
def denmark_feed(spark: SparkSession, d: str) -> DataFrame:
    return normalize_source(_denmark(spark, d), NF.DENMARK)


@register("canada_feed", f"WITH {SHIFTED}, {CANADA_CTE} SELECT * FROM ca")
def canada_feed(spark: SparkSession, d: str) -> DataFrame:
    return normalize_source(_canada(spark, d), NF.CANADA)


COMPAT_SQL = f"""
WITH {SHIFTED}, {DENMARK_CTE}, {CANADA_CTE}, {PLACES},
merged AS (SELECT country_name, report_date, new_hospitalization, CAST(NULL AS BIGINT) AS new_icu FROM dk
           UNION ALL SELECT country_name, report_date, new_hospitalization, new_icu FROM ca),
weekly AS (SELECT upper(country_name) AS country, CAST(date_trunc('week', report_date) AS DATE) AS epiweek,
                  CAST(SUM(new_hospitalization) AS BIGINT) AS new_hospitalization, CAST(SUM(new_icu) AS BIGINT) AS new_icu
           FROM merged GROUP BY 1, 2),
numbered AS (SELECT *, CAST(year(epiweek) AS INTEGER) AS iso_year,
                    CAST((dayofyear(epiweek) - 1) // 7 + 1 AS INTEGER) AS iso_week_number
             FROM weekly WHERE epiweek < (SELECT max(epiweek) FROM weekly))"""


def _compat_feeds(spark: SparkSession, d: str) -> list[DataFrame]:
    return [normalize_source(_denmark(spark, d), NF.DENMARK), normalize_source(_canada(spark, d), NF.CANADA)]


@register("compat_release_short", f"""{COMPAT_SQL}
SELECT country, epiweek, new_hospitalization, new_icu, iso_year, iso_week_number FROM numbered""")
def compat_release_short(spark: SparkSession, d: str) -> DataFrame:
    """X13 with the group size counted after the rollup, published in layout O3."""
    return archived_weekly_series(_compat_feeds(spark, d), spec=OUTPUT_LEGACY_SHORT, freq_mode="compat")


@register("compat_release_region", f"""{COMPAT_SQL}
SELECT WHO_REGION, country, ISO_3_CODE, iso_year, iso_week_number, epiweek, new_hospitalization
FROM numbered LEFT JOIN (SELECT DISTINCT ADM0_NAME, WHO_REGION, ISO_3_CODE FROM places) p ON country = p.ADM0_NAME""")
def compat_release_region(spark: SparkSession, d: str) -> DataFrame:
    """The same in layout O4, whose region columns come from the reference table."""
    return archived_weekly_series(_compat_feeds(spark, d), reference=feeds.places(spark, d), spec=OUTPUT_LEGACY_REGION,
                                  freq_mode="compat")


# --- X6-like: a stock measure beside a flow, each with its own aggregate --------

@register("stock_pair_feed", f"""
WITH {SHIFTED},
l AS (SELECT day, {_sum(ADMISSIONS_SQL, "h")} FROM shifted WHERE s <> 'O' AND day >= DATE '2019-12-01' GROUP BY day),
r AS (SELECT day, COALESCE(max({ICU_SQL}), 0) AS i FROM shifted WHERE s = 'O' AND day >= DATE '2019-12-01' GROUP BY day)
SELECT 'Norway' AS country_name, COALESCE(l.day, r.day) AS report_date,
       CAST(COALESCE(h, 0) AS BIGINT) AS new_hospitalization, CAST(COALESCE(i, 0) AS BIGINT) AS new_icu
FROM l FULL OUTER JOIN r ON l.day = r.day""")
def stock_pair_feed(spark: SparkSession, d: str) -> DataFrame:
    rows = shifted(spark, d)
    hosp = rows.where("s <> 'O'").select(F.date_format("day", "d/M/yyyy").alias("date"), _admissions().alias("new_hospit"))
    icu = rows.where("s = 'O'").select(F.date_format("day", "yyyy-MM-dd").alias("date"), _icu().alias("new_icu"))
    beds = dataclasses.replace(NF.NORWAY_ICU, measures=(dataclasses.replace(NF.NORWAY_ICU.measures[0], aggregate="max"),))
    return normalize_measure_pair(hosp, NF.NORWAY_ADMISSIONS, icu, beds)


# --- X2: the sentinel feed: labels, seasons, month-first dates in several layouts, a first date ----

SENTINEL_SHIFT = 110


@register("us_sentinel_feed", f"""
WITH s AS (
  SELECT CASE event_id % 4 WHEN 0 THEN '2223' WHEN 1 THEN '2324' ELSE '2425' END AS season, event_id % 3 AS p,
         CASE WHEN event_id % 10 <> 0 THEN CAST(floor(value * 10) AS BIGINT) END AS estimate, user_id % 5 AS strata,
         CASE WHEN event_id % 17 <> 0 THEN CAST(ts AS DATE) + {SENTINEL_SHIFT} END AS day
  FROM events)
SELECT 'UNITED STATES OF AMERICA' AS country_name, day AS report_date, estimate AS new_hospitalization,
       CAST(NULL AS BIGINT) AS new_icu, 'AMRO' AS WHO_REGION, 'USA' AS ISO_3_CODE
FROM s WHERE p <> 0 AND strata <> 0 AND season IN ('2324', '2425') AND day >= DATE '2024-05-04'""")
def us_sentinel_feed(spark: SparkSession, d: str) -> DataFrame:
    e = feeds.table(spark, d, "events")
    k, day = F.col("event_id"), F.date_add(F.to_date("ts"), SENTINEL_SHIFT)
    time = (F.when(k % 17 == 0, "in week 18").when(k % 3 == 1, F.date_format(day, "MM/dd/yyyy"))
            .otherwise(F.date_format(day, "MMMM d, yyyy")))
    rows = e.select(
        F.when(k % 4 == 0, "2223").when(k % 4 == 1, "2324").otherwise("2425").alias("season"),
        F.when(k % 3 == 0, "Month").when(k % 3 == 1, " Week").otherwise("WEEK\t").alias("time_period"),
        F.when(k % 10 == 0, "n/a").otherwise(F.floor(F.col("value") * 10).cast("string")).alias("estimate"),
        F.when(F.col("user_id") % 5 == 0, "Age").otherwise("Overall").alias("strata"), time.alias("time"))
    return normalize_source(rows, NF.CDC_SENTINEL)


# --- X6: two tables with the country in the data, joined on (area, date) -------------

@register("uk_feed", f"""
WITH {SHIFTED},
r AS (SELECT 'Area ' || CAST(c % 4 AS VARCHAR) AS area, * FROM shifted WHERE day >= DATE '2019-12-01'),
l AS (SELECT area, day, {ADMISSIONS_SQL} AS h FROM r WHERE s <> 'O'),
v AS (SELECT area, day, {ICU_SQL} AS i FROM r WHERE s = 'O')
SELECT COALESCE(l.area, v.area) AS country_name, COALESCE(l.day, v.day) AS report_date,
       {_sum("h", "new_hospitalization")}, {_sum("i", "new_icu")}
FROM l FULL OUTER JOIN v ON l.area = v.area AND l.day = v.day GROUP BY 1, 2""")
def uk_feed(spark: SparkSession, d: str) -> DataFrame:
    rows = shifted(spark, d).select("s", F.concat(F.lit("Area "), F.col("c") % 4).alias("area_name"),
                                    F.date_format("day", "yyyy-MM-dd").alias("date"),
                                    _admissions().alias("new_admissions"), _icu().alias("covid_occupied_mv_beds"))
    return normalize_measure_pair(rows.where("s <> 'O'"), NF.UK_ADMISSIONS, rows.where("s = 'O'"), NF.UK_VENTILATED)


# --- X11: array records whose first one holds non-ASCII names -------------------------

@register("bulgaria_feed", f"""
WITH {SHIFTED}
SELECT 'Bulgaria' AS country_name, day AS report_date, {_sum(ADMISSIONS_SQL, "new_hospitalization")}
FROM shifted WHERE day >= DATE '2019-12-01' GROUP BY day""")
def bulgaria_feed(spark: SparkSession, d: str) -> DataFrame:
    records = shifted(spark, d).select(F.array(F.date_format("day", "yyyy-MM-dd"), _admissions()).alias("record"))
    header = spark.range(1).select(F.array(*[F.lit(n) for n in NF.BG_FIELDS]).alias("record"))
    rows = promote_header_record(records.unionByName(header), "record", list(NF.BG_FIELDS))
    return normalize_source(rows, NF.BULGARIA)


# --- Q1 end to end: what the flows sum and what they reject add up to the input ----

@register("release_row_balance", f"""
WITH {SHIFTED},
f AS (SELECT 'dk' AS feed, CASE WHEN k % 19 = 0 THEN NULL ELSE day END AS day, k % 19 = 0 AS text FROM shifted
      UNION ALL SELECT 'ca', day, FALSE FROM shifted),
g AS (SELECT feed, CASE WHEN day IS NULL AND text THEN 'unparsed' WHEN day IS NULL THEN 'missing'
                        WHEN day < DATE '2019-12-01' THEN 'before_min' WHEN day > DATE '{LAST_DATE}' THEN 'after_max'
                        ELSE 'valid' END AS reason FROM f)
SELECT feed, reason, CAST(count(*) AS BIGINT) AS n_rows FROM g GROUP BY ALL
UNION ALL SELECT feed, 'input', CAST(count(*) AS BIGINT) FROM f GROUP BY ALL""")
def release_row_balance(spark: SparkSession, d: str) -> DataFrame:
    tables = [(df, NF.bounded(spec, LAST_DATE)) for df, spec in
              ((_denmark(spark, d), NF.DENMARK), (_canada(spark, d), NF.CANADA))]
    rejected = NF.rejected_rows(tables).select("feed", F.col("date_issue").alias("reason"))
    valid = [to_report_rows(df, spec).select(F.lit(spec.name).alias("feed"), F.lit("valid").alias("reason"))
             for df, spec in tables]
    every = [df.select(F.lit(spec.name).alias("feed"), F.lit("input").alias("reason")) for df, spec in tables]
    return union_by_name([rejected, *valid, *every]).groupBy("feed", "reason").agg(F.count(F.lit(1)).alias("n_rows"))
