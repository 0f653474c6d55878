"""Week numbers under all rules, week codes, date parsing and the plausibility split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.functions import dates as D
from hebdo.functions.casts import to_text
from hebdo.operators.filters import drop_week
from hebdo.operators.quarantine import tag_date_issues
from hebdo.plans import feeds
from hebdo.plans.catalog.registry import register
from hebdo.plans.catalog.sql import PARSED_DATES, RENDERED_DATES, WEEK_CODES, sql_iso_monday


@register("week_numbers_all_rules", """
WITH dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS report_date FROM orders),
w AS (SELECT report_date, CAST(date_trunc('week', report_date) AS DATE) AS epiweek FROM dates)
SELECT report_date, epiweek,
       CAST(year(epiweek) AS INTEGER) AS calendar_year,
       CAST(weekofyear(epiweek) AS INTEGER) AS iso_week,
       CAST(isoyear(epiweek) AS INTEGER) AS iso_year,
       CAST((dayofyear(epiweek) - 1) // 7 + 1 AS INTEGER) AS day_count_week
FROM w""")
def week_numbers_all_rules(spark: SparkSession, d: str) -> DataFrame:
    dates = feeds.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("report_date")).distinct()
    e = F.col("epiweek")
    return dates.withColumn("epiweek", D.week_start("report_date")).select(
        "report_date", "epiweek",
        D.calendar_year(e).alias("calendar_year"), D.iso_week(e).alias("iso_week"),
        D.iso_year(e).cast("int").alias("iso_year"), D.day_count_week(e).alias("day_count_week"))


# ---------------------------------------------------------------------------
# Week codes
# ---------------------------------------------------------------------------

@register("week_code_parse_w", f"""
WITH {WEEK_CODES},
p AS (SELECT week_code, substr(week_code || '1', 1, 4) AS year_part, substr(week_code || '1', 5, 2) AS week_part,
             substr(week_code || '1', 7, 1) AS weekday_part FROM codes)
SELECT week_code, year_part, week_part,
       make_date(CAST(year_part AS INTEGER), 1, 1)
         + CAST((8 - isodow(make_date(CAST(year_part AS INTEGER), 1, 1))) % 7
                + 7 * (CAST(week_part AS INTEGER) - 1) + CAST(weekday_part AS INTEGER) - 1 AS INTEGER) AS report_date,
       CAST(count(*) AS BIGINT) AS n_orders
FROM p WHERE CAST(week_part AS INTEGER) <> 53 GROUP BY ALL""")
def week_code_parse_w(spark: SparkSession, d: str) -> DataFrame:
    codes = feeds.order_week_codes(spark, d).withColumn("with_weekday", F.concat("week_code", F.lit("1")))
    parts = codes.withColumns({"year_part": F.substring("with_weekday", 1, 4),
                               "week_part": F.substring("with_weekday", 5, 2),
                               "weekday_part": F.substring("with_weekday", 7, 1)})
    parts = drop_week(parts, "week_part", 53)
    dated = parts.withColumn("report_date", D.date_of_monday_week("year_part", "week_part", "weekday_part"))
    return dated.groupBy("week_code", "year_part", "week_part", "report_date").agg(
        F.count(F.lit(1)).alias("n_orders"))


@register("week_code_parse_iso", f"""
WITH {WEEK_CODES},
p AS (SELECT week_code, substr(week_code, 1, 4) AS year_part, substr(week_code, 5, 2) AS week_part,
             CAST(substr(week_code, 1, 4) AS INTEGER) AS y, CAST(substr(week_code, 5, 2) AS INTEGER) AS w FROM codes)
SELECT week_code, year_part, week_part, {sql_iso_monday('y', 'w')} AS report_date, CAST(count(*) AS BIGINT) AS n_orders
FROM p GROUP BY week_code, year_part, week_part, report_date""")
def week_code_parse_iso(spark: SparkSession, d: str) -> DataFrame:
    codes = feeds.order_week_codes(spark, d)
    parts = codes.withColumns({"year_part": D.week_code_year("week_code"),
                               "week_part": D.week_code_week("week_code")})
    dated = parts.withColumn("report_date", D.monday_of_iso_week("year_part", "week_part"))
    return dated.groupBy("week_code", "year_part", "week_part", "report_date").agg(
        F.count(F.lit(1)).alias("n_orders"))


# ---------------------------------------------------------------------------
# Date parsing and the plausibility split
# ---------------------------------------------------------------------------

def _parsed_dates(spark: SparkSession, d: str) -> DataFrame:
    raw = feeds.rendered_order_dates(spark, d)
    return raw.select("o_orderkey", "raw_date",
                      F.coalesce(D.parse_date_leading("raw_date"),
                                 D.parse_month_first("raw_date")).alias("report_date"),
                      D.parse_day_first("raw_date").alias("report_date_dmy"))


@register("date_parse_multiformat", f"""
WITH {RENDERED_DATES}, {PARSED_DATES}
SELECT o_orderkey, raw_date, report_date, report_date_dmy, CAST(report_date AS VARCHAR) AS report_date_text
FROM parsed""")
def date_parse_multiformat(spark: SparkSession, d: str) -> DataFrame:
    return _parsed_dates(spark, d).withColumn("report_date_text", to_text("report_date"))


@register("date_quarantine", f"""
WITH {RENDERED_DATES}, {PARSED_DATES}
SELECT o_orderkey, report_date,
       CASE WHEN report_date IS NULL AND raw_date IS NOT NULL THEN 'unparsed'
            WHEN report_date IS NULL THEN 'missing'
            WHEN report_date < DATE '1996-01-01' THEN 'before_min'
            WHEN report_date > DATE '2000-12-31' THEN 'after_max' END AS date_issue
FROM parsed""")
def date_quarantine(spark: SparkSession, d: str) -> DataFrame:
    tagged = tag_date_issues(_parsed_dates(spark, d), "report_date", raw_col="raw_date",
                             min_date="1996-01-01", max_date="2000-12-31")
    return tagged.select("o_orderkey", "report_date", "date_issue")


@register("epoch_ms_to_date", """
SELECT event_id, epoch_us(CAST(ts AS TIMESTAMP)) // 1000 AS epoch_ms, CAST(ts AS DATE) AS report_date
FROM events""")
def epoch_ms_to_date(spark: SparkSession, d: str) -> DataFrame:
    e = feeds.table(spark, d, "events").select("event_id", D.wall_clock_epoch_ms("ts").alias("epoch_ms"))
    return e.withColumn("report_date", D.epoch_ms_to_date("epoch_ms"))


