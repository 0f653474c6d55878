"""SQL (DuckDB) forms of the stand-in feeds, shared by the oracles."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# SQL forms of the stand-in feeds (see plans/feeds.py)
# ---------------------------------------------------------------------------

ORDERS_REPORTS = """
orders_reports AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         o_orderpriority AS country_name,
         CAST(o_orderdate AS DATE) AS report_date,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 13 END AS new_hospitalization,
         CASE WHEN day(o_orderdate) <= 7 THEN NULL ELSE o_custkey % 4 END AS new_icu
  FROM orders)"""

RENDERED_DATES = """
rendered AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 6 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00.000'
              WHEN o_orderkey % 6 = 1 THEN strftime(o_orderdate, '%Y/%m/%d')
              WHEN o_orderkey % 6 = 2 THEN strftime(o_orderdate, '%m/%d/%Y')
              WHEN o_orderkey % 6 = 3 THEN strftime(o_orderdate, '%B %-d, %Y')
              WHEN o_orderkey % 6 = 4 THEN strftime(o_orderdate, '%-d/%-m/%Y')
              WHEN o_orderkey % 12 = 5 THEN 'not reported'
              ELSE CAST(year(o_orderdate) AS VARCHAR) || '-02-30' END AS raw_date
  FROM orders)"""


def sql_leading_date(col: str) -> str:
    """SQL twin of functions.dates.parse_date_leading."""
    return (f"COALESCE(CAST(try_strptime(regexp_extract({col}, '^\\s*(\\d{{4}}-\\d{{1,2}}-\\d{{1,2}})', 1), '%Y-%m-%d') AS DATE), "
            f"CAST(try_strptime(regexp_extract({col}, '^\\s*(\\d{{4}}/\\d{{1,2}}/\\d{{1,2}})', 1), '%Y/%m/%d') AS DATE))")


def sql_formats(col: str, formats: list[str]) -> str:
    parts = [f"CAST(try_strptime(trim({col}), '{f}') AS DATE)" for f in formats]
    return "COALESCE(" + ", ".join(parts) + ")"


SQL_MONTH_FIRST = ["%m/%d/%Y", "%m-%d-%Y", "%B %d, %Y", "%b %d, %Y"]
SQL_DAY_FIRST = ["%d/%m/%Y", "%d-%m-%Y", "%d.%m.%Y"]

PARSED_DATES = f"""
parsed AS (
  SELECT o_orderkey, raw_date,
         COALESCE({sql_leading_date('raw_date')}, {sql_formats('raw_date', SQL_MONTH_FIRST)}) AS report_date,
         {sql_formats('raw_date', SQL_DAY_FIRST)} AS report_date_dmy
  FROM rendered)"""

WEEK_CODES = """
codes AS (
  SELECT o_orderkey,
         CAST(year(o_orderdate) AS VARCHAR)
           || lpad(CAST((dayofyear(o_orderdate) - 1) // 7 + 1 AS VARCHAR), 2, '0') AS week_code
  FROM orders)"""

ORDER_PAGES = """
order_rows AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS report_date,
         CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderkey % 5 END AS value, o_custkey
  FROM orders),
page1 AS (SELECT * FROM order_rows WHERE o_orderkey % 2 = 0),
page2 AS (SELECT * FROM order_rows WHERE o_orderkey % 2 = 1)"""

STATE_FEED = """
state_feed AS (
  SELECT l_linenumber,
         ['CA', 'NY', 'TX', 'PR', 'VI', 'WA', 'OR', 'GU', NULL, 'AS'][l_suppkey % 10 + 1] AS state,
         strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00.000' AS date,
         CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR) END
           AS previous_day_admission_adult_covid_confirmed,
         CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN 'abc'
              ELSE CAST(l_linenumber AS VARCHAR) END AS previous_day_admission_pediatric_covid_confirmed
  FROM lineitem)"""

def state_rows_sql(name: str = "state_rows", extra_where: str = "TRUE", extra_cols: str = "") -> str:
    """SQL twin of normalize.to_report_rows(STATE_SPEC) (before the daily sum)."""
    return f"""
{name} AS (
  SELECT 'United States of America' AS country_name, {extra_cols}
         {sql_leading_date('date')} AS report_date,
         TRY_CAST(trunc(TRY_CAST(COALESCE(previous_day_admission_adult_covid_confirmed, '0') AS DOUBLE)
                      + TRY_CAST(COALESCE(previous_day_admission_pediatric_covid_confirmed, '0') AS DOUBLE)) AS BIGINT)
           AS new_hospitalization
  FROM state_feed
  WHERE state NOT IN ('PR', 'VI', 'MP', 'PW', 'FM', 'MH', 'GU', 'AS') AND {extra_where})"""


STATE_ROWS = state_rows_sql()


WEEKLY_CODE_FEED = """
weekly_code_feed AS (
  SELECT CAST(isoyear(ts) AS VARCHAR) || lpad(CAST(weekofyear(ts) AS VARCHAR), 2, '0') AS date,
         CASE WHEN user_id % 4 = 0 THEN 'ZH' ELSE 'CH' END AS geoRegion,
         CASE WHEN event_type = 'view' THEN '10-19' ELSE 'all' END AS altersklasse_covid19,
         CASE WHEN event_type = 'error' THEN 'other' ELSE 'covid' END AS primary_hosp_reason,
         CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS entries
  FROM events)"""


def sql_iso_monday(year: str, week: str) -> str:
    m = f"(CAST(date_trunc('week', make_date({year}, 1, 4)) AS DATE) + 7 * ({week} - 1))"
    return f"CASE WHEN {week} BETWEEN 1 AND 53 AND weekofyear({m}) = {week} THEN {m} END"


PLACES = """
places AS (
  SELECT n_nationkey, n_name AS ADM0_NAME,
         CASE r_name WHEN 'AFRICA' THEN 'AFRO' WHEN 'AMERICA' THEN 'AMRO' WHEN 'EUROPE' THEN 'EURO'
                     WHEN 'MIDDLE EAST' THEN 'EMRO' ELSE r_name END AS WHO_REGION,
         'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS ISO_3_CODE
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


