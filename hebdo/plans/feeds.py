"""Stand-in feeds derived from the driver's tables.

The reference's inputs are national surveillance feeds; the registered
queries read the generated TPC-H-like tables instead and shape them into the
same kinds of feed (text measures with gaps, several date layouts, pages,
week codes, GeoJSON documents).  Every frame here is a projection of a full
table, so the work grows with the data.  NULLs are injected by key
arithmetic so that the DuckDB oracle can repeat them exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.functions.dates import day_count_week
from hebdo.functions.text import recode
from hebdo.operators.combine import broadcast_if_small

# The eight US territories the state feed excludes.
US_TERRITORIES = ("PR", "VI", "MP", "PW", "FM", "MH", "GU", "AS")

# Codes assigned to lineitem rows (by l_suppkey % 10) to play the state feed;
# index 8 has no state.
STATE_CODES = ("CA", "NY", "TX", "PR", "VI", "WA", "OR", "GU", None, "AS")

# Region names of the test tables mapped to region codes (others pass through).
REGION_CODES = {"AFRICA": "AFRO", "AMERICA": "AMRO", "EUROPE": "EURO", "MIDDLE EAST": "EMRO"}


# Read schemas of the driver's tables (explicit: no footer-based inference).
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def null_when(cond: Column, value: Column) -> Column:
    return F.when(~cond, value)


def orders_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as daily reports: priority plays the country, two count measures
    with gaps (every 7th order has no admissions figure, the first week of
    each month has no ICU figure)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.col("o_orderpriority").alias("country_name"),
        F.to_date("o_orderdate").alias("report_date"),
        null_when(k % 7 == 0, k % 13).alias("new_hospitalization"),
        null_when(F.dayofmonth("o_orderdate") <= 7, F.col("o_custkey") % 4).alias("new_icu"))


def rendered_order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written the ways feeds write them, plus unusable text."""
    o = table(spark, sf_dir, "orders")
    k, ts = F.col("o_orderkey"), F.col("o_orderdate")
    raw = (F.when(k % 6 == 0, F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit("T00:00:00.000")))
           .when(k % 6 == 1, F.date_format(ts, "yyyy/MM/dd"))
           .when(k % 6 == 2, F.date_format(ts, "MM/dd/yyyy"))
           .when(k % 6 == 3, F.date_format(ts, "MMMM d, yyyy"))
           .when(k % 6 == 4, F.date_format(ts, "d/M/yyyy"))
           .when(k % 12 == 5, F.lit("not reported"))
           .otherwise(F.concat(F.year(ts).cast("string"), F.lit("-02-30"))))
    return o.select("o_orderkey", raw.alias("raw_date"))


def order_week_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``yyyyww`` codes (7-day-block weeks, so week 53 occurs) per order."""
    d = F.to_date("o_orderdate")
    code = F.concat(F.year(d).cast("string"), F.lpad(day_count_week(d).cast("string"), 2, "0"))
    return table(spark, sf_dir, "orders").select("o_orderkey", code.alias("week_code"))


def order_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders split into two 'pages' (even / odd keys) of (date, small value);
    the value domain is small so keys repeat within and across pages."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    rows = o.select(k, F.to_date("o_orderdate").alias("report_date"),
                    null_when(k % 23 == 0, k % 5).alias("value"), F.col("o_custkey"))
    return rows.filter(k % 2 == 0), rows.filter(k % 2 == 1)


def state_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem as the US state feed: state code, ISO timestamp text, adult and
    paediatric admissions as text with gaps and junk."""
    li = table(spark, sf_dir, "lineitem")
    codes = F.array(*[F.lit(c) for c in STATE_CODES])
    state = F.element_at(codes, (F.col("l_suppkey") % 10 + 1).cast("int"))
    adult = null_when(F.col("l_linenumber") == 3, F.col("l_quantity").cast("bigint").cast("string"))
    key = F.col("l_orderkey")
    paediatric = (F.when(key % 11 == 0, F.lit(None).cast("string"))
                  .when(key % 13 == 0, F.lit("abc"))
                  .otherwise(F.col("l_linenumber").cast("string")))
    return li.select(
        F.col("l_linenumber"),
        state.alias("state"),
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T00:00:00.000")).alias("date"),
        adult.alias("previous_day_admission_adult_covid_confirmed"),
        paediatric.alias("previous_day_admission_pediatric_covid_confirmed"))


def weekly_code_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a weekly feed keyed by ISO ``yyyyww`` with region / age /
    reason slices (only CH / all / covid rows are the national series)."""
    e = table(spark, sf_dir, "events")
    ts = F.col("ts")
    code = F.concat(F.extract(F.lit("YEAROFWEEK"), ts).cast("string"),
                    F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))
    return e.select(
        code.alias("date"),
        F.when(F.col("user_id") % 4 == 0, "ZH").otherwise("CH").alias("geoRegion"),
        F.when(F.col("event_type") == "view", "10-19").otherwise("all").alias("altersklasse_covid19"),
        F.when(F.col("event_type") == "error", "other").otherwise("covid").alias("primary_hosp_reason"),
        F.floor("value").cast("bigint").cast("string").alias("entries"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference places from nation + region (one row per nation)."""
    n = table(spark, sf_dir, "nation")
    r = broadcast_if_small(table(spark, sf_dir, "region"))
    return (n.join(r, n["n_regionkey"] == r["r_regionkey"])
             .select("n_nationkey", F.col("n_name").alias("ADM0_NAME"),
                     recode("r_name", REGION_CODES).alias("WHO_REGION"),
                     F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("ISO_3_CODE")))


def customer_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer -> reference place (a dimension as large as ``customer``)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    p = broadcast_if_small(places(spark, sf_dir))
    return c.join(p, c["c_nationkey"] == p["n_nationkey"]).drop("c_nationkey", "n_nationkey")


def customer_nations(spark: SparkSession, sf_dir: str, name_col: str = "country_name") -> DataFrame:
    """Customer -> nation name."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = broadcast_if_small(table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias(name_col)))
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).drop("c_nationkey", "n_nationkey")
