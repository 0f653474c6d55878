"""A1-A4, C1, F9 on FIXTURES C1."""

from pyspark.sql import functions as F

from conftest import d, rows
from hebdo.operators.filters import drop_latest_week
from hebdo.operators.rollup import (daily_totals, frequency_label, rows_per_group, weekly_rollup)

C1 = [("A", "2024-12-29", 3, None), ("A", "2024-12-30", 5, 1), ("A", "2024-12-31", None, 2),
      ("A", "2025-01-05", 7, None), ("B", "2024-12-30", None, None), ("B", "2025-01-01", None, None),
      ("B", "2025-01-06", 4, 0)]


def c1(spark):
    return spark.createDataFrame([(c, d(t), h, i) for c, t, h, i in C1],
                                 "country string, report_date date, h bigint, i bigint")


def test_null_preserving_and_reports(spark):
    got = rows(weekly_rollup(c1(spark), ["country"], "report_date", ["h", "i"], "keep", reports_col="reports"),
               ["country", "epiweek"])
    assert [(r["country"], r["epiweek"].isoformat(), r["h"], r["i"], r["reports"]) for r in got] == [
        ("A", "2024-12-23", 3, None, 1), ("A", "2024-12-30", 12, 3, 3),
        ("B", "2024-12-30", None, None, 2), ("B", "2025-01-06", 4, 0, 1)]


def test_zero_fill(spark):
    got = rows(weekly_rollup(c1(spark), ["country"], "report_date", ["h"], "zero"), ["country", "epiweek"])
    assert [r["h"] for r in got] == [3, 12, 0, 4]


def test_week_rule_columns(spark):
    got = rows(weekly_rollup(c1(spark), ["country"], "report_date", ["h"], week_rule="iso_week_end_year"),
               ["country", "epiweek"])
    assert [(r["iso_year"], r["iso_week_number"]) for r in got] == [(2024, 52), (2025, 1), (2025, 1), (2025, 2)]


def test_labels_compat_vs_reports(spark):
    weekly = weekly_rollup(c1(spark), ["country"], "report_date", ["h"], reports_col="reports")
    compat = rows_per_group(weekly, ["country", "epiweek"], "freq_time").withColumn("freq", frequency_label("freq_time"))
    assert {r["freq"] for r in compat.collect()} == {"weekly"}
    fixed = rows(weekly.withColumn("freq", frequency_label("reports")), ["country", "epiweek"])
    assert [r["freq"] for r in fixed] == ["weekly", "daily", "daily", "weekly"]


def test_drop_latest_week_global_and_per_country(spark):
    weekly = weekly_rollup(c1(spark), ["country"], "report_date", ["h"])
    kept = rows(drop_latest_week(weekly, "epiweek"), ["country", "epiweek"])
    assert [(r["country"], r["epiweek"].isoformat()) for r in kept] == [
        ("A", "2024-12-23"), ("A", "2024-12-30"), ("B", "2024-12-30")]
    per = rows(drop_latest_week(weekly, "epiweek", per=["country"]), ["country", "epiweek"])
    assert [(r["country"], r["epiweek"].isoformat()) for r in per] == [("A", "2024-12-23"), ("B", "2024-12-30")]
    mat = drop_latest_week(weekly, "epiweek", materialize_input=True)
    assert mat.count() == 3


def test_measure_aggregates_stock(spark):
    df = spark.createDataFrame([("A", d("2024-01-01"), 5), ("A", d("2024-01-03"), 2), ("A", d("2024-01-02"), 9)],
                               "country string, report_date date, beds bigint")
    r = weekly_rollup(df, ["country"], "report_date", {"beds": "last"}).first()
    assert r["beds"] == 2
    r = weekly_rollup(df, ["country"], "report_date", {"beds": "max"}).first()
    assert r["beds"] == 9


def test_daily_totals_partial_aggregation_plan(spark):
    plan = daily_totals(c1(spark), ["country"], "report_date", ["h"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_total_equals_raw_when_no_nulls(spark):
    df = spark.range(5000).select((F.col("id") % 7).cast("string").alias("country"),
                                  F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 100).cast("int")).alias("report_date"),
                                  (F.col("id") % 13).alias("h"))
    total = weekly_rollup(df, ["country"], "report_date", ["h"]).agg(F.sum("h")).first()[0]
    assert total == df.agg(F.sum("h")).first()[0]
