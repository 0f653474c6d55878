"""Streaming weekly rollup: same weeks as the batch rollup; late rows within
the watermark count; a week is emitted once it is closed."""

import datetime as dt

from conftest import d
from hebdo.operators.rollup import weekly_rollup
from hebdo.streaming.weekly_stream import start_weekly_rollup, weekly_window_aggregate

SCHEMA = "country_name string, report_date date, new_hospitalization bigint"


def test_window_weeks_are_mondays(spark):
    days = [(f"C{i % 3}", d("2024-12-20") + dt.timedelta(days=i), i) for i in range(40)]
    df = spark.createDataFrame(days, SCHEMA)
    w = weekly_window_aggregate(df.withColumn("ts", df.report_date.cast("timestamp_ntz")), "ts",
                                ["country_name"], ["new_hospitalization"])
    b = weekly_rollup(df, ["country_name"], "report_date", ["new_hospitalization"], reports_col="reports")
    key = lambda r: (r["country_name"], r["epiweek"], r["new_hospitalization"], r["reports"])
    assert sorted(map(key, w.collect())) == sorted(map(key, b.collect()))
    assert all(r["epiweek"].weekday() == 0 for r in w.collect())


def test_stream_emits_closed_weeks(spark, tmp_path):
    src = tmp_path / "landed"
    batch1 = [("A", d("2024-01-01"), 1), ("A", d("2024-01-03"), 2), ("B", d("2024-01-09"), 5)]
    batch2 = [("A", d("2024-01-05"), 10), ("A", d("2024-02-20"), 7)]   # one late row, one far ahead
    spark.createDataFrame(batch1, SCHEMA).write.parquet(str(src / "f1"))
    spark.createDataFrame(batch2, SCHEMA).write.parquet(str(src / "f2"))
    q = start_weekly_rollup(spark, str(src) + "/*", SCHEMA, str(tmp_path / "out"), ["country_name"],
                            ["new_hospitalization"], checkpoint_location=str(tmp_path / "ckpt"),
                            watermark="7 days")
    q.awaitTermination(120)
    out = {(r["country_name"], r["epiweek"].isoformat()): (r["new_hospitalization"], r["reports"])
           for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert out[("A", "2024-01-01")] == (13, 3)
    assert out[("B", "2024-01-08")] == (5, 1)
    assert ("A", "2024-02-19") not in out          # still open: within the watermark


def test_stream_daily_dedupe_then_weekly(spark, tmp_path):
    schema = "country_name string, report_date date, new_hospitalization bigint, src_ord int"
    src = tmp_path / "landed"
    spark.createDataFrame([("A", d("2024-01-01"), 1, 1), ("A", d("2024-01-01"), 5, 2), ("A", d("2024-01-03"), 2, 1),
                           ("B", d("2024-01-02"), None, 1), ("B", d("2024-01-02"), None, 2)], schema
                          ).write.parquet(str(src / "f1"))
    spark.createDataFrame([("A", d("2024-02-20"), 7, 1)], schema).write.parquet(str(src / "f2"))
    q = start_weekly_rollup(spark, str(src) + "/*", schema, str(tmp_path / "out"), ["country_name"],
                            ["new_hospitalization"], checkpoint_location=str(tmp_path / "ckpt"),
                            watermark="7 days", dedupe_by="new_hospitalization", tie_break=("src_ord",))
    q.awaitTermination(120)
    out = {(r["country_name"], r["epiweek"].isoformat()): (r["new_hospitalization"], r["reports"])
           for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert out == {("A", "2024-01-01"): (7, 2), ("B", "2024-01-01"): (None, 1)}


def test_default_stream_checkpoint_is_stable(spark, tmp_path):
    """Two runs on the same sink share the default checkpoint: the second
    resumes and emits nothing new for already-committed weeks."""
    src = tmp_path / "landed"
    spark.createDataFrame([("A", d("2024-01-01"), 1), ("A", d("2024-02-20"), 2)], SCHEMA).write.parquet(str(src / "f1"))
    sink = str(tmp_path / "out")
    for _ in range(2):
        q = start_weekly_rollup(spark, str(src) + "/*", SCHEMA, sink, ["country_name"], ["new_hospitalization"],
                                watermark="7 days")
        q.awaitTermination(120)
    rows = spark.read.parquet(sink).collect()
    assert [(r["country_name"], r["epiweek"].isoformat(), r["new_hospitalization"]) for r in rows] == [
        ("A", "2024-01-01", 1)]
