"""Versions behind a pointer, weeks from footers, refreshed weeks, counts in the same pass, W1 by rank."""

import dataclasses
import os

import pytest

from conftest import d, rows
from hebdo.operators.dedupe import packed_ranks, top1_by_rank, top1_per_group
from hebdo.operators.quarantine import observe_issues, observed_counts, tag_date_issues
from hebdo.plans.normalize import normalize_observed, normalize_source, quarantined_rows
from hebdo.plans.refresh import SeriesStore, refresh
from hebdo.plans.release import archived_weeks, combine_sources, current_weeks
from hebdo.plans.specs import DateSpec, MeasureSpec, SourceSpec
from hebdo.session import materialize
from hebdo.sources import versions
from hebdo.sources.footers import footer_max, latest_week, read_before_latest_week
from hebdo.sources.sinks import write_parquet
from hebdo.sources.versions import (BrokenOrder, check_order, current_version, part_ranges, publish_version, read_in_order,
                                    read_manifest, read_version)
from pyspark.sql import functions as F


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- S9/K1: versions ------------------------------------------------------------

def series(spark, n, factor=1):
    return spark.range(n).select(F.concat(F.lit("c"), F.col("id") % 7).alias("country"),
                                 F.when(F.col("id") % 11 > 0, F.expr("date_add(date'2024-01-01', int(id % 300))")).alias("epiweek"),
                                 (F.col("id") * factor).alias("n"))


def test_parts_follow_one_another(spark, tmp_path):
    root = str(tmp_path)
    version = publish_version(series(spark, 2000), root, ["country", "epiweek", "n"], part_rows=300)
    assert current_version(spark, root) == version
    manifest = read_manifest(spark, root).orderBy("part").collect()
    assert len(manifest) > 3 and sum(r["n_rows"] for r in manifest) == 2000
    out = read_in_order(spark, root).orderBy("position").collect()
    key = lambda r: (r["country"], r["epiweek"] is not None, r["epiweek"], r["n"])
    assert [r["position"] for r in out] == list(range(1, 2001))
    assert [key(r) for r in out] == sorted((key(r) for r in series(spark, 2000).collect()),
                                           key=lambda k: (k[0], k[1], str(k[2]), k[3]))


def test_readers_keep_the_old_version_until_the_new_one_is_whole(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        read_version(spark, root)
    first = publish_version(series(spark, 100), root, ["country", "epiweek", "n"])
    broken = series(spark, 100, 2).withColumn("n", F.when(F.col("n") > 150, F.raise_error(F.lit("lost"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="lost"):
        publish_version(broken, root, ["country", "epiweek", "n"])
    monkeypatch.setattr(versions, "check_order", lambda ranges: (_ for _ in ()).throw(BrokenOrder("x")))
    with pytest.raises(BrokenOrder):
        publish_version(series(spark, 100, 2), root, ["country", "epiweek", "n"])
    monkeypatch.undo()
    assert current_version(spark, root) == first and read_version(spark, root).agg(F.max("n")).first()[0] == 99
    second = publish_version(series(spark, 100, 2), root, ["country", "epiweek", "n"])
    assert read_version(spark, root).agg(F.max("n")).first()[0] == 198
    assert read_version(spark, root, first).agg(F.max("n")).first()[0] == 99
    assert current_version(spark, root) == second
    assert [f for f in os.listdir(root) if f.startswith("CURRENT-")] == []


def test_broken_orders_are_found(spark, tmp_path):
    key = ["n"]
    spark.range(100).select((-F.col("id")).alias("n")).coalesce(1).write.parquet(str(tmp_path / "unsorted"))
    spark.range(100).select(F.col("id").alias("n")).repartition(3, "n").sortWithinPartitions("n").write.parquet(
        str(tmp_path / "interleaved"))
    for name in ("unsorted", "interleaved"):
        with pytest.raises(BrokenOrder):
            check_order(part_ranges(spark.read.parquet(str(tmp_path / name)), key))


def test_an_empty_series_is_a_version(spark, tmp_path):
    publish_version(series(spark, 0), str(tmp_path), ["country"])
    assert read_version(spark, str(tmp_path)).count() == 0 and read_in_order(spark, str(tmp_path)).count() == 0


# --- A3/F9 from footers -----------------------------------------------------------

def test_the_latest_week_comes_from_footers(spark, tmp_path):
    path = str(tmp_path / "weeks")
    weeks = spark.range(60).selectExpr("date_add(date'2024-01-01', int(id * 7)) AS epiweek", "id AS n",
                                       "year(date_add(date'2024-01-01', int(id * 7))) AS iso_year")
    write_parquet(weeks, path, ["iso_year"])
    assert "PushedAggregation: [MAX(epiweek)]" in footer_max(spark, path, "epiweek")._jdf.queryExecution().toString()
    assert latest_week(spark, path) == d("2025-02-17")
    out = read_before_latest_week(spark, path)
    assert out.count() == 59 and plan_of(out).count("FileScan") == 1 and "LessThan(epiweek" in plan_of(out)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_no_rows_have_no_latest_week(spark, tmp_path):
    write_parquet(spark.range(0).selectExpr("date'2024-01-01' AS epiweek", "id AS n"), str(tmp_path / "none"))
    assert latest_week(spark, str(tmp_path / "none")) is None
    assert read_before_latest_week(spark, str(tmp_path / "none")).count() == 0


# --- X13/X14: refreshed weeks -------------------------------------------------------

def reports(spark):
    e = spark.range(900).select(
        F.concat(F.lit("C"), F.col("id") % 3).alias("country"),
        F.expr("date_add(date'2023-11-01', int(id * 37 % 200))").alias("report_date"),
        F.when(F.col("id") % 10 > 0, F.col("id") % 50).alias("new_hospitalization"),
        F.lit(None).cast("bigint").alias("new_icu"), F.lit("X").alias("WHO_REGION"), F.lit("Y").alias("ISO_3_CODE"),
        F.col("id").alias("row_id"))
    return materialize(combine_sources([e.where("row_id < 500"), e.where("row_id >= 500")]))


def test_three_increments_equal_the_full_run(spark, tmp_path):
    merged = reports(spark)
    weekly = lambda r: current_weeks(r, row_id_col="row_id")
    store = SeriesStore(str(tmp_path / "store"), weekly)
    for batch in range(3):
        touched = refresh(store, batch, merged.where(F.col("row_id") % 3 == batch))
        assert touched.count() > 0
    assert rows(store.series(spark).select(*weekly(merged).columns)) == rows(weekly(merged))


def test_only_touched_years_are_rewritten_and_a_batch_can_run_again(spark, tmp_path):
    merged = reports(spark)
    weekly = lambda r: archived_weeks(r.withColumnRenamed("country", "country_name"))
    store = SeriesStore(str(tmp_path / "store"), weekly)
    refresh(store, 0, merged.where("report_date < '2024-02-01'"))
    files = lambda: sorted(os.path.join(p, f) for p, _, fs in os.walk(store.series_path) for f in fs if "iso_year=2023" in p)
    before = files()
    late = merged.where("report_date >= '2024-02-01'")
    refresh(store, 1, late)
    assert files() == before                              # 2023 was not touched
    refresh(store, 1, late)                               # the same batch again adds nothing
    assert rows(store.series(spark).select(*weekly(merged).columns)) == rows(weekly(merged))
    assert refresh(store, 2, merged.limit(0)).count() == 0


# --- Q1 by observed metrics ----------------------------------------------------------

SPEC = SourceSpec(name="feed", date=DateSpec("date", "leading"), measures=(MeasureSpec("n", ("v",)),), country="X",
                  plausible=("2024-01-01", "2024-12-31"))


def test_counts_come_from_the_one_scan_of_the_release(spark, tmp_path):
    path = str(tmp_path / "feed")
    spark.createDataFrame([("2024-05-01", "1"), ("2024-05-01", "2"), ("x", "3"), (None, "4"), ("2023-12-31", "5"),
                           ("2025-01-01", "6")], "date string, v string").write.parquet(path)
    feed = spark.read.parquet(path)
    tidy, counts = normalize_observed(feed, SPEC)
    assert plan_of(tidy).count("FileScan") == 1
    assert rows(tidy) == rows(normalize_source(feed, SPEC))
    found = {r["reason"]: r["n_rows"] for r in observed_counts(spark, {"feed": counts}).collect()}
    assert found == {"input": 6, "valid": 2, "unparsed": 1, "missing": 1, "before_min": 1, "after_max": 1}
    assert quarantined_rows(feed, SPEC).count() == found["input"] - found["valid"]
    with pytest.raises(ValueError):
        normalize_observed(feed, dataclasses.replace(SPEC, plausible=None))


def test_an_empty_feed_has_no_counts(spark):
    empty = spark.createDataFrame([], "day date, raw string")
    tagged, counts = observe_issues(tag_date_issues(empty, "day", "raw"), "none")
    assert tagged.count() == 0 and observed_counts(spark, {"none": counts}).count() == 0


# --- W1 by packed ranks ----------------------------------------------------------------

def test_top1_by_rank_equals_the_struct_form(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 50 > 0, F.col("id") % 97).alias("k"), (F.col("id") % 3).cast("string").alias("k2"),
        F.when(F.col("id") % 5 > 0, F.col("id") * 7919 % 13 - 6).alias("v"),
        F.when(F.col("id") % 7 > 0, (F.col("id") % 2).cast("int")).alias("src"),
        F.when(F.col("id") % 11 > 0, F.expr("date_add(date'1969-12-30', int(id % 9))")).alias("day"), "id")
    for value in ("v", "day", "src"):
        for descending in (True, False):
            a = top1_by_rank(df, ["k", "k2"], value, descending, ["src", "day", "id"])
            b = top1_per_group(df, ["k", "k2"], value, descending, ["src", "day", "id"])
            assert a.columns == b.columns and rows(a) == rows(b)


def test_extreme_values_and_fractions(spark):
    df = spark.createDataFrame([(1, 2 ** 63 - 1, 1.5, 1), (1, -2 ** 63, -2.5, 2), (1, None, None, 3), (2, None, None, 5),
                                (2, None, None, 4), (3, -2 ** 63, 0.0, 6), (3, None, 7.0, 7)],
                               "k int, v bigint, f double, id bigint")
    for value in ("v", "f"):
        for descending in (True, False):
            a, b = (f(df, ["k"], value, descending, ["id"]) for f in (top1_by_rank, top1_per_group))
            assert rows(a) == rows(b)
    with pytest.raises(TypeError):
        packed_ranks(df.selectExpr("k", "string(v) v", "id"), "v", True, ["id"])


def test_only_hash_aggregates(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id % 5 AS v", "id")
    plan = plan_of(top1_by_rank(df, ["k"], "v", tie_break=["id"]))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
