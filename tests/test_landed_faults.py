"""Landed files that are broken or odd: nothing may change a row count silently."""

import dataclasses
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from conftest import d
from hebdo import session
from hebdo.functions import dates as D
from hebdo.functions.names import clean_names
from hebdo.operators.combine import broadcast_if_small, provably_small
from hebdo.plans import national_feeds as NF
from hebdo.plans.normalize import normalize_measure_pair, normalize_source
from hebdo.plans.release import archived_weekly_series
from hebdo.sources.readers import (page_issues, read_array_records, read_geojson, read_good_pages, read_json_records,
                                   read_landed_payloads, read_pages)
from hebdo.sources.sinks import write_csv_file, write_single_csv
from pyspark.sql import functions as F

RECORD = T.StructType([T.StructField(n, T.StringType()) for n in ("state", "date")])
GOOD = json.dumps([{"state": "CA", "date": "2022-01-03"}, {"state": None, "date": "2022-01-04"}])
BAD = {"truncated": GOOD[:40], "empty": "", "wrong shape": json.dumps({"message": "rate limit", "error": True}),
       "no JSON": "<html>502</html>"}


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


@pytest.mark.parametrize("kind", sorted(BAD))
@pytest.mark.parametrize("reader", [read_pages, read_landed_payloads, read_json_records])
def test_bad_page_fails_with_its_name(spark, tmp_path, kind, reader):
    write(tmp_path / "p" / "page-1.json", GOOD)
    write(tmp_path / "p" / "page-2.json", BAD[kind])
    with pytest.raises(PySparkException, match="page-2"):
        reader(spark, str(tmp_path / "p"), RECORD).collect()
    with pytest.raises(PySparkException, match="page-2"):
        reader(spark, str(tmp_path / "p"), RECORD).count()


def test_bad_pages_as_an_output(spark, tmp_path):
    write(tmp_path / "p" / "page-0.json", GOOD)
    write(tmp_path / "p" / "page-9.json", "[]")
    for i, kind in enumerate(sorted(BAD)):
        write(tmp_path / "p" / f"bad-{i}.json", BAD[kind])
    found = page_issues(spark, str(tmp_path / "p"), RECORD).collect()
    assert sorted(r["page_file"].rsplit("/", 1)[1] for r in found) == [f"bad-{i}.json" for i in range(len(BAD))]
    assert all(r["page_issue"] for r in found)
    assert read_good_pages(spark, str(tmp_path / "p"), RECORD).count() == 2
    only_good = write(tmp_path / "q" / "page-0.json", GOOD)
    assert read_pages(spark, only_good, RECORD).count() == 2
    assert page_issues(spark, only_good, RECORD).count() == 0


def test_bad_geojson_and_array_files_fail(spark, tmp_path):
    props = T.StructType([T.StructField("Date", T.StringType())])
    for i, text in enumerate(['{"type": "FeatureCollection", "feat', "", '{"error": 1}', '{"type": "FeatureCollection"}']):
        p = write(tmp_path / f"g{i}.geojson", text)
        with pytest.raises(PySparkException, match=f"g{i}.geojson"):
            read_geojson(spark, p, props).collect()
    for i, text in enumerate(['[["a", "b"], ["1"', ""]):
        p = write(tmp_path / f"a{i}.json", text)
        with pytest.raises((PySparkException, ValueError), match=f"a{i}.json"):
            read_array_records(spark, p, ["a", "b"]).collect()


def test_geojson_numbers_in_any_form(spark, tmp_path):
    ms = 1669075200000
    features = [{"properties": {"Date": v, "SUM_no_new_admissions_covid19_p": n}} for v, n in
                ((ms, 30), (float(ms), 30.0), (str(ms), "30"))]
    hosp = write(tmp_path / "h.geojson", json.dumps({"type": "FeatureCollection", "features": features}))
    rows = normalize_source(read_geojson(spark, hosp, NF.IE_HOSP_PROPS), NF.IRELAND_ADMISSIONS).collect()
    assert [(r["report_date"], r["new_hospitalization"]) for r in rows] == [(d("2022-11-22"), 90)]


def test_measure_pair_uses_each_sides_aggregate_and_policy(spark):
    beds = dataclasses.replace(NF.UK_VENTILATED, null_policy="keep", constants=(("unit", "beds"),),
                               measures=(dataclasses.replace(NF.UK_VENTILATED.measures[0], aggregate="max"),))
    hosp = spark.createDataFrame([("UK", "2022-01-03", "5"), ("UK", "2022-01-03", "6")],
                                 "area_name string, date string, new_admissions string")
    icu = spark.createDataFrame([("UK", "2022-01-03", "7"), ("UK", "2022-01-03", "9"), ("UK", "2022-01-04", None)],
                                "area_name string, date string, covid_occupied_mv_beds string")
    got = {r["report_date"]: (r["new_hospitalization"], r["new_icu"], r["unit"])
           for r in normalize_measure_pair(hosp, NF.UK_ADMISSIONS, icu, beds).collect()}
    assert got == {d("2022-01-03"): (11, 9, "beds"), d("2022-01-04"): (0, None, "beds")}


def test_far_future_date_does_not_hide_the_latest_week(spark, tmp_path):
    p = write(tmp_path / "dk.csv", "Dato,Total\n2022-01-03,1\n2022-01-10,2\n2202-01-04,9\n2018-01-01,4\n,3\n")
    landed = NF.LandedFeeds(denmark=p)
    feeds = NF.archived_feeds(spark, landed, last_date="2022-12-31")
    kept = archived_weekly_series(feeds).collect()
    assert [(r["epiweek"], r["new_hospitalization"]) for r in kept] == [(d("2022-01-03"), 1)]
    bad = NF.rejected_from_files(spark, landed, "archived", last_date="2022-12-31").collect()
    assert sorted((r["raw_date"] or "", r["date_issue"], r["new_hospitalization"]) for r in bad) == [
        ("", "missing", 3), ("2018-01-01", "before_min", 4), ("2202-01-04", "after_max", 9)]


def test_command_line_writes_and_counts_rejects(spark, tmp_path, capsys):
    from hebdo.__main__ import main
    p = write(tmp_path / "dk.csv", "Dato,Total\n2022-01-03,1\n2022-01-10,2\n2202-01-04,9\nsoon,4\n")
    main(["archived", "--denmark", p, "--csv", str(tmp_path / "csv"), "--parquet", str(tmp_path / "pq"),
          "--quarantine", str(tmp_path / "bad")])
    assert capsys.readouterr().out.splitlines()[-2:] == ["rejected: 1 rows, after_max", "rejected: 1 rows, unparsed"]
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 1


def test_clean_names_are_unique():
    for names in (["A", "a", "a_2"], ["a_2", "A", "a"], ["x", "x", "x_2", "x_2", "X"], ["", "x", "%"]):
        out = clean_names(names)
        assert len(set(out)) == len(names)
    assert clean_names(["A", "a", "b"]) == ["a", "a_2", "b"]


def test_month_first_two_digit_years(spark):
    def one(text):
        return spark.range(1).select(D.parse_month_first(F.lit(text)).alias("x")).first()["x"]
    assert one("05/04/24") == one("5-4-24") == one("05/04/2024") == one("May 4, 2024") == d("2024-05-04")
    assert one("12/31/99") == d("1999-12-31") and one("1/1/68") == d("2068-01-01")
    assert one("2024-05-04") is None and one("13/40/24") is None


def test_csv_order_with_many_partitions(spark, tmp_path):
    df = spark.range(500).selectExpr("(id * 7919) % 500 AS k", "'x' AS v").repartition(16)
    write_single_csv(df, str(tmp_path / "one"), ["k"])
    text = next(p for p in (tmp_path / "one").iterdir() if p.name.endswith(".csv")).read_text().splitlines()
    assert text == ["k,v"] + [f"{i},x" for i in range(500)]
    target = tmp_path / "file.csv"
    for _ in range(2):
        write_csv_file(df, str(target), ["k"])
        assert target.read_text().splitlines() == text


def test_checkpoint_folder_needs_shared_storage_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_broadcast_bound_counts_bytes(spark):
    narrow = spark.range(50).selectExpr("cast(id as string) AS k")
    wide = spark.range(50).selectExpr("repeat('x', 100000) AS k")
    assert provably_small(narrow, 100) and not provably_small(wide, 100)
    assert not provably_small(narrow, 10)
    assert "broadcast" in broadcast_if_small(narrow, 100)._jdf.queryExecution().analyzed().toString().lower()
