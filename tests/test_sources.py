"""S1-S9 on files written by the tests."""

import json

from pyspark.sql import types as T

from conftest import d
from hebdo.sources.readers import (explode_features, flatten_structs, geojson_schema, read_array_records,
                                   read_csv, read_csv_text, read_geojson, read_json_records,
                                   read_landed_payloads, read_pages)
from hebdo.sources.sinks import write_csv_file, write_parquet, write_single_csv


def write(path, text, binary=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("utf-8") if not binary else text)
    return str(path)


def test_csv_text_cleans_names(spark, tmp_path):
    p = write(tmp_path / "nz.csv", "Variable Label,Admissions for COVID-19 in the week ending,Hospitalisations,ICU\n"
                                   "Sex,2024-05-04,3,1\nAge,2024-05-04,9,9\n")
    df = read_csv_text(spark, p)
    assert df.columns == ["variable_label", "admissions_for_covid_19_in_the_week_ending", "hospitalisations", "icu"]
    assert all(f.dataType == T.StringType() for f in df.schema.fields)
    assert df.count() == 2


def test_csv_explicit_schema(spark, tmp_path):
    p = write(tmp_path / "dk.csv", "Dato,Total\n2024-01-01,5\n2024-01-02,\n")
    df = read_csv(spark, p, "dato date, total long")
    assert [(r["dato"], r["total"]) for r in df.collect()] == [(d("2024-01-01"), 5), (d("2024-01-02"), None)]


def test_json_records_flatten(spark, tmp_path):
    recs = [{"a": 1, "b": {"c": "x", "d": {"e": 2}}}, {"a": 2, "b": {"c": "y", "d": {"e": None}}}]
    p = write(tmp_path / "r.json", json.dumps(recs))
    df = read_json_records(spark, p, "a long, b struct<c: string, d: struct<e: long>>", flatten=True)
    assert df.columns == ["a", "b.c", "b.d.e"]
    assert sorted(tuple(r) for r in df.collect()) == [(1, "x", 2), (2, "y", None)]
    assert flatten_structs(df, "_").columns == ["a", "b.c", "b.d.e"]


def test_pages_directory_keeps_every_page(spark, tmp_path):
    for i in range(3):
        write(tmp_path / "pages" / f"page-{i}.json", json.dumps([{"state": "CA", "n": str(i)}] * (i + 1)))
    df = read_pages(spark, str(tmp_path / "pages"), "state string, n string")
    assert df.count() == 6
    assert df.select("page_file").distinct().count() == 3


def test_landed_payloads(spark, tmp_path):
    write(tmp_path / "raw" / "p1.json", json.dumps([{"state": "PR", "date": "2022-01-03T00:00:00.000"}]))
    write(tmp_path / "raw" / "p2.json", json.dumps([{"state": "VI", "date": "2022-01-04T00:00:00.000"}]))
    df = read_landed_payloads(spark, str(tmp_path / "raw"), T.StructType([T.StructField("state", T.StringType()),
                                                                         T.StructField("date", T.StringType())]))
    assert sorted(r["state"] for r in df.collect()) == ["PR", "VI"]


def test_geojson(spark, tmp_path):
    fc = {"type": "FeatureCollection", "name": "hosp",
          "features": [{"type": "Feature", "properties": {"Date": 1669075200000, "n": 4}},
                       {"type": "Feature", "properties": {"Date": 1669161600000, "n": 6}}]}
    p = write(tmp_path / "ie.geojson", json.dumps(fc))
    props = T.StructType([T.StructField("Date", T.LongType()), T.StructField("n", T.LongType())])
    top = T.StructType([T.StructField("name", T.StringType())])
    df = read_geojson(spark, p, props, top)
    assert df.columns == ["name", "Date", "n"]
    assert sorted((r["name"], r["n"]) for r in df.collect()) == [("hosp", 4), ("hosp", 6)]
    dotted = read_geojson(spark, p, props, sep=".")
    assert dotted.columns == ["features.properties.Date", "features.properties.n"]


def test_explode_features_from_column(spark):
    from pyspark.sql import functions as F
    props = T.StructType([T.StructField("x", T.LongType())])
    doc = json.dumps({"type": "FeatureCollection", "features": [{"properties": {"x": 1}}, {"properties": {"x": 2}}]})
    df = spark.createDataFrame([("p", doc)], "page string, body string")
    parsed = df.select("page", F.from_json("body", geojson_schema(props)).alias("fc"))
    assert sorted(r["x"] for r in explode_features(parsed, "fc", keep=["page"]).collect()) == [1, 2]


def test_header_record_promotion(spark, tmp_path):
    recs = [["Дата", "Новохоспитализирани"], ["2022-01-03", "12"], ["2022-01-04", "7"]]
    p = write(tmp_path / "bg.json", json.dumps(recs, ensure_ascii=False))
    df = read_array_records(spark, p, ["Дата", "Новохоспитализирани"])
    assert sorted(tuple(r) for r in df.collect()) == [("2022-01-03", "12"), ("2022-01-04", "7")]


def test_single_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("NZ", d("2024-04-29"), 369, None), ("NZ", d("2020-01-20"), 1, 0)],
                               "country string, epiweek date, new_hospitalization int, new_icu int")
    out = tmp_path / "out"
    write_single_csv(df, str(out), ["epiweek", "country"])
    files = [f for f in out.iterdir() if f.name.endswith(".csv")]
    assert len(files) == 1
    assert files[0].read_text() == ("country,epiweek,new_hospitalization,new_icu\n"
                                    "NZ,2020-01-20,1,0\nNZ,2024-04-29,369,\n")
    write_parquet(df.withColumn("iso_year", df.epiweek.substr(1, 4)), str(tmp_path / "pq"), ["iso_year"])
    assert sorted(p.name for p in (tmp_path / "pq").iterdir() if p.name.startswith("iso_year")) == [
        "iso_year=2020", "iso_year=2024"]


def test_named_csv_file(spark, tmp_path):
    df = spark.createDataFrame([("NZ", d("2024-04-29"), 369, None), ("NZ", d("2020-01-20"), 1, 0)],
                               "country string, epiweek date, new_hospitalization int, new_icu int")
    target = tmp_path / "clean" / "historical_clean_data.csv"
    write_csv_file(df, str(target), ["epiweek", "country"])
    write_csv_file(df, str(target), ["epiweek", "country"])          # overwrite in place
    assert target.is_file()
    assert target.read_text() == ("country,epiweek,new_hospitalization,new_icu\n"
                                  "NZ,2020-01-20,1,0\nNZ,2024-04-29,369,\n")
    assert sorted(p.name for p in (tmp_path / "clean").iterdir() if not p.name.startswith(".")) == [
        "historical_clean_data.csv"]
