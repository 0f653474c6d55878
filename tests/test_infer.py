"""Types inferred from text."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from conftest import d, rows
from hebdo.functions.dates import parse_date_formats
from hebdo.functions.text import trim_all
from hebdo.operators.infer import (DATE_LAYOUTS, ColumnType, candidates, present, apply_types, collect_types, decide_types, infer_types, merge_type_states,
                                   read_csv_inferred, read_json_inferred, rejected_values, type_state)


def inferred(spark, values, **options):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    r = infer_types(df, **options).first()
    return r["type"], r["format"], r["n_missing"], r["n_rejected"]


@pytest.mark.parametrize("values,kind", [
    (["1", " -2 ", "+30"], "int"), (["1", "2147483648"], "bigint"), (["1", "2147483647"], "int"),
    (["1", "9223372036854775808"], "double"), (["1", "2.5", ".5", "3.", "1e-3"], "double"), (["1", "1 000"], "string"),
    (["T", "F", "true"], "boolean"), (["T", "1"], "string"), (["007", "12"], "int"), (["12.5.1"], "string"),
    (["2024-05-04T00:00:00.000", "2024-05-04 10:11:12Z"], "timestamp_ntz"), (["2024-05-04T25:00:00"], "string"),
    (["0x1F"], "string"), (["1d"], "string"), (["NaN"], "string"), (["-"], "string")])
def test_lattice(spark, values, kind):
    assert inferred(spark, [*values, None, "", "NA"]) == (kind, "ISO 8601" if kind == "timestamp_ntz" else None, 3, 0)


@pytest.mark.parametrize("values,layout", [
    (["2024-5-4", "2024-12-31"], "yyyy-M-d"), (["2024/05/04"], "yyyy/M/d"), (["05/04/2024", "12/31/2024"], "M/d/yyyy"),
    (["31/12/2024", "01/02/2024"], "d/M/yyyy"), (["31.12.2024"], "d.M.yyyy")])
def test_date_layouts(spark, values, layout):
    assert inferred(spark, values) == ("date", layout, 0, 0)


def test_mixed_layouts_and_impossible_days_are_text(spark):
    assert inferred(spark, ["2024-01-01", "01/02/2024"])[0] == "string"
    assert inferred(spark, ["2024-02-30", "2024-01-01"])[0] == "string"


def test_ambiguous_day_and_month(spark):
    df = spark.createDataFrame([("01/02/2024", "13/02/2024")], "a string, b string")
    assert [(r["format"], r["ambiguous"]) for r in infer_types(df).orderBy("position").collect()] == [
        ("M/d/yyyy", True), ("d/M/yyyy", False)]


def test_nothing_but_missing_values_is_boolean(spark):
    assert inferred(spark, [None, "", "NA"]) == ("boolean", None, 3, 0)
    empty = spark.createDataFrame([], "x string")
    assert infer_types(empty).count() == 0


def test_tolerance_takes_the_type_with_the_fewest_rejects(spark):
    values = ["1"] * 97 + ["1.5", "n/a", "n/a"]
    assert inferred(spark, values)[0] == "string"
    assert inferred(spark, values, tolerance=0.02) == ("double", None, 0, 2)
    assert inferred(spark, values, tolerance=0.019) == ("string", None, 0, 0)


def test_states_merge_in_any_split(spark):
    df = spark.createDataFrame([(str(i), f"2024-01-{i % 28 + 1:02d}" if i != 77 else "x", i % 3) for i in range(100)],
                               "n string, day string, part int")
    whole = infer_types(df.drop("part"), 0.05)
    merged = decide_types(merge_type_states(type_state(df, by=["part"]).drop("part")), 0.05)
    # a file whose columns come in another order, and one that lacks a column
    a = type_state(df.where("part = 0").select("day", "n"))
    b = type_state(df.where("part > 0").select("n"))
    c = type_state(df.where("part > 0").select("day"))
    again = decide_types(merge_type_states(a.unionByName(b).unionByName(c)), 0.05)
    assert rows(whole) == rows(merged)
    assert rows(whole.drop("position")) == rows(again.drop("position"))


def test_typed_rows_and_rejects(spark):
    df = spark.createDataFrame([("1", "T", "05/04/2024", "x y"), ("oops", "NA", "13/40/2024", " z "), ("oops", "F", "", None)],
                               "n string, `f.l` string, day string, text string")
    types = [ColumnType("n", "int"), ColumnType("f.l", "boolean"), ColumnType("day", "date", "M/d/yyyy"),
             ColumnType("text", "string")]
    out = apply_types(df, types)
    assert [tuple(r) for r in out.collect()] == [(1, True, d("2024-05-04"), "x y"), (None, None, None, " z "),
                                                 (None, False, None, None)]
    assert sorted(tuple(r) for r in rejected_values(df, types).collect()) == [("day", "13/40/2024", 1), ("n", "oops", 2)]
    assert rejected_values(df.select("text"), types[3:]).count() == 0


def test_csv_and_json_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Report Date,Count (new),Flag\n2024-05-04,3,T\n2024-05-11,NA,F\n")
    df, types = read_csv_inferred(spark, str(tmp_path / "a.csv"))
    assert types == [ColumnType("report_date", "date", "yyyy-M-d"), ColumnType("count_new", "int"),
                     ColumnType("flag", "boolean")]
    assert [tuple(r) for r in df.collect()] == [(d("2024-05-04"), 3, True), (d("2024-05-11"), None, False)]
    (tmp_path / "b.json").write_text(json.dumps([{"n": 1, "o": {"p": "2.5"}}, {"n": "3000000000", "o": {"p": None}}]))
    df, types = read_json_inferred(spark, str(tmp_path / "b.json"))
    assert types == [ColumnType("n", "bigint"), ColumnType("o.p", "double")]
    assert sorted(tuple(r) for r in df.collect()) == [(1, 2.5), (3000000000, None)]


def test_one_hash_aggregate_without_python(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    plan = infer_types(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Python" not in plan
    assert collect_types(infer_types(df)) == [ColumnType("a", "int"), ColumnType("b", "int")]


def test_dates_are_read_as_the_formatter_reads_them(spark):
    """Days of another layout never reach the formatter, whose failures are exceptions; the values stay its own."""
    fields = ("0", "1", "02", "12", "13", "29", "30", "31", "32", "002", "2023", "2024", "0000", "12345", "+12024", "-2024", "")
    texts = [sep.join(t) for sep in "-/." for t in itertools.product(fields, repeat=3)]
    texts += [" 1/2/2024", "1/2/2024\u0085", "\t2024-1-2\n", "1/2-2024", "1/2/2024x", "\x1c1/2/2024", "1.2", "é", "", "NA", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string").repartition(4)
    trimmed = F.when(~trim_all("x").isin("", "NA"), trim_all("x"))
    both = df.select(trimmed.alias("before"), present("x").alias("now"))
    assert both.where(~F.col("before").eqNullSafe(F.col("now"))).count() == 0
    dates = [c for c in candidates((*DATE_LAYOUTS, "yyyy.M.d", "MM/dd/yyyy")) if c.kind == "date"]
    differ = [F.count_if(~parse_date_formats("before", (c.layout,)).eqNullSafe(c.read(F.col("now")))) for c in dates]
    fits = [F.count(c.read(F.col("now"))) for c in dates]
    assert list(both.agg(*differ).first()) == [0] * len(dates)
    assert min(both.agg(*fits).first()) > 10


def test_texts_are_trimmed_once_and_code_is_compiled_in_parts(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(limit)
    df = spark.createDataFrame([("1/2/2024",)], "x string")
    out = apply_types(df, [ColumnType("x", "date", "M/d/yyyy")])
    assert int(spark.conf.get(limit)) <= 8000
    assert type_state(df)._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") <= 2
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") <= 2
