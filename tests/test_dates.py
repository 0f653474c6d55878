"""D1-D10 and week rules (FIXTURES C1 table, C4, C5, boundary rows of B)."""

import pytest
from pyspark.sql import functions as F

from conftest import d
from hebdo.functions import dates as D


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("2024-05-04T00:00:00.000", "2024-05-04"),
    ("2024/05/04", "2024-05-04"),
    ("2024-5-4", "2024-05-04"),
    ("  2024-05-04 12:00", "2024-05-04"),
    ("1/01/2023", None),          # R reads year 1 here; fail closed
    ("15/01/2023", None),
    ("2024-02-30", None),
    ("2024-05/04", None),
    ("garbage", None),
    (None, None),
])
def test_leading_date(spark, text, expected):
    assert one(spark, D.parse_date_leading(F.col("x")), text) == d(expected)


@pytest.mark.parametrize("text,fmts,expected", [
    ("05/04/2024", D.MONTH_FIRST_FORMATS, "2024-05-04"),
    ("5/4/2024", D.MONTH_FIRST_FORMATS, "2024-05-04"),
    ("15/01/2023", D.MONTH_FIRST_FORMATS, None),
    ("May 4, 2024", D.MONTH_FIRST_FORMATS, "2024-05-04"),
    ("31/12/2022", D.DAY_FIRST_FORMATS, "2022-12-31"),
    ("31.12.2022", D.DAY_FIRST_FORMATS, "2022-12-31"),
    ("2024-05-04T00:00:00.000", ("yyyy-MM-dd",), None),   # whole text must match
    ("garbage", D.MONTH_FIRST_FORMATS, None),
])
def test_format_parsers(spark, text, fmts, expected):
    assert one(spark, D.parse_date_formats(F.col("x"), fmts), text) == d(expected)


def test_pattern_shape_accepts_what_the_formatter_parses():
    import re
    cases = {"M/d/yyyy": ["5/4/2024", "05/04/2024"], "MMMM d, yyyy": ["May 4, 2024", "October 13, 1998"],
             "d.M.yyyy": ["31.12.2022"], "yyyy-MM-dd'T'HH": ["2024-05-04T10"]}
    for fmt, texts in cases.items():
        rx = re.compile(D.pattern_shape(fmt).replace(r"\p{L}", "[^\\W\\d_]"))
        for t in texts:
            assert rx.match(t), (fmt, t)


def test_epoch_ms(spark):
    assert one(spark, D.epoch_ms_to_date(F.col("x")), 1669075200000, "x long") == d("2022-11-22")
    assert one(spark, D.epoch_ms_to_date(F.col("x")), -1, "x long") == d("1969-12-31")


@pytest.mark.parametrize("day,monday", [("2024-12-29", "2024-12-23"), ("2024-12-30", "2024-12-30"),
                                        ("2025-01-05", "2024-12-30"), ("2025-01-06", "2025-01-06")])
def test_week_start_monday(spark, day, monday):
    assert one(spark, D.week_start(F.col("x")), d(day), "x date") == d(monday)


@pytest.mark.parametrize("epiweek,rule,year,week", [
    ("2024-12-30", "iso_week_cal_year", 2024, 1),
    ("2025-12-29", "iso_week_cal_year", 2025, 1),
    ("2024-12-30", "iso_week_end_year", 2025, 1),
    ("2019-12-30", "day_count_week", 2019, 52),
    ("2020-02-24", "day_count_week", 2020, 8),
    ("2020-02-24", "iso_week_cal_year", 2020, 9),
    ("2024-12-23", "day_count_week", 2024, 52),
    ("2024-12-30", "day_count_week", 2024, 53),
    ("2025-01-06", "iso_week_end_year", 2025, 2),
])
def test_week_rules(spark, epiweek, rule, year, week):
    y, w = D.week_numbers(F.col("x"), rule)
    r = spark.createDataFrame([(d(epiweek),)], "x date").select(y.alias("y"), w.alias("w")).first()
    assert (r["y"], r["w"]) == (year, week)


def test_unknown_week_rule():
    with pytest.raises(ValueError):
        D.week_numbers(F.col("x"), "weird")


@pytest.mark.parametrize("code,monday_week,iso", [
    ("202001", "2020-01-06", "2019-12-30"),
    ("202052", "2020-12-28", "2020-12-21"),
    ("202053", "2021-01-04", "2020-12-28"),    # D5 formula value; the feed drops week 53 before (F8)
    ("202101", "2021-01-04", "2021-01-04"),
    ("202153", "2022-01-03", None),           # 2021 has no ISO week 53
    ("202201", "2022-01-03", "2022-01-03"),
])
def test_week_codes(spark, code, monday_week, iso):
    c = F.col("x")
    r = spark.createDataFrame([(code,)], "x string").select(
        D.monday_of_monday_week(D.week_code_year(c), D.week_code_week(c)).alias("w"),
        D.monday_of_iso_week(D.week_code_year(c), D.week_code_week(c)).alias("i")).first()
    assert r["w"] == d(monday_week)
    assert r["i"] == d(iso)


def test_monday_week_matches_strptime_rule(spark):
    """D5 equals C's %Y%W%u for weekday 1 over 1990-2035, weeks 1-52 (brute force)."""
    import datetime as dt
    pairs = [(y, w) for y in range(1990, 2036) for w in range(1, 53)]
    df = spark.createDataFrame(pairs, "y int, w int").select(
        "y", "w", D.monday_of_monday_week(F.col("y"), F.col("w")).alias("m"))
    got = {(r["y"], r["w"]): r["m"] for r in df.collect()}
    for (y, w), m in got.items():
        assert m == dt.datetime.strptime(f"{y}{w:02d}1", "%Y%W%w").date()


def test_week_start_idempotent_and_monday(spark):
    import datetime as dt
    days = [(dt.date(2019, 12, 20) + dt.timedelta(days=i),) for i in range(800)]
    df = spark.createDataFrame(days, "x date").select(D.week_start(F.col("x")).alias("w"))
    got = df.select("w", D.week_start(F.col("w")).alias("ww"), F.dayofweek("w").alias("dow")).collect()
    assert all(r["w"] == r["ww"] and r["dow"] == 2 for r in got)        # Spark: 2 = Monday


def test_week_code_mondays(spark):
    codes = [(f"{y}{w:02d}",) for y in range(1995, 2031) for w in range(1, 54)]
    df = spark.createDataFrame(codes, "c string")
    c = F.col("c")
    out = df.select(D.monday_of_monday_week(D.week_code_year(c), D.week_code_week(c)).alias("a"),
                    D.monday_of_iso_week(D.week_code_year(c), D.week_code_week(c)).alias("b"))
    rows = out.collect()
    assert all(r["a"].weekday() == 0 for r in rows)
    assert all(r["b"] is None or r["b"].weekday() == 0 for r in rows)
    # ISO years with 53 weeks in 1995-2030: 1998 2004 2009 2015 2020 2026
    assert sum(r["b"] is None for r in rows) == 36 - 6


def test_optional_section_pattern_is_not_guarded(spark):
    assert D.pattern_shape("yyyy-MM-dd[ HH:mm]") is None
    got = spark.createDataFrame([("2024-05-04",), ("2024-05-04 10:30",)], "x string").select(
        D.parse_date_formats(F.col("x"), ("yyyy-MM-dd[ HH:mm]",)).alias("d")).collect()
    assert [r["d"] for r in got] == [d("2024-05-04"), d("2024-05-04")]


def test_case_insensitive_month_names(spark):
    assert one(spark, D.parse_month_first(F.col("x")), "may 4, 2024") == d("2024-05-04")
