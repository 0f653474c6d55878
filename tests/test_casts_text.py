"""N2-N4, T1-T6, P3 (FIXTURES C6, C8)."""

import pytest
from pyspark.sql import functions as F

from hebdo.functions.casts import to_count, to_double, to_int_truncating, to_text
from hebdo.functions.names import clean_name, clean_names
from hebdo.functions.text import bytes_to_text, normalize_label, recode, trim_all


@pytest.mark.parametrize("text,dbl,integer", [
    ("12.7", 12.7, 12), ("abc", None, None), (" 5 ", 5.0, 5), ("1e20", 1e20, None),
    ("-3.9", -3.9, -3), (None, None, None)])
def test_safe_casts(spark, text, dbl, integer):
    r = spark.createDataFrame([(text,)], "x string").select(
        to_double("x").alias("d"), to_int_truncating("x").alias("i"), to_count("x").alias("c")).first()
    assert r["d"] == dbl and r["i"] == integer
    assert r["c"] == (None if integer is None else integer)


def test_to_text(spark):
    assert spark.range(1).select(to_text(F.lit(2324)).alias("t")).first()["t"] == "2324"


def test_trim_all_and_label(spark):
    r = spark.createDataFrame([("\t a \n",), ("  Week  ",)], "x string").select(
        trim_all("x").alias("t"), F.trim("x").alias("plain"), normalize_label("x").alias("n")).collect()
    assert r[0]["t"] == "a" and len(r[0]["plain"]) == 5
    assert r[1]["n"] == "week"


def test_recode_passthrough(spark):
    df = spark.createDataFrame([("CH",), ("DK",), (None,)], "c string")
    got = [r["r"] for r in df.select(recode("c", {"CH": "Switzerland"}).alias("r")).collect()]
    assert got == ["Switzerland", "DK", None]


def test_bytes_to_text(spark):
    df = spark.createDataFrame([(bytearray("Дата".encode()),)], "b binary")
    assert df.select(bytes_to_text("b").alias("t")).first()["t"] == "Дата"


@pytest.mark.parametrize("raw,clean", [
    ("Admissions for COVID-19 in the week ending", "admissions_for_covid_19_in_the_week_ending"),
    ("Variable Label", "variable_label"), ("Variable.Label", "variable_label"),
    ("newAdmissions", "new_admissions"), ("covidOccupiedMVBeds", "covid_occupied_mv_beds"),
    ("COVID_NEWICU", "covid_newicu"), ("Total Price (%)", "total_price_percent"),
    ("# Status", "number_status"), ("1st", "x1st"), ("", "x"), ("Dato", "dato")])
def test_clean_name(raw, clean):
    assert clean_name(raw) == clean


def test_clean_names_dedupes():
    assert clean_names(["A b", "a.b", "a_b"]) == ["a_b", "a_b_2", "a_b_3"]
