"""Property tests against plain-Python brute force."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hebdo.functions.dates import parse_date_leading
from hebdo.operators.rollup import weekly_rollup

rows_strategy = st.lists(st.tuples(st.sampled_from(["A", "B", None]),
                                   st.dates(dt.date(2019, 12, 20), dt.date(2020, 2, 10)),
                                   st.one_of(st.none(), st.integers(0, 50))), min_size=1, max_size=60)


def brute_weekly(rows, policy):
    out = {}
    for country, day, v in rows:
        key = (country, day - dt.timedelta(days=day.weekday()))
        total, n = out.get(key, (None, 0))
        if v is not None:
            total = (total or 0) + v
        out[key] = (total, n + 1)
    if policy == "zero":
        out = {k: (t if t is not None else 0, n) for k, (t, n) in out.items()}
    return out


@settings(max_examples=12, deadline=None)
@given(rows_strategy, st.sampled_from(["keep", "zero"]))
def test_weekly_rollup_matches_brute_force(spark, rows, policy):
    df = spark.createDataFrame(rows, "country string, report_date date, h bigint")
    got = {(r["country"], r["epiweek"]): (r["h"], r["reports"]) for r in
           weekly_rollup(df, ["country"], "report_date", ["h"], policy, reports_col="reports").collect()}
    assert got == brute_weekly(rows, policy)


LEADING = re.compile(r"^\s*(\d{4})([-/])(\d{1,2})\2(\d{1,2})", re.ASCII)   # Java regex classes are ASCII


def brute_leading(text):
    m = LEADING.match(text)
    if not m:
        return None
    try:
        return dt.date(int(m.group(1)), int(m.group(3)), int(m.group(4)))
    except ValueError:
        return None


date_like = st.builds(lambda y, sep, m, d, tail, lead: f"{lead}{y}{sep}{m}{sep if sep != 'x' else '-'}{d}{tail}",
                      st.integers(1000, 2999).map(str),
                      st.sampled_from(["-", "/", "x"]),
                      st.integers(0, 13).map(lambda v: str(v).zfill(2) if v % 2 else str(v)),
                      st.integers(0, 32).map(str),
                      st.sampled_from(["", "T00:00:00.000", " 12:00", "Z", "7"]),
                      st.sampled_from(["", " ", "  "]))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(date_like, st.text(max_size=12)), min_size=1, max_size=40))
def test_leading_date_matches_brute_force(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r["d"] for r in df.select(parse_date_leading(F.col("x")).alias("d")).collect()]
    assert got == [brute_leading(t) for t in texts]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.dates(dt.date(1900, 1, 1), dt.date(2099, 12, 31)), min_size=1, max_size=30))
def test_guarded_formats_round_trip(spark, days):
    """Text that Spark writes with a shipped pattern is parsed back by the
    guarded parser: the shape guard never rejects a parsable text."""
    from hebdo.functions.dates import DAY_FIRST_FORMATS, MONTH_FIRST_FORMATS, parse_date_formats
    df = spark.createDataFrame([(x,) for x in days], "d date")
    for fmt in MONTH_FIRST_FORMATS + DAY_FIRST_FORMATS:
        back = df.select("d", parse_date_formats(F.date_format("d", fmt), (fmt,)).alias("p")).collect()
        if "yy" in fmt and "yyyy" not in fmt:        # two digits name one century only
            back = [r for r in back if 1969 <= r["d"].year <= 2068]
        assert all(r["p"] == r["d"] for r in back), fmt
