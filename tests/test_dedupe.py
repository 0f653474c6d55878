"""W1 (FIXTURES C3) and a brute-force property check."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from hebdo.operators.dedupe import top1_per_group

C3 = [("a", 5, 2), ("a", 5, 1), ("a", None, 0), ("b", None, 2), ("b", None, 1), ("c", 0, 1), ("c", None, 2)]


def test_c3(spark):
    df = spark.createDataFrame(C3, "k string, v bigint, src_ord int")
    got = {r["k"]: (r["v"], r["src_ord"]) for r in top1_per_group(df, ["k"], "v", tie_break=["src_ord"]).collect()}
    assert got == {"a": (5, 1), "b": (None, 1), "c": (0, 1)}


def test_keeps_column_order_and_types(spark):
    df = spark.createDataFrame(C3, "k string, v bigint, src_ord int")
    out = top1_per_group(df, ["k"], "v", tie_break=["src_ord"])
    assert out.columns == df.columns and out.schema == df.schema


def test_descending_on_dates_and_doubles(spark):
    import datetime as dt
    df = spark.createDataFrame([("a", dt.date(2024, 1, 2), 1.5), ("a", dt.date(2024, 1, 9), -2.0)],
                               "k string, day date, x double")
    assert top1_per_group(df, ["k"], "day").first()["x"] == -2.0
    assert top1_per_group(df, ["k"], "x").first()["day"] == dt.date(2024, 1, 2)
    assert top1_per_group(df, ["k"], "x", descending=False).first()["x"] == -2.0


def test_partial_aggregate_plan(spark):
    df = spark.createDataFrame(C3, "k string, v bigint, src_ord int")
    plan = top1_per_group(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def brute(rows):
    best = {}
    for k, v, o in rows:
        key = (v is None, -(v if v is not None else 0), o)
        if k not in best or key < best[k][0]:
            best[k] = (key, (v, o))
    return {k: val for k, (_, val) in best.items()}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.one_of(st.none(), st.integers(-3, 3))), min_size=1, max_size=40))
def test_matches_brute_force(spark, data):
    rows = [(k, v, i) for i, (k, v) in enumerate(data)]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v bigint, ord int")
    got = {r["k"]: (r["v"], r["ord"]) for r in top1_per_group(df, ["k"], "v", tie_break=["ord"]).collect()}
    assert got == brute(rows)
