"""Snapshot comparison."""

import datetime as dt
from collections import Counter

import pytest

from conftest import d, rows
from hebdo.plans.snapshots import compare_snapshots, revision_summary

# Weekly admissions of one sentinel series, weeks from 2024-04-29 to 2025-02-03, as first
# published and as published again.
FIRST = [370, 378, 419, 446, 528, 551, 627, 708, 888, 1017, 1107, 1128, 1396, 1472, 1622, 1595, 1484, 1398, 1357, 1457,
         1261, 1112, 1018, 882, 714, 726, 623, 597, 573, 587, 608, 729, 815, 928, 1200, 1433, 1232, 1081, 983, 953, 613]
AGAIN = [369, 383, 424, 444, 531, 554, 628, 708, 885, 1020, 1101, 1127, 1389, 1480, 1627, 1596, 1476, 1402, 1368, 1461,
         1275, 1121, 1028, 883, 724, 734, 621, 609, 573, 587, 617, 738, 815, 934, 1209, 1462, 1262, 1104, 1032, 1022, 977]


def series(spark, values, first=dt.date(2024, 4, 29)):
    return spark.createDataFrame([("US", first + dt.timedelta(7 * i), v, None) for i, v in enumerate(values)],
                                 "country string, epiweek date, new_hospitalization bigint, new_icu bigint")


def test_the_published_series(spark):
    out = compare_snapshots(series(spark, FIRST), series(spark, AGAIN))
    classes = Counter(r["class_new_hospitalization"] for r in out.collect())
    assert classes == {"equal": 4, "up": 29, "down": 8}
    assert {r["class_new_icu"] for r in out.collect()} == {"equal"}
    total = {r["class"]: (r["n_keys"], r["total_change"]) for r in
             revision_summary(out, ["new_hospitalization"]).collect()}
    assert total["equal"] == (4, 0.0) and sum(n for n, _ in total.values()) == 41
    assert sum(c for _, c in total.values()) == sum(AGAIN) - sum(FIRST)


def test_every_class(spark):
    schema = "country string, epiweek date, new_hospitalization bigint, new_icu bigint, status string"
    day = d("2024-01-01")
    old = spark.createDataFrame([("a", day, 1, None, "p"), ("b", day, 2, 2, "p"), (None, day, 3, 3, None),
                                 ("gone", day, 1, 1, "p"), ("twice", day, 1, 1, "p"), ("twice", day, 2, 1, "p"),
                                 ("e", None, None, None, "p")], schema)
    new = spark.createDataFrame([("a", day, 1, 5, "f"), ("b", day, 1, None, "p"), (None, day, 3, 4, "x"),
                                 ("new", day, 1, 1, "p"), ("twice", day, 1, 1, "p"), ("e", None, None, None, "p")], schema)
    out = {r["country"]: r for r in compare_snapshots(old, new, fields=["new_hospitalization", "new_icu", "status"]).collect()}
    assert {k: r["revision"] for k, r in out.items()} == {
        "a": "revised", "b": "revised", None: "revised", "gone": "removed", "new": "added", "twice": "repeated", "e": "equal"}
    fields = ("class_new_hospitalization", "class_new_icu", "class_status")
    assert [out["a"][f] for f in fields] == ["equal", "filled", "changed"]
    assert [out["b"][f] for f in fields] == ["down", "cleared", "equal"]
    assert [out[None][f] for f in fields] == ["equal", "up", "filled"]
    assert [out["twice"][f] for f in ("n_old", "n_new", "old_new_icu", "new_new_icu", "class_new_icu")] == [2, 1, None, 1, None]
    assert out["gone"]["old_new_icu"] == 1 and out["gone"]["change_new_icu"] is None
    counts = rows(revision_summary(compare_snapshots(old, new), by=["country"]).where("country = 'gone'"))
    assert [(r["field"], r["class"], r["n_keys"], r["total_change"]) for r in counts] == [
        ("new_hospitalization", "removed", 1, None), ("new_icu", "removed", 1, None)]


def test_types_must_agree(spark):
    other = series(spark, FIRST).selectExpr("country", "epiweek", "new_hospitalization", "string(new_icu) AS new_icu")
    with pytest.raises(TypeError):
        compare_snapshots(series(spark, FIRST), other)


def test_empty_snapshots(spark):
    empty = series(spark, [])
    assert compare_snapshots(empty, empty).count() == 0
    assert {r["revision"] for r in compare_snapshots(empty, series(spark, FIRST)).collect()} == {"added"}
