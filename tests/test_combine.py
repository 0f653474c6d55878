"""J1, J2a, J2b, J3, J4, U2 (FIXTURES C2, C7, C8) and brute-force checks."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from conftest import d
from hebdo.operators.combine import (enrich, full_join_on_values, join_facts_to_dimension, merge_side_totals,
                                     outer_merge_measures, paged_full_join_on_values, union_by_name)


def pairs_full_join(left, right, key_len):
    """Brute-force NULL-safe full outer join of row tuples on the first key_len fields."""
    out, matched_r = [], set()
    for l in left:
        hits = [j for j, r in enumerate(right) if r[:key_len] == l[:key_len]]
        if hits:
            for j in hits:
                matched_r.add(j)
                out.append((l, right[j]))
        else:
            out.append((l, None))
    out += [(None, r) for j, r in enumerate(right) if j not in matched_r]
    return out


def test_c7_nullsafe_full_join_counts(spark):
    left = [("d1", 5), ("d1", 5), ("d2", None)]
    right = [("d1", 5), ("d1", 5), ("d2", None), ("d3", 1)]
    L = spark.createDataFrame(left, "day string, v bigint")
    R = spark.createDataFrame(right, "day string, v bigint")
    got = full_join_on_values(L, R, ["day", "v"]).agg(F.sum("n_rows")).first()[0]
    assert got == len(pairs_full_join(left, right, 2)) == 6
    assert union_by_name(L, R).count() == 7


def test_j2a_multiplicities(spark):
    for a, b, expected in [(1, 1, 1), (2, 2, 4), (3, 2, 6), (2, 0, 2), (0, 3, 3)]:
        L = spark.createDataFrame([("x", 1)] * a + [("y", 9)], "k string, v int")
        R = spark.createDataFrame([("x", 1)] * b + [("z", 9)], "k string, v int")
        got = {r["k"]: r["n_rows"] for r in full_join_on_values(L, R, ["k", "v"]).collect()}
        assert got.get("x", 0) == expected


def test_c2_pages(spark):
    """Normalised pages of C2: J2a daily sum 12 on 2022-01-03, J2b gives 18."""
    p1 = spark.createDataFrame([(d("2022-01-03"), 6), (d("2022-01-03"), 6), (d("2022-01-04"), 0)], "day date, h bigint")
    p2 = spark.createDataFrame([(d("2022-01-03"), 6), (d("2022-01-04"), None)], "day date, h bigint")
    j2a = full_join_on_values(p1, p2, ["day", "h"])
    assert j2a.agg(F.sum("n_rows")).first()[0] == 4
    daily = (j2a.filter(F.col("h") != 0).groupBy("day").agg(F.sum(F.col("h") * F.col("n_rows")).alias("h")))
    assert {r["day"]: r["h"] for r in daily.collect()} == {d("2022-01-03"): 12}
    union = union_by_name(p1, p2)
    assert union.count() == 5
    u = union.filter(F.col("h") != 0).groupBy("day").agg(F.sum("h").alias("h"))
    assert {r["day"]: r["h"] for r in u.collect()} == {d("2022-01-03"): 18}


def test_outer_merge_matches_join_then_sum(spark):
    rnd = random.Random(7)
    keys = [("A", 1), ("A", 2), (None, 1), ("B", None)]
    left = [(*rnd.choice(keys), rnd.choice([None, 1, 2, 5])) for _ in range(30)]
    right = [(*rnd.choice(keys), rnd.choice([None, 0, 3])) for _ in range(25)]
    L = spark.createDataFrame(left, "c string, day int, h bigint")
    R = spark.createDataFrame(right, "c string, day int, i bigint")
    got = {(r["c"], r["day"]): (r["h"], r["i"]) for r in outer_merge_measures(L, R, ["c", "day"]).collect()}
    expected = {}
    for l, r in pairs_full_join(left, right, 2):
        key = (l or r)[:2]
        h, i = expected.get(key, (0, 0))
        expected[key] = (h + ((l[2] or 0) if l else 0), i + ((r[2] or 0) if r else 0))
    assert got == expected


def test_outer_merge_keep_nulls(spark):
    L = spark.createDataFrame([("A", 1, None)], "c string, day int, h bigint")
    R = spark.createDataFrame([("A", 1, 4)], "c string, day int, i bigint")
    r = outer_merge_measures(L, R, ["c", "day"], null_policy="keep").first()
    assert r["h"] is None and r["i"] == 4


def test_union_sources_fill_missing(spark):
    a = spark.createDataFrame([("A", 1, 2)], "c string, h bigint, i bigint")
    b = spark.createDataFrame([("B", 3)], "c string, h bigint")
    u = union_by_name(a, b)
    assert u.schema["i"].dataType.simpleString() == "bigint"
    assert sorted((r["c"], r["i"]) for r in u.collect()) == [("A", 2), ("B", None)]


def test_c8_enrich(spark):
    df = spark.createDataFrame([("CH", 1), ("DK", 2), (None, 3)], "country string, h int")
    ref_dupes = spark.createDataFrame([("CH", "EURO"), ("CH", "EURO"), (None, "NONE")], "country string, region string")
    out = enrich(df, ref_dupes, "country")
    assert sorted((r["h"], r["region"]) for r in out.collect()) == [(1, "EURO"), (2, None), (3, "NONE")]
    ref_two = spark.createDataFrame([("CH", "EURO"), ("CH", "OTHER")], "country string, region string")
    assert enrich(df, ref_two, "country").count() == 4
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan


def test_enrich_falls_back_to_shuffle_join_when_large(spark):
    df = spark.range(50).select(F.col("id").alias("k"))
    ref = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = enrich(df, ref, "k", max_broadcast_rows=10)
    assert out.count() == 50
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().sparkPlan().toString()


def test_full_join_counts_property(spark):
    rnd = random.Random(3)
    for _ in range(3):
        left = [(rnd.choice(["d1", "d2", None]), rnd.choice([0, 1, None])) for _ in range(rnd.randint(0, 12))]
        right = [(rnd.choice(["d1", "d3", None]), rnd.choice([0, 1, None])) for _ in range(rnd.randint(1, 12))]
        L = spark.createDataFrame(left or [("x", 0)], "day string, v int")
        R = spark.createDataFrame(right, "day string, v int")
        if not left:
            L = L.limit(0)
        got = full_join_on_values(L, R, ["day", "v"]).agg(F.sum("n_rows")).first()[0] or 0
        assert got == len(pairs_full_join(left, right, 2))
        # J2a count = sum of a*b over shared keys + unmatched rows
        assert got == sum(1 for _ in itertools.chain(pairs_full_join(left, right, 2)))


def test_outer_merge_pre_aggregated_equals_raw(spark):
    rnd = random.Random(11)
    left = [(rnd.choice(["A", "B"]), rnd.choice([1, 2]), rnd.randint(0, 3), rnd.choice([None, 1, 4])) for _ in range(40)]
    right = [(rnd.choice(["A", "C"]), rnd.choice([1, 2]), rnd.randint(0, 3), rnd.choice([None, 2])) for _ in range(30)]
    L = spark.createDataFrame(left, "c string, day int, cust int, h bigint")
    R = spark.createDataFrame(right, "c string, day int, cust int, i bigint")
    raw = outer_merge_measures(L.drop("cust"), R.drop("cust"), ["c", "day"])
    Lp = L.groupBy("c", "day", "cust").agg(F.sum("h").alias("h"), F.count(F.lit(1)).alias("n")).drop("cust")
    Rp = R.groupBy("c", "day", "cust").agg(F.sum("i").alias("i"), F.count(F.lit(1)).alias("n")).drop("cust")
    pre = outer_merge_measures(Lp, Rp, ["c", "day"], left_rows="n", right_rows="n")
    key = lambda r: (r["c"], r["day"], r["h"], r["i"])
    assert sorted(map(key, raw.collect())) == sorted(map(key, pre.collect()))


@pytest.mark.parametrize("n_pages", [1, 2, 3, 11])
def test_paged_full_join_equals_chained_joins(spark, n_pages):
    rnd = random.Random(5)
    rows = [(rnd.randrange(n_pages), rnd.choice(["d1", "d2", None]), rnd.choice([0, 1, None])) for _ in range(60)]
    df = spark.createDataFrame(rows, "page int, day string, v int")
    got = {(r["day"], r["v"]): r["n_rows"] for r in paged_full_join_on_values(df, ["day", "v"], "page").collect()}
    joined = [r[1:] for r in rows if r[0] == 0]
    for p in range(1, n_pages):
        joined = [a or b for a, b in pairs_full_join(joined, [r[1:] for r in rows if r[0] == p], 2)]
    want = {}
    for key in joined:
        want[key[:2]] = want.get(key[:2], 0) + 1
    assert got == want
    if n_pages == 2:
        two = full_join_on_values(df.filter("page = 0").drop("page"), df.filter("page = 1").drop("page"), ["day", "v"])
        assert got == {(r["day"], r["v"]): r["n_rows"] for r in two.collect()}


def test_merge_side_totals_one_pass(spark):
    rnd = random.Random(13)
    rows = [(rnd.choice(["A", "B", None]), rnd.choice([1, 2]), rnd.randint(0, 4), rnd.choice(["L", "R"]),
             rnd.choice([None, 1, 3])) for _ in range(80)]
    df = spark.createDataFrame(rows, "c string, day int, cust int, side string, v bigint")
    raw = outer_merge_measures(df.filter("side = 'L'").select("c", "day", F.col("v").alias("h")),
                               df.filter("side = 'R'").select("c", "day", F.col("v").alias("i")), ["c", "day"])
    is_left = F.col("side") == "L"
    totals = df.groupBy("c", "day", "cust").agg(
        F.sum(F.when(is_left, F.col("v"))).alias("h"), F.count_if(is_left).alias("nl"),
        F.sum(F.when(~is_left, F.col("v"))).alias("i"), F.count_if(~is_left).alias("nr"))
    one = merge_side_totals(totals, ["c", "day"], ["h"], ["i"], "nl", "nr")
    key = lambda r: (r["c"], r["day"], r["h"], r["i"])
    assert sorted(map(key, raw.collect()), key=str) == sorted(map(key, one.collect()), key=str)


def test_join_facts_to_dimension_both_paths(spark):
    rnd = random.Random(17)
    facts = spark.createDataFrame([(rnd.randint(0, 9), rnd.randint(1, 3), rnd.choice([None, 1, 2]))
                                   for _ in range(200)], "cust int, day int, v bigint")
    dim = spark.createDataFrame([(c, f"N{c % 3}") for c in range(9)], "ckey int, nation string")
    results = []
    for max_rows in (100, 0):          # broadcast path, then pre-aggregate + shuffle path
        j = join_facts_to_dimension(facts, dim, "cust", "ckey", ["cust", "day"], ["v"], max_broadcast_rows=max_rows)
        agg = j.groupBy("nation", "day").agg(F.sum("v").alias("v"))
        results.append(sorted((r["nation"], r["day"], r["v"]) for r in agg.collect()))
        plan = j._jdf.queryExecution().sparkPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (max_rows > 0)
    assert results[0] == results[1]


def test_enrich_rejects_clashing_columns(spark):
    import pytest
    df = spark.createDataFrame([("CH", 1)], "country string, h int")
    ref = spark.createDataFrame([("CH", 2)], "country string, h int")
    with pytest.raises(ValueError):
        enrich(df, ref, "country")
