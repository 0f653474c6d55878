"""T5 by a table of names that hold for a period."""

from conftest import d, rows
from hebdo.operators.recode import overlapping_periods, recode_by_table, unmapped_names

MAPPING = [("a", "A1", None, "2020-01-01"), ("a", "A2", "2020-01-01", "2021-01-01"), ("b", "B", None, None),
           ("c", "C1", "2020-01-01", None), ("c", "C2", "2020-06-01", "2020-07-01"), (None, "N", None, None),
           ("a", "A2", "2020-01-01", "2021-01-01")]
FACTS = [("a", "2019-12-31", 1), ("a", "2020-01-01", 2), ("a", "2021-01-01", 3), ("b", None, 4), ("c", "2020-06-15", 5),
         ("c", "2020-08-01", 6), ("c", None, 7), ("z", "2020-01-01", 8), (None, "2020-01-01", 9), ("a", "2020-01-01", 10)]


def tables(spark):
    mapping = spark.createDataFrame([(n, m, s and d(s), e and d(e)) for n, m, s, e in MAPPING],
                                    "name string, new_name string, valid_from date, valid_to date")
    facts = spark.createDataFrame([(c, t and d(t), i) for c, t, i in FACTS], "country string, day date, i int")
    return facts, mapping


def test_the_period_of_the_date_decides(spark):
    facts, mapping = tables(spark)
    out = recode_by_table(facts, mapping, "country", "day", mapped_col="mapped")
    assert out.columns == ["country", "day", "i", "mapped"]
    assert {r["i"]: (r["country"], r["mapped"]) for r in out.collect()} == {
        1: ("A1", True), 2: ("A2", True), 3: ("a", False), 4: ("B", True), 5: ("C2", True), 6: ("C1", True),
        7: ("c", False), 8: ("z", False), 9: (None, False), 10: ("A2", True)}
    kept = recode_by_table(facts, mapping, "country", "day", out_col="name")
    assert kept.columns == ["country", "day", "i", "name"] and kept.count() == len(FACTS)


def test_a_large_mapping_is_not_broadcast(spark, monkeypatch):
    from hebdo.operators import recode
    monkeypatch.setattr(recode, "provably_small", lambda df: False)
    facts, mapping = tables(spark)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        out = recode_by_table(facts, mapping, "country", "day")
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(str(r["country"]) for r in out.collect()) == sorted(
            ["A1", "A2", "a", "B", "C2", "C1", "c", "z", "None", "A2"])
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")


def test_unmapped_names_and_overlaps(spark):
    facts, mapping = tables(spark)
    got = {r["name"]: (r["n_rows"], r["first_date"], r["last_date"], r["known"])
           for r in unmapped_names(facts, mapping, "country", "day").collect()}
    day = d("2020-01-01")
    assert got == {"a": (1, d("2021-01-01"), d("2021-01-01"), True), "c": (1, None, None, True),
                   "z": (1, day, day, False), None: (1, day, day, False)}
    assert [tuple(r.values()) for r in rows(overlapping_periods(mapping))] == [("c", day, None, d("2020-06-01"))]


def test_empty_mapping(spark):
    facts, mapping = tables(spark)
    assert [r["country"] for r in recode_by_table(facts, mapping.limit(0), "country", "day").orderBy("i").collect()] == [
        c for c, _, _ in FACTS]
