"""Q1: valid + quarantined = input; reasons."""

from conftest import d
from hebdo.operators.quarantine import date_issue_counts, split_plausible, tag_date_issues


def test_split(spark):
    df = spark.createDataFrame([("0001-01-20", d("0001-01-20")), ("2024-05-04", d("2024-05-04")),
                                ("junk", None), (None, None), ("2031-01-01", d("2031-01-01"))],
                               "raw string, day date")
    valid, bad = split_plausible(df, "day", raw_col="raw", min_date="2019-01-01", max_date="2030-12-31")
    assert [r["raw"] for r in valid.collect()] == ["2024-05-04"]
    assert "date_issue" not in valid.columns
    assert sorted(r["date_issue"] for r in bad.collect()) == ["after_max", "before_min", "missing", "unparsed"]
    counts = {r["date_issue"]: r["n_rows"] for r in
              date_issue_counts(tag_date_issues(df, "day", "raw", "2019-01-01", "2030-12-31")).collect()}
    assert sum(counts.values()) == df.count() and counts[None] == 1


def test_write_both_sides_in_one_pass(spark, tmp_path):
    from hebdo.sources.sinks import write_partitioned_by
    df = spark.createDataFrame([(d("0001-01-20"),), (d("2024-05-04"),)], "day date")
    tagged = tag_date_issues(df, "day", min_date="2019-01-01")
    write_partitioned_by(tagged, str(tmp_path / "split"), "date_issue")
    back = spark.read.parquet(str(tmp_path / "split"))
    assert sorted((r["date_issue"] or "") for r in back.collect()) == ["", "before_min"]
