"""S3 pages as a source, and the stream merged into the weekly series."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from hebdo.operators.rollup import weekly_rollup
from hebdo.sources.paged import FORMAT, PagedJson, landed_pages, page_gaps, pages_a_task
from hebdo.streaming import merge_stream as M

SCHEMA = "id bigint, name string, extra string"


def land(folder, pages):
    """pages: {offset: text of the answer}"""
    for offset, text in pages.items():
        (folder / f"offset={offset}").mkdir(parents=True)
        (folder / f"offset={offset}" / "page.json").write_text(text)
    return str(folder)


def answer(lo, hi):
    return json.dumps([{"id": i, "name": f"n{i}", "extra": {"a": i} if i % 2 else i, "more": 1} for i in range(lo, hi)])


def read(spark, path, limit=10):
    spark.dataSource.register(PagedJson)
    return spark.read.format(FORMAT).schema(SCHEMA).option("limit", limit).load(path)


def test_whole_answer(spark, tmp_path):
    lines = "\n".join(json.dumps({"id": i}) for i in range(10, 20)) + "\n"
    path = land(tmp_path, {0: answer(0, 10), 10: lines, 20: answer(20, 23)})
    (tmp_path / "notes.txt").write_text("x")
    out = read(spark, path)
    assert out.rdd.getNumPartitions() == 3                # one partition a page
    got = sorted(tuple(r) for r in out.collect())
    assert [r[0] for r in got] == list(range(23))
    assert got[0] == (0, "n0", "0") and got[1] == (1, "n1", '{"a": 1}') and got[10] == (10, None, None)
    assert [o for o, _ in landed_pages(path)] == [0, 10, 20]


def test_an_empty_page_ends_a_full_answer(spark, tmp_path):
    assert read(spark, land(tmp_path / "a", {0: answer(0, 10), 10: "[]"})).count() == 10
    assert read(spark, land(tmp_path / "b", {0: ""})).count() == 0


@pytest.mark.parametrize("pages,said", [
    ({0: answer(0, 10), 20: answer(20, 25)}, "no page for records 10 to 19"),
    ({10: answer(10, 12)}, "no page for records 0 to 9"),
    ({0: answer(0, 10), 5: answer(5, 9)}, "offset 5 overlaps"),
    ({0: answer(0, 9), 10: answer(10, 12)}, "offset 0: 9 records instead of 10"),
    ({0: answer(0, 11), 10: answer(10, 12)}, "offset 0: 11 records instead of 10"),
    ({0: answer(0, 10), 10: answer(10, 20)}, "last page is full"),
    ({0: answer(0, 10), 10: '{"message": "rate limit"'}, "offset 10"),
    ({0: '["id"]'}, "not an array of records"), ({}, "no pages")])
def test_incomplete_pages_fail(spark, tmp_path, pages, said):
    (tmp_path / "p").mkdir()
    with pytest.raises(PySparkException, match=said):
        read(spark, land(tmp_path / "p", pages)).collect()


def test_many_pages_are_read_in_runs(spark, tmp_path):
    pages = {o: answer(o, o + 10) for o in range(0, 2000, 10)} | {2000: answer(2000, 2003)}
    out = read(spark, land(tmp_path / "a", pages))
    assert out.rdd.getNumPartitions() <= 64               # 201 pages: a task's fixed cost is not paid for each
    assert sorted(r["id"] for r in out.collect()) == list(range(2003))
    pages[1230] = answer(1230, 1239)                      # a page inside a run
    with pytest.raises(PySparkException, match="offset 1230: 9 records instead of 10"):
        read(spark, land(tmp_path / "b", pages)).collect()


def test_large_pages_stay_apart():
    assert [pages_a_task(n, 10) for n in (1, 64, 65, 1000)] == [1, 1, 2, 16]
    assert pages_a_task(18_000, 2_000) == 32 and pages_a_task(18_000, 100_000) == 1


def test_gaps_in_words():
    assert page_gaps([0, 50, 100], 50) == [] and page_gaps([100, 0, 50], 50) == []
    assert len(page_gaps([0, 40, 200], 50)) == 2


# --- the merged stream ------------------------------------------------------------------

ROWS = "country string, report_date date, n bigint"


def land_reports(spark, folder, batches):
    """One file a batch, in the order of their names and times."""
    for i, batch in enumerate(batches):
        part = folder / f"b{i}"
        df = spark.createDataFrame([(c, t, n) for c, t, n in batch], "country string, t string, n bigint")
        df.select("country", F.to_date("t").alias("report_date"), "n").coalesce(1).write.parquet(str(part))
    return str(folder)


BATCHES = [[("a", "2024-01-01", 1), ("a", "2024-01-03", None), ("b", "2024-01-02", 5)],
           [("a", "2024-01-09", 2), ("a", "2024-01-01", 10), ("b", "2024-01-30", 1)],
           [("a", "2024-01-02", 100), ("a", "2024-01-31", 3), ("c", None, 4)],       # a closed week, no date
           [("b", "2024-02-01", 7), ("b", "2024-01-15", 50), ("d", "2024-01-24", 8)]]


def merged(spark, folder, tmp_path, name, **options):
    target = M.WeeklyMerge(str(tmp_path / name), ("country",), ("n",), **options)
    for i, _ in enumerate(BATCHES):
        M.merge_batch(target, spark.read.parquet(f"{folder}/b{i}"), i)
    return target


def batch_result(spark, folder, keep="true"):
    every = spark.read.option("recursiveFileLookup", True).parquet(folder).where("report_date is not null").where(keep)
    return rows(weekly_rollup(every, ["country"], "report_date", ["n"], reports_col="reports"))


def test_merged_batches_equal_the_batch_result(spark, tmp_path):
    folder = land_reports(spark, tmp_path / "in", BATCHES)
    target = merged(spark, folder, tmp_path, "out", allowed_weeks=100)
    assert rows(M.merged_series(spark, target)) == batch_result(spark, folder)
    assert [tuple(r) for r in M.late_rows(spark, target).collect()] == [("c", None, 4, 2)]


def test_late_rows_go_to_the_side_table(spark, tmp_path):
    folder = land_reports(spark, tmp_path / "in", BATCHES)
    target = merged(spark, folder, tmp_path, "out", allowed_weeks=2)
    late = sorted((r["country"], r["n"], r["batch"]) for r in M.late_rows(spark, target).collect())
    # after batch 1 the latest week is that of 29 January: weeks before that of 15 January are closed
    assert late == [("a", 100, 2), ("c", 4, 2)]
    assert rows(M.merged_series(spark, target)) == batch_result(spark, folder, "n is null or n <> 100")


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path, monkeypatch):
    folder = land_reports(spark, tmp_path / "in", BATCHES)
    target = merged(spark, folder, tmp_path, "out")
    before = rows(M.merged_series(spark, target))
    for i in (1, 3, 3):
        M.merge_batch(target, spark.read.parquet(f"{folder}/b{i}"), i)
    assert rows(M.merged_series(spark, target)) == before


def test_restart_after_a_failure_between_the_writes(spark, tmp_path, monkeypatch):
    folder = land_reports(spark, tmp_path / "in", BATCHES)
    want = merged(spark, folder, tmp_path, "direct")
    target = M.WeeklyMerge(str(tmp_path / "out"), ("country",), ("n",))

    def run():
        stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).option(
            "recursiveFileLookup", True).parquet(folder)
        query = M.start_weekly_merge(stream, target, str(tmp_path / "checkpoint"))
        query.awaitTermination()

    plain, calls = M.publish_weeks, []

    def failing(*args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("executor lost")
        plain(*args)
    monkeypatch.setattr(M, "publish_weeks", failing)
    with pytest.raises(Exception, match="executor lost"):
        run()
    assert rows(M.merged_series(spark, target)) != rows(M.merged_series(spark, want))
    run()
    assert rows(M.merged_series(spark, target)) == rows(M.merged_series(spark, want))
    assert rows(M.late_rows(spark, target)) == rows(M.late_rows(spark, want))
