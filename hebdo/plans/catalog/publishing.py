"""Publishing: refreshed series, versions in order, weeks from footers, counts in the same pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.operators.combine import union_by_name
from hebdo.operators.dedupe import top1_by_rank
from hebdo.operators.quarantine import observed_counts
from hebdo.plans import feeds
from hebdo.plans import national_feeds as NF
from hebdo.plans.catalog.national import LAST_DATE, _canada, _denmark
from hebdo.plans.catalog.registry import ORACLE_SQL, register
from hebdo.plans.catalog.releases import CURRENT_SQL, archived_release_sources, archived_sql, current_release_sources
from hebdo.plans.catalog.rollups import EVENTS_WEEKLY, _events_weekly
from hebdo.plans.normalize import normalize_observed
from hebdo.plans.refresh import SeriesStore, refresh
from hebdo.plans.release import archived_weeks, combine_sources, current_weeks
from hebdo.session import materialize, remove_folder, scratch_folder
from hebdo.sources.footers import read_before_latest_week
from hebdo.sources.readers import read_csv
from hebdo.sources.sinks import write_parquet, write_single_csv
from hebdo.sources.versions import publish_version, read_in_order

INCREMENTS = 3


def _refreshed(spark: SparkSession, merged: DataFrame, weekly, row_key: list[str]) -> DataFrame:
    """The series after the rows of ``merged`` arrived in increments, dealt by hash."""
    root = scratch_folder(spark, "refreshed-series")
    store = SeriesStore(root, weekly)
    merged = materialize(merged)
    part = F.pmod(F.xxhash64(*row_key), F.lit(INCREMENTS))
    for n in range(INCREMENTS):
        refresh(store, n, merged.where(part == n))
    out = materialize(store.series(spark))
    remove_folder(spark, root)
    return out


@register("refreshed_current_release", CURRENT_SQL)
def refreshed_current_release(spark: SparkSession, d: str) -> DataFrame:
    """X14 from three increments of its report rows; equals the full run."""
    merged = combine_sources(current_release_sources(spark, d))
    return _refreshed(spark, merged, lambda rows: current_weeks(rows, row_id_col="row_id"),
                      ["country", "report_date", "src_ord", "row_id"])


@register("refreshed_archived_weeks", archived_sql().replace(
    "SELECT * FROM joined WHERE epiweek < (SELECT max(epiweek) FROM joined)",
    "SELECT country, iso_year, iso_week_number, epiweek, freq, freq_time, new_hospitalization, new_icu FROM named"))
def refreshed_archived_weeks(spark: SparkSession, d: str) -> DataFrame:
    """X13 up to its reference join, from three increments."""
    merged = combine_sources(archived_release_sources(spark, d))
    return _refreshed(spark, merged, archived_weeks, ["country_name", "report_date", "src_ord"])


@register("published_order", f"""
WITH {EVENTS_WEEKLY}
SELECT event_type, epiweek, new_hospitalization, reports,
       row_number() OVER (ORDER BY event_type, epiweek) AS position
FROM events_weekly""")
def published_order(spark: SparkSession, d: str) -> DataFrame:
    """The weekly series published as a version of several parts; the place of each row in it."""
    root = scratch_folder(spark, "published-series")
    publish_version(_events_weekly(spark, d), root, ["event_type", "epiweek"], part_rows=8)
    out = materialize(read_in_order(spark, root))
    remove_folder(spark, root)
    return out


@register("published_before_latest_week", ORACLE_SQL["drop_latest_week"])
def published_before_latest_week(spark: SparkSession, d: str) -> DataFrame:
    """A3/F9 on published files: the latest week comes from their footers."""
    path = scratch_folder(spark, "published-weeks")
    write_parquet(_events_weekly(spark, d), path)
    out = materialize(read_before_latest_week(spark, path))
    remove_folder(spark, path)
    return out


@register("observed_row_balance", ORACLE_SQL["release_row_balance"])
def observed_row_balance(spark: SparkSession, d: str) -> DataFrame:
    """Q1 in the same pass: the counts of ``release_row_balance``, taken while the tidy rows are made."""
    tables = [(df, NF.bounded(spec, LAST_DATE)) for df, spec in
              ((_denmark(spark, d), NF.DENMARK), (_canada(spark, d), NF.CANADA))]
    tidy, counts = [], {}
    for df, spec in tables:
        rows, counts[spec.name] = normalize_observed(df, spec)
        tidy.append(rows)
    materialize(union_by_name(tidy))
    return observed_counts(spark, counts)


@register("top1_by_rank", ORACLE_SQL["top1_per_group"])
def top1_by_rank_query(spark: SparkSession, d: str) -> DataFrame:
    """W1 by a hash aggregate over packed ranks and a semi join."""
    o = feeds.table(spark, d, "orders")
    k = F.col("o_orderkey")
    rows = o.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("report_date"),
                    feeds.null_when(k % 7 == 0, k % 10).alias("value"))
    return top1_by_rank(rows, ["o_custkey"], "value", tie_break=["o_orderkey"])


@register("published_csv", f"""
WITH {EVENTS_WEEKLY}
SELECT event_type, epiweek, CASE WHEN reports > 1 THEN new_hospitalization END AS new_hospitalization, reports
FROM events_weekly""")
def published_csv(spark: SparkSession, d: str) -> DataFrame:
    """The weekly series as one CSV file, read again with its types."""
    weekly = _events_weekly(spark, d).withColumn(
        "new_hospitalization", F.when(F.col("reports") > 1, F.col("new_hospitalization")))
    path = scratch_folder(spark, "published-csv")
    write_single_csv(weekly, path, ["event_type", "epiweek"])
    out = materialize(read_csv(spark, path, "event_type string, epiweek date, new_hospitalization bigint, reports bigint"))
    remove_folder(spark, path)
    return out
