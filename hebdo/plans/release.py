"""Merging normalised feeds and finalising the weekly series.

Two finalisations exist and both are kept:

* ``current_weekly_series`` (X14): feeds already carry region/ISO columns;
  after the union each (epiweek, country) keeps its single largest report
  (the max, not the sum, of several dates in one week).
* ``archived_weekly_series`` (X13; X15 is the same with one feed): de-duplicate
  per report date, sum per week keeping all-missing weeks missing, count the
  reports behind each week, number the weeks, rename countries, attach the
  reference table and drop the (incomplete) latest week.

Neither sorts: ordering is done once, by the sink (``publish``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.functions.dates import week_start
from hebdo.functions.text import recode
from hebdo.operators.combine import enrich, union_by_name
from hebdo.operators.dedupe import top1_per_group
from hebdo.operators.filters import drop_latest_week
from hebdo.operators.rollup import add_week_numbers, frequency_label, rows_per_group, weekly_rollup
from hebdo.plans.specs import OutputSpec
from hebdo.session import materialize
from hebdo.sources.sinks import write_csv_file, write_parquet, write_single_csv

# The reference's country renaming before the reference join
# (archived flow), in its order.
REFERENCE_COUNTRY_NAMES = {
    "United States of America": "UNITED STATES OF AMERICA",
    "Norway": "NORWAY",
    "United Kingdom": "THE UNITED KINGDOM",
    "Switzerland": "SWITZERLAND",
    "Bulgaria": "BULGARIA",
    "Ireland": "IRELAND",
    "New Zealand": "NEW ZEALAND",
    "Denmark": "DENMARK",
    "Canada": "CANADA",
    "Puerto Rico": "PUERTO RICO",
    "United States Virgin Islands": "UNITED STATES VIRGIN ISLANDS",
}

# The four published layouts.
OUTPUT_CURRENT = OutputSpec(
    columns=("WHO_REGION", "ISO_3_CODE", "country", "epiweek", "new_hospitalization", "new_icu",
             "iso_year", "iso_week_number"),
    order_by=("epiweek", "country"), week_rule="iso_week_cal_year")
OUTPUT_ARCHIVED = OutputSpec(
    columns=("country", "iso_year", "iso_week_number", "epiweek", "freq", "freq_time",
             "new_hospitalization", "new_icu"),
    order_by=("country", "epiweek"), week_rule="day_count_week")
OUTPUT_LEGACY_SHORT = OutputSpec(
    columns=("country", "epiweek", "new_hospitalization", "new_icu", "iso_year", "iso_week_number"),
    order_by=("country", "epiweek"), week_rule="day_count_week")
OUTPUT_LEGACY_REGION = OutputSpec(
    columns=("WHO_REGION", "country", "ISO_3_CODE", "iso_year", "iso_week_number", "epiweek",
             "new_hospitalization"),
    order_by=("country", "epiweek"), week_rule="day_count_week")

SOURCE_ORDER_COL = "src_ord"


def combine_sources(sources: list[DataFrame], order_col: str = SOURCE_ORDER_COL) -> DataFrame:
    """Union of normalised feeds by name; ``order_col`` records each
    feed's position, the tie-break R gets from row order."""
    tagged = [df.withColumn(order_col, F.lit(i + 1)) for i, df in enumerate(sources)]
    return union_by_name(tagged)


def current_weekly_series(sources: list[DataFrame], spec: OutputSpec = OUTPUT_CURRENT,
                          date_col: str = "report_date", row_id_col: str | None = None) -> DataFrame:
    """Union -> Monday week -> largest report per (epiweek, country).

    Each feed holds ``country``, ``report_date``, the measures and its constant
    columns.  Ties go to the earlier feed, then the earlier date, then
    ``row_id_col`` when given.
    """
    return current_weeks(combine_sources(sources), spec, date_col, row_id_col)


def current_weeks(merged: DataFrame, spec: OutputSpec = OUTPUT_CURRENT, date_col: str = "report_date",
                  row_id_col: str | None = None) -> DataFrame:
    """X14 on merged report rows (``combine_sources``).  A week's rows come from its own reports only,
    so it can be computed for some weeks alone (``plans.refresh``)."""
    merged = merged.withColumn("epiweek", week_start(date_col))
    tie = [SOURCE_ORDER_COL, date_col] + ([row_id_col] if row_id_col else [])
    best = top1_per_group(merged, ["epiweek", "country"], "new_hospitalization", tie_break=tie)
    best = add_week_numbers(best, "epiweek", spec.week_rule)
    return best.select(*spec.columns)


def archived_weekly_series(sources: list[DataFrame], reference: DataFrame | None = None,
                           reference_key: str = "ADM0_NAME", spec: OutputSpec = OUTPUT_ARCHIVED,
                           country_names: dict | None = None, freq_mode: str = "reports",
                           latest_week: str = "global", materialize_weekly: bool = True,
                           weekly_aggregates: dict[str, str] | None = None) -> DataFrame:
    """X13 (X15 with one feed) on tidy feeds ``(country_name, report_date, measures)``.

    ``freq_mode='reports'`` counts the daily reports inside each week before
    the rollup (a week built from 7 daily reports is "daily");
    ``freq_mode='compat'`` counts rows after the rollup as the reference
    script does (always 1, always "weekly").
    ``latest_week``: 'global' (reference), 'per_country', or 'keep'.
    ``materialize_weekly`` checkpoints the (small) weekly series once, so the
    latest-week scan and the final filter do not re-run the feeds.
    ``weekly_aggregates`` sets a measure's weekly aggregate ('sum' for flows,
    'max' or 'last' for stocks such as occupied beds); default: both summed.
    """
    out = archived_weeks(combine_sources(sources), spec, country_names, freq_mode, weekly_aggregates)
    own = out.columns
    if materialize_weekly and latest_week != "keep":
        out = materialize(out)
    # a left join can't change the latest week, so it is dropped before the reference is read
    if latest_week == "global":
        out = drop_latest_week(out, "epiweek")
    elif latest_week == "per_country":
        out = drop_latest_week(out, "epiweek", per=["country"])
    if reference is not None:
        ref = reference.withColumnRenamed(reference_key, "country")
        out = enrich(out, ref, "country", how="left", dedupe_reference=True)
        if len(own) < len(spec.columns):      # the layout names its reference columns (O4)
            out = out.select(*spec.columns)
    return out


def archived_weeks(merged: DataFrame, spec: OutputSpec = OUTPUT_ARCHIVED, country_names: dict | None = None,
                   freq_mode: str = "reports", weekly_aggregates: dict[str, str] | None = None) -> DataFrame:
    """X13 on merged report rows, up to the reference join: one row a country and week, each from the
    reports of its own week."""
    if "new_icu" not in merged.columns:
        merged = merged.withColumn("new_icu", F.lit(None).cast("bigint"))
    daily = top1_per_group(merged, ["report_date", "country_name"], "new_hospitalization",
                           tie_break=[SOURCE_ORDER_COL])
    how = {"new_hospitalization": "sum", "new_icu": "sum", **(weekly_aggregates or {})}
    weekly = weekly_rollup(daily, ["country_name"], "report_date", how,
                           null_policy="keep", reports_col="freq_time" if freq_mode == "reports" else None)
    if freq_mode == "compat":
        weekly = rows_per_group(weekly, ["country_name", "epiweek"], "freq_time")
    elif freq_mode != "reports":
        raise ValueError("freq_mode must be 'reports' or 'compat'")
    weekly = weekly.withColumn("freq", frequency_label("freq_time"))
    weekly = add_week_numbers(weekly, "epiweek", spec.week_rule)
    names = REFERENCE_COUNTRY_NAMES if country_names is None else country_names
    weekly = weekly.withColumn("country", recode("country_name", names))
    own = [c for c in spec.columns if c in weekly.columns]
    return weekly.select(*own)


def ordered(df: DataFrame, spec: OutputSpec) -> DataFrame:
    """K1: the reference never sorts; its files are in group-key order."""
    return df.orderBy(*spec.order_by)


def publish(df: DataFrame, spec: OutputSpec, csv_path: str | None = None,
            parquet_path: str | None = None, csv_file: str | None = None) -> None:
    """Single ordered CSV for the published series, and/or Parquet
    partitioned by year for downstream readers.  The layout's columns come
    first, in its order, followed by any further columns of the series (the
    reference columns the archived layout appends)."""
    columns = [c for c in spec.columns if c in df.columns] + [c for c in df.columns if c not in spec.columns]
    out = df.select(*columns)
    if sum(map(bool, (csv_path, csv_file, parquet_path))) > 1:
        out = materialize(out)               # the published series is small: run the flow once for all sinks
    if csv_path:
        write_single_csv(out, csv_path, list(spec.order_by))
    if csv_file:
        write_csv_file(out, csv_file, list(spec.order_by))
    if parquet_path:
        year = "iso_year" if "iso_year" in columns else None
        write_parquet(out, parquet_path, [year] if year else None)
