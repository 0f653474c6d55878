"""X1-X11 as data: ``normalize_source`` turns any feed into tidy rows.

filter -> fill -> measures (cast + add) -> parse date -> country -> F6/F7
-> daily aggregate.  All narrow transformations up to one partial+final
aggregate per (country, report date).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hebdo.functions import dates as D
from hebdo.functions.casts import to_double, to_int_truncating
from hebdo.functions.text import normalize_label, recode
from hebdo.operators.columns import computed_once, sum_of_columns
from hebdo.operators.combine import outer_merge_measures, paged_full_join_on_values, union_by_name
from hebdo.operators.nulls import fill_missing
from hebdo.operators.quarantine import REASON_COL, date_in_range, observe_issues, tag_date_issues
from hebdo.operators.rollup import daily_totals
from hebdo.plans.specs import TIDY_KEYS, DateSpec, SourceSpec
from hebdo.session import checkpoint_dir


def parse_report_date(spec: DateSpec) -> Column:
    c = F.col(spec.column)
    if spec.kind == "leading":
        return D.parse_date_leading(c)
    if spec.kind == "formats":
        return D.parse_date_formats(c, spec.formats)
    if spec.kind == "epoch_ms":
        return D.epoch_ms_to_date(c)
    if spec.kind == "week_code_monday":
        return D.monday_of_monday_week(D.week_code_year(c), D.week_code_week(c))
    if spec.kind == "week_code_iso":
        return D.monday_of_iso_week(D.week_code_year(c), D.week_code_week(c))
    return c.cast("date")


def _compare_value(c: Column, value) -> Column:
    return to_int_truncating(c) if isinstance(value, int) else c


def apply_filters(df: DataFrame, spec: SourceSpec) -> DataFrame:
    if spec.labels:
        df = df.withColumns({c: normalize_label(c) for c in spec.labels})
    conds = []
    for col, value in spec.equals:
        conds.append(_compare_value(F.col(col), value) == F.lit(value))
    for col, values in spec.include:
        conds.append(_compare_value(F.col(col), values[0]).isin(list(values)))
    for col, values in spec.exclude:
        conds.append(~_compare_value(F.col(col), values[0]).isin(list(values)))
    if spec.drop_week is not None:
        conds.append(D.week_code_week(spec.date.column).try_cast("int") != spec.drop_week)
    for cond in conds:
        df = df.filter(cond)
    return df


def _report_columns(df: DataFrame, spec: SourceSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Filtered, typed rows ``(country_name, report_date, measures, *keep)``."""
    df = apply_filters(df, spec)
    if spec.fill_missing:
        df = fill_missing(df, 0)
    if spec.country_column:
        country = recode(F.col(spec.country_column), dict(spec.country_recode))
    else:
        country = F.lit(spec.country)
    measures = {m.name: to_int_truncating(sum_of_columns(*[to_double(p) for p in m.parts]), "bigint")
                for m in spec.measures}
    raw = [F.col(spec.date.column).cast("string").alias("raw_date")] if spec.plausible else []
    project = computed_once if spec.plausible or spec.min_date else DataFrame.select
    return project(df, country.alias("country_name"), parse_report_date(spec.date).alias("report_date"),
                   *[expr.alias(name) for name, expr in measures.items()], *raw, *keep)


def _valid_range(spec: SourceSpec) -> tuple[str | None, str | None]:
    """[first, last] valid report date: the plausible range narrowed by F6."""
    first, last = spec.plausible or (None, None)
    if spec.min_date:
        first = max(first, spec.min_date) if first else spec.min_date
    return first, last


def tag_report_rows(df: DataFrame, spec: SourceSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed rows with, when ``spec.plausible`` is set, the raw date text and a
    ``date_issue`` reason (NULL for a plausible date) -- one plan feeds both
    sides of Q1."""
    rows = _report_columns(df, spec, keep)
    if spec.plausible:
        first, last = spec.plausible
        rows = tag_date_issues(rows, "report_date", raw_col="raw_date", min_date=first, max_date=last)
    return rows


def to_report_rows(df: DataFrame, spec: SourceSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Filtered, typed, not yet aggregated rows: (country_name, report_date,
    measures) plus the ``keep`` columns carried through unchanged.

    The slice filters run first, then the date is parsed once
    (``computed_once``), then Q1 and F6 are one range filter over it.
    """
    rows = _report_columns(df, spec, keep)
    first, last = _valid_range(spec)
    if spec.plausible or spec.min_date:
        rows = rows.filter(date_in_range("report_date", first, last))
    if spec.plausible:
        rows = rows.drop("raw_date")
    if spec.drop_zero:
        rows = rows.filter(F.col(spec.drop_zero) != 0)
    return rows


def quarantined_rows(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Q1: the rows of a feed whose report date is missing, unparsable or
    outside ``spec.plausible``, with the raw text and the reason."""
    if not spec.plausible:
        raise ValueError(f"feed {spec.name!r} has no plausible date range")
    first, last = spec.plausible
    rows = _report_columns(df, spec).filter(~F.coalesce(date_in_range("report_date", first, last), F.lit(False)))
    return (tag_date_issues(rows, "report_date", raw_col="raw_date", min_date=first, max_date=last)
            .withColumn("feed", F.lit(spec.name)))


VALID = "valid"


def normalize_with_quarantine(df: DataFrame, spec: SourceSpec, staging_path: str | None = None
                              ) -> tuple[DataFrame, DataFrame]:
    """(tidy daily rows, quarantined rows) from ONE pass over the raw feed.

    The typed, tagged rows are written once as Parquet partitioned by
    ``date_issue`` (to ``staging_path``, by default a fresh folder under the
    shared checkpoint folder); the valid partition is then aggregated and the
    others are the quarantine -- both read with partition pruning, so the raw
    files are parsed once and the lineage is cut.
    """
    if not spec.plausible:
        raise ValueError(f"feed {spec.name!r} has no plausible date range")
    if staging_path is None:
        staging_path = os.path.join(checkpoint_dir(df.sparkSession), f"staged-{spec.name}-{uuid.uuid4().hex}")
    tagged = tag_report_rows(df, spec).withColumn(REASON_COL, F.coalesce(F.col(REASON_COL), F.lit(VALID)))
    tagged.write.mode("overwrite").partitionBy(REASON_COL).parquet(staging_path)
    staged = df.sparkSession.read.parquet(staging_path)
    rows = staged.filter(F.col(REASON_COL) == VALID).drop(REASON_COL, "raw_date")
    if spec.min_date:
        rows = rows.filter(F.col("report_date") >= F.lit(spec.min_date).cast("date"))
    if spec.drop_zero:
        rows = rows.filter(F.col(spec.drop_zero) != 0)
    if spec.aggregate_daily:
        how = {m.name: m.aggregate for m in spec.measures}
        rows = daily_totals(rows, ["country_name"], "report_date", how, spec.null_policy)
    quarantined = staged.filter(F.col(REASON_COL) != VALID).withColumn("feed", F.lit(spec.name))
    return _with_constants(rows, spec), quarantined


def _with_constants(df: DataFrame, spec: SourceSpec) -> DataFrame:
    cols = {k: F.lit(v) for k, v in spec.constants}
    cols.update({m: F.lit(None).cast("bigint") for m in spec.missing_measures})
    return df.withColumns(cols) if cols else df


def normalize_source(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """One feed -> one tidy row per (country_name, report_date)."""
    rows = to_report_rows(df, spec)
    if not spec.aggregate_daily:
        return _with_constants(rows, spec)
    how = {m.name: m.aggregate for m in spec.measures}
    return _with_constants(daily_totals(rows, ["country_name"], "report_date", how, spec.null_policy), spec)


def normalize_observed(df: DataFrame, spec: SourceSpec) -> tuple[DataFrame, Observation]:
    """``normalize_source``, and the feed's row counts by date issue, counted by the job that computes
    the tidy rows (Q1 in the same pass; ``observed_counts`` reads them after that job)."""
    if not spec.plausible:
        raise ValueError(f"feed {spec.name!r} has no plausible date range")
    tagged, counts = observe_issues(tag_report_rows(df, spec), spec.name)
    rows = tagged.filter(F.col(REASON_COL).isNull()).drop(REASON_COL, "raw_date")
    if spec.min_date:
        rows = rows.filter(F.col("report_date") >= F.lit(spec.min_date).cast("date"))
    if spec.drop_zero:
        rows = rows.filter(F.col(spec.drop_zero) != 0)
    if spec.aggregate_daily:
        how = {m.name: m.aggregate for m in spec.measures}
        rows = daily_totals(rows, ["country_name"], "report_date", how, spec.null_policy)
    return _with_constants(rows, spec), counts


def normalize_measure_pair(left: DataFrame, left_spec: SourceSpec,
                           right: DataFrame, right_spec: SourceSpec) -> DataFrame:
    """A feed published as two tables (e.g. admissions and ICU) merged on
    (country, report date).

    Summed measures are merged the way a full join followed by a sum does it.
    As soon as a measure has another aggregate (a stock: ``max``, ``last``),
    each side is first brought to one row per key with its own aggregates.
    Each side's measures follow its own missing-value policy."""
    sides = [(to_report_rows(left, left_spec), left_spec), (to_report_rows(right, right_spec), right_spec)]
    if any(m.aggregate != "sum" for _, spec in sides for m in spec.measures):
        sides = [(daily_totals(rows, ["country_name"], "report_date", {m.name: m.aggregate for m in spec.measures},
                               spec.null_policy), spec) for rows, spec in sides]
    merged = outer_merge_measures(sides[0][0], sides[1][0], list(TIDY_KEYS), null_policy="keep")
    filled = {m.name: F.coalesce(F.col(m.name), F.lit(0)) for _, spec in sides if spec.null_policy == "zero"
              for m in spec.measures}
    merged = merged.withColumns(filled) if filled else merged
    return _with_constants(_with_constants(merged, right_spec), left_spec)


def _only_summed(spec: SourceSpec) -> str:
    """The one measure of a feed whose pages are joined on its values."""
    if len(spec.measures) != 1 or spec.measures[0].aggregate != "sum":
        raise ValueError("the page join merges pages of a single summed measure")
    return spec.measures[0].name


def normalize_paged(df: DataFrame, spec: SourceSpec, page_col: str) -> DataFrame:
    """J2a over all pages of ONE scan (``page_col`` tells them apart): the
    reference's full join of the pages on (country, date, measure), computed
    from per-page counts, then summed per date."""
    m = _only_summed(spec)
    rows = to_report_rows(df, spec, keep=(page_col,))
    weighted = paged_full_join_on_values(rows, [*TIDY_KEYS, m], page_col, "__n")
    summed = weighted.groupBy(*TIDY_KEYS).agg(F.sum(F.col(m) * F.col("__n")).alias(m))
    if spec.null_policy == "zero":
        summed = summed.withColumn(m, F.coalesce(F.col(m), F.lit(0)))
    return _with_constants(summed, spec)


def normalize_pages(pages: list[DataFrame], spec: SourceSpec, mode: str = "union") -> DataFrame:
    """A feed delivered as several pages of the same layout.

    ``union`` (J2b, default): every row of every page counts once.
    ``full_join_on_values`` (J2a): the reference's full join on
    (country, date, measure) of the pages -- duplicated values multiply, single
    repeats collapse.  Only for reproducing old outputs; needs one measure.
    """
    if mode == "union":
        rows = [to_report_rows(p, spec) for p in pages]
        how = {m.name: m.aggregate for m in spec.measures}
        return _with_constants(daily_totals(union_by_name(rows), ["country_name"], "report_date",
                                            how, spec.null_policy), spec)
    if mode != "full_join_on_values":
        raise ValueError("mode must be 'union' or 'full_join_on_values'")
    tagged = [p.withColumn("__page", F.lit(i)) for i, p in enumerate(pages)]
    return normalize_paged(union_by_name(tagged), spec, "__page")
