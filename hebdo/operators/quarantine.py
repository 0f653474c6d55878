"""Q1: date-plausibility split.

Rows are tagged once with a reason (NULL = plausible); the valid and the
quarantined side are two filters over the same tagged plan, and
``date_issue_counts`` counts every reason in one aggregate pass.  Writing both
sides in one job is ``sources.sinks.write_partitioned_by(..., 'date_issue')``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REASON_COL = "date_issue"
REASONS = ("unparsed", "missing", "before_min", "after_max")
INPUT, VALID = "input", "valid"


def date_issue(date_col: Column | str, raw_col: Column | str | None = None,
               min_date: str | None = None, max_date: str | None = None) -> Column:
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    branches = []
    if raw_col is not None:
        raw = F.col(raw_col) if isinstance(raw_col, str) else raw_col
        branches.append((d.isNull() & raw.isNotNull(), "unparsed"))
    branches.append((d.isNull(), "missing"))
    if min_date is not None:
        branches.append((d < F.lit(min_date).cast("date"), "before_min"))
    if max_date is not None:
        branches.append((d > F.lit(max_date).cast("date"), "after_max"))
    reason = F.when(branches[0][0], branches[0][1])
    for cond, label in branches[1:]:
        reason = reason.when(cond, label)
    return reason


def date_in_range(date_col: Column | str, min_date: str | None = None, max_date: str | None = None) -> Column:
    """TRUE for a non-NULL date inside [min_date, max_date], else FALSE/NULL.

    The date expression is referenced exactly ONCE.  Catalyst pushes a filter
    below the projection that computes the date and inlines the expression
    once per reference, so with a parsed date every extra reference is
    another parse of every row.  With both bounds the range test is written
    as |2 (d - lo) - span| <= span, which needs ``d`` only once.
    """
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    if min_date and max_date:
        lo = F.lit(min_date).cast("date")
        span = F.datediff(F.lit(max_date).cast("date"), lo)
        return F.abs(F.datediff(d, lo) * 2 - span) <= span
    if min_date:
        return d >= F.lit(min_date).cast("date")
    if max_date:
        return d <= F.lit(max_date).cast("date")
    return d.isNotNull()


def tag_date_issues(df: DataFrame, date_col: str, raw_col: str | None = None,
                    min_date: str | None = None, max_date: str | None = None,
                    reason_col: str = REASON_COL) -> DataFrame:
    return df.withColumn(reason_col, date_issue(date_col, raw_col, min_date, max_date))


def split_plausible(df: DataFrame, date_col: str, raw_col: str | None = None,
                    min_date: str | None = None, max_date: str | None = None,
                    reason_col: str = REASON_COL) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with a reason).

    Both sides filter with ``date_in_range`` -- one reference to the date --
    and only the quarantined side computes the reason, in a projection.
    """
    inside = date_in_range(date_col, min_date, max_date)
    valid = df.filter(inside)
    rejected = df.filter(~F.coalesce(inside, F.lit(False)))
    return valid, tag_date_issues(rejected, date_col, raw_col, min_date, max_date, reason_col)


def date_issue_counts(tagged: DataFrame, reason_col: str = REASON_COL) -> DataFrame:
    """Rows per reason (NULL = valid); valid + quarantined always equals the input."""
    return tagged.groupBy(reason_col).agg(F.count(F.lit(1)).alias("n_rows"))


def observe_issues(tagged: DataFrame, name: str, reason_col: str = REASON_COL) -> tuple[DataFrame, Observation]:
    """``tagged`` unchanged, and the counts of its rows by reason as metrics of whatever job reads it:
    the rows are counted while they pass, no scan is added.  The counts are there after the first
    action on the returned frame (or on what is made of it)."""
    counts = Observation(f"date issues of {name}")
    reason = F.col(reason_col)
    metrics = [F.count(F.lit(1)).alias(INPUT), F.count_if(reason.isNull()).alias(VALID)]
    return tagged.observe(counts, *metrics, *[F.count_if(reason == r).alias(r) for r in REASONS]), counts


def observed_counts(spark: SparkSession, counts: dict[str, Observation]) -> DataFrame:
    """(feed, reason, n_rows) of observed feeds, reasons without a row left out; one small row each.

    Waits for the jobs that were to read the feeds: call it after their action."""
    rows = [(feed, reason, n) for feed, observed in counts.items() for reason, n in observed.get.items() if n]
    return spark.createDataFrame(rows, "feed string, reason string, n_rows bigint")
