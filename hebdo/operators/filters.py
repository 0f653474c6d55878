"""Row filters.  SQL three-valued logic drops rows whose predicate is
NULL, which is also what the R filters do with NA."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.operators.combine import join_nullsafe
from hebdo.session import materialize


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keep_equal(df: DataFrame, col: Column | str, value) -> DataFrame:
    """F1."""
    return df.filter(_c(col) == F.lit(value))


def exclude_values(df: DataFrame, col: Column | str, values: Iterable) -> DataFrame:
    """AND of ``!=``; rows with a NULL value are dropped as well."""
    return df.filter(~_c(col).isin(list(values)))


def keep_values(df: DataFrame, col: Column | str, values: Iterable) -> DataFrame:
    """OR of ``==`` / ``%in%``; NULL never matches."""
    return df.filter(_c(col).isin(list(values)))


def keep_all(df: DataFrame, *predicates: Column) -> DataFrame:
    """conjunction of slice predicates."""
    cond = predicates[0]
    for p in predicates[1:]:
        cond = cond & p
    return df.filter(cond)


def keep_on_or_after(df: DataFrame, col: Column | str, first_date: str) -> DataFrame:
    """valid date and not before ``first_date``.  A NULL date makes the
    comparison NULL, which drops the row, so one comparison covers both tests
    (and the date expression is evaluated once in the filter)."""
    return df.filter(_c(col) >= F.lit(first_date).cast("date"))


def drop_zero(df: DataFrame, col: Column | str) -> DataFrame:
    """keep non-zero values (NULL is dropped too)."""
    return df.filter(_c(col) != 0)


def drop_week(df: DataFrame, week_col: Column | str, week: int = 53) -> DataFrame:
    """F8: drop one week number; the week may be text ("53") or a number."""
    return df.filter(_c(week_col).try_cast("int") != week)


def drop_latest_week(df: DataFrame, week_col: str = "epiweek", per: list[str] | None = None,
                     materialize_input: bool = False) -> DataFrame:
    """keep rows strictly before the latest week.

    Global (default): one scalar subquery ``max(week)`` over the whole input, the
    reference behaviour -- a source that stops earlier keeps its own last week.
    ``per=[...]``: the latest week of each group instead; the per-group maxima
    are a partial aggregate joined back by key.

    The maximum and the filter both read ``df``; Catalyst pushes the filter
    into the scans, so without ``materialize_input`` the upstream plan runs
    twice.  For a weekly result (small) built from a large input, set
    ``materialize_input=True``: it is checkpointed once to the shared folder.
    """
    if materialize_input:
        df = materialize(df)
    if not per:
        latest = df.select(F.max(week_col)).scalar()
        return df.filter(F.col(week_col) < latest)
    latest = df.groupBy(*per).agg(F.max(week_col).alias("__latest_week"))
    # no size probe: it would run the input once more; AQE decides from the measured size
    joined = join_nullsafe(df, latest, per, how="inner", broadcast=False)
    return joined.filter(F.col(week_col) < F.col("__latest_week")).drop("__latest_week")
