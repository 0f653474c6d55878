"""Daily and weekly aggregation with explicit NULL policies.

Every aggregate here is a hash (or sort) aggregate with a partial,
map-side stage, so a country holding a third of all rows is pre-reduced in
every input partition before the shuffle: the final task of a hot key sees
at most one partial row per map partition, never the raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hebdo.functions.dates import week_numbers, week_start

NULL_POLICIES = ("keep", "zero")
MEASURE_AGGREGATES = ("sum", "max", "last")


def measure_aggregate(measure: str, how: str = "sum", null_policy: str = "keep",
                      order_col: str | None = None) -> Column:
    """One measure's aggregate.

    ``sum`` for flows (admissions); ``max`` / ``last`` for stocks such as bed
    occupancy, where ``last`` is the value of the latest ``order_col`` row.
    ``null_policy='keep'`` leaves an all-NULL group NULL (A2); ``'zero'`` makes
    it 0 (A1, R's ``sum(na.rm = TRUE)``).
    """
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    if how == "sum":
        value = F.sum(measure)
    elif how == "max":
        value = F.max(measure)
    elif how == "last":
        if order_col is None:
            raise ValueError("'last' needs an order column")
        # max over (order, value) is deterministic even when two rows share the order value
        value = F.max(F.struct(F.col(measure).isNotNull(), F.col(order_col), F.col(measure)))[measure]
    else:
        raise ValueError(f"aggregate must be one of {MEASURE_AGGREGATES}")
    if null_policy == "zero":
        value = F.coalesce(value, F.lit(0))
    return value.alias(measure)


def _aggregates(measures: list[str] | Mapping[str, str], null_policy: str, order_col: str | None) -> list[Column]:
    if isinstance(measures, Mapping):
        return [measure_aggregate(m, how, null_policy, order_col) for m, how in measures.items()]
    return [measure_aggregate(m, "sum", null_policy, order_col) for m in measures]


def daily_totals(df: DataFrame, keys: list[str], date_col: str,
                 measures: list[str] | Mapping[str, str], null_policy: str = "zero") -> DataFrame:
    """A1 per report date: one row per (keys, date)."""
    return df.groupBy(*keys, date_col).agg(*_aggregates(measures, null_policy, date_col))


def weekly_rollup(df: DataFrame, keys: list[str], date_col: str,
                  measures: list[str] | Mapping[str, str], null_policy: str = "keep",
                  week_col: str = "epiweek", reports_col: str | None = None,
                  week_rule: str | None = None, year_col: str = "iso_year",
                  week_number_col: str = "iso_week_number") -> DataFrame:
    """A1/A2 (+A4b): Monday-based weekly aggregate per ``keys``.

    ``reports_col`` counts the input rows (reports) of each week -- computed
    inside the same aggregate, before the rollup collapses them (A4b).
    ``week_rule`` adds year/week-number columns (see ``functions.dates``).
    """
    aggs = _aggregates(measures, null_policy, date_col)
    if reports_col:
        aggs.append(F.count(F.lit(1)).alias(reports_col))
    out = (df.withColumn(week_col, week_start(date_col))
             .groupBy(*keys, week_col).agg(*aggs))
    if week_rule:
        out = add_week_numbers(out, week_col, week_rule, year_col, week_number_col)
    return out


def add_week_numbers(df: DataFrame, week_col: str, week_rule: str,
                     year_col: str = "iso_year", week_number_col: str = "iso_week_number") -> DataFrame:
    year, week = week_numbers(F.col(week_col), week_rule)
    return df.withColumns({year_col: year, week_number_col: week})


def add_week_start(df: DataFrame, date_col: str, week_col: str = "epiweek") -> DataFrame:
    """D1 as a column: the Monday of each row's date."""
    return df.withColumn(week_col, week_start(date_col))


def rows_per_group(df: DataFrame, keys: list[str], out_col: str = "freq_time") -> DataFrame:
    """Group size attached to every row (``mutate(n = n())``).

    Intended, as in the reference, for the output of a rollup over the same
    keys, where every group holds exactly one row; the window then never holds
    more than one row per key.  For raw rows use ``weekly_rollup(reports_col=)``.
    """
    return df.withColumn(out_col, F.count(F.lit(1)).over(Window.partitionBy(*keys)))


def frequency_label(count_col: str, single: str = "weekly", several: str = "daily") -> Column:
    """``weekly`` when one report made up the week, ``daily`` otherwise."""
    c = F.col(count_col)
    return F.when(c.isNull(), F.lit(None).cast("string")).when(c == 1, single).otherwise(several)
