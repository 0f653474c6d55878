"""Merging sources, pages and measures; reference enrichment.

R's joins match NA with NA, so every key comparison here is NULL-safe.  The
two full-join forms of the reference (J1 on the business key, J2a with the
measure inside the key) multiply rows when a key repeats on both sides; both
are computed exactly from per-key counts and sums in ONE union + aggregate:
no join pairs are ever materialised, hot keys are combined map-side, and the
result equals "full join, then aggregate".
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# --- U1 / J2b / J3 -----------------------------------------------------------

def union_by_name(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column missing on one side becomes NULL."""
    frames = list(dfs[0]) if len(dfs) == 1 and isinstance(dfs[0], (list, tuple)) else list(dfs)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication."""
    return df.distinct()


# --- J1: two measures from two tables on the business key --------------------

def outer_merge_measures(left: DataFrame, right: DataFrame, keys: list[str],
                         null_policy: str = "zero", left_rows: str | None = None,
                         right_rows: str | None = None) -> DataFrame:
    """Full outer join of two measure tables on ``keys`` (NULL-safe), then the
    per-key sum of every measure, as the reference does.

    A left row appears once per matching right row (once if none), so its
    measures are weighted by ``max(right_count, 1)`` and vice versa.  With
    unique keys per side the weights are 1 and this is a plain outer merge.

    ``left_rows`` / ``right_rows`` name a column holding how many raw rows a
    row stands for, so a side may be pre-aggregated (summed per a finer key)
    before it is shuffled; the result is the same as on the raw rows.
    """
    counts = {c for c in (left_rows, right_rows) if c}
    left_measures = [c for c in left.columns if c not in keys and c not in counts]
    right_measures = [c for c in right.columns if c not in keys and c not in counts]
    clash = set(left_measures) & set(right_measures)
    if clash:
        raise ValueError(f"measure names on both sides: {sorted(clash)}; project first (P9)")
    one = F.lit(1).cast("bigint")
    tagged = union_by_name(
        left.select(*keys, *left_measures, (F.col(left_rows) if left_rows else one).alias("__left"),
                    F.lit(0).cast("bigint").alias("__right")),
        right.select(*keys, *right_measures, F.lit(0).cast("bigint").alias("__left"),
                     (F.col(right_rows) if right_rows else one).alias("__right")),
    )
    return merge_side_totals(tagged, keys, left_measures, right_measures, "__left", "__right", null_policy)


def merge_side_totals(df: DataFrame, keys: list[str], left_measures: list[str], right_measures: list[str],
                      left_rows: str, right_rows: str, null_policy: str = "zero") -> DataFrame:
    """J1 from ONE frame that already holds, per finer key, each side's
    partial sums and raw row counts (e.g. both sides pre-aggregated in a single
    pass with conditional sums).  Same result as ``outer_merge_measures``."""
    sums = [F.sum(m).alias(m) for m in left_measures + right_measures]
    per_key = df.groupBy(*keys).agg(F.sum(left_rows).alias("__n_left"),
                                    F.sum(right_rows).alias("__n_right"), *sums)

    def weighted(m: str, partner: str):
        value = F.col(m) * F.greatest(F.col(partner), F.lit(1))
        return F.coalesce(value, F.lit(0)) if null_policy == "zero" else value

    return per_key.select(*keys,
                          *[weighted(m, "__n_right").alias(m) for m in left_measures],
                          *[weighted(m, "__n_left").alias(m) for m in right_measures])


# --- J2a: full join with the measure inside the key --------------------------

def full_join_on_values(left: DataFrame, right: DataFrame, keys: list[str],
                        count_col: str = "n_rows") -> DataFrame:
    """The reference's page concatenation: full join on every kept column.

    Returns one row per distinct key with ``count_col`` = rows the join
    produces for it: a*b when both sides hold the key (a, b = multiplicities),
    otherwise a or b.  Sum a measure over the join result as
    ``sum(measure * count_col)``; no pair is emitted.
    """
    tagged = union_by_name(
        left.select(*keys, F.lit(1).alias("__left"), F.lit(0).alias("__right")),
        right.select(*keys, F.lit(0).alias("__left"), F.lit(1).alias("__right")),
    )
    per_key = tagged.groupBy(*keys).agg(F.sum("__left").alias("__a"), F.sum("__right").alias("__b"))
    a, b = F.col("__a"), F.col("__b")
    n_rows = F.when((a > 0) & (b > 0), a * b).otherwise(a + b)
    return per_key.select(*keys, n_rows.alias(count_col))


def paged_full_join_on_values(df: DataFrame, keys: list[str], page_col: str,
                              count_col: str = "n_rows") -> DataFrame:
    """J2a for any number of pages held in one frame (one scan of a page folder,
    the page in ``page_col``): the rows that chained full joins of all pages on
    ``keys`` give for a key are the product of its counts on the pages that
    hold it.  Two aggregates, no join; one page gives its own counts."""
    per_page = df.groupBy(*keys, page_col).agg(F.count(F.lit(1)).alias("__n"))
    counts = per_page.groupBy(*keys).agg(F.collect_list("__n").alias("__counts"))    # one number a page
    rows = F.aggregate("__counts", F.lit(1).cast("bigint"), lambda a, n: a * n)
    return counts.select(*keys, rows.alias(count_col))


# --- J4: reference enrichment -----------------------------------------------

MAX_BROADCAST_ROW_BYTES = 1_024


def provably_small(df: DataFrame, max_rows: int = 100_000) -> bool:
    """Whether ``df`` holds at most ``max_rows`` rows of together at most
    ``max_rows`` x ``MAX_BROADCAST_ROW_BYTES`` bytes.

    One top-level limit over row widths: it runs as ``CollectLimit``, which
    scans partitions incrementally (one, then four times more, ...) and stops
    once it has ``max_rows + 1`` rows, so the check stays cheap on a table with
    thousands of partitions and sends one number a row."""
    width = F.lit(0)
    for f in df.schema.fields:
        nested = f.dataType.typeName() in ("string", "binary", "array", "map", "struct")
        size = F.octet_length(F.col(f"`{f.name}`").cast("string")) if nested else F.lit(8)
        width = width + F.coalesce(size, F.lit(0))
    widths = [r[0] for r in df.select(width.cast("bigint").alias("w")).limit(max_rows + 1).collect()]
    return len(widths) <= max_rows and sum(widths) <= max_rows * MAX_BROADCAST_ROW_BYTES


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """``df`` with a broadcast hint when it is provably small in rows and bytes;
    otherwise unchanged, so the planner picks a shuffle join."""
    return F.broadcast(df) if provably_small(df, max_rows) else df


def join_facts_to_dimension(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                            group_keys: list[str], sum_cols: list[str],
                            max_broadcast_rows: int = 100_000, pre_aggregate: bool = False) -> DataFrame:
    """Inner-join fact rows to a dimension, for a later sum over the result.

    A dimension proven small is broadcast and the raw facts are joined
    map-side (no shuffle before the caller's aggregate).  Otherwise they are
    shuffle-joined, and AQE splits skewed partitions.  ``pre_aggregate`` sums
    the facts per ``group_keys`` (which must include ``fact_key``) first: worth
    its extra shuffle where a known hot key repeats within ``group_keys``.  All
    give the same sums of ``sum_cols`` per any grouping coarser than
    ``group_keys``.
    """
    if provably_small(dim, max_broadcast_rows):
        joined = facts.join(F.broadcast(dim), facts[fact_key] == dim[dim_key])
    elif not pre_aggregate:
        joined = facts.join(dim, facts[fact_key] == dim[dim_key])
    else:
        pre = facts.groupBy(*group_keys).agg(*[F.sum(c).alias(c) for c in sum_cols])
        joined = pre.join(dim, pre[fact_key] == dim[dim_key])
    return joined.drop(dim_key)


def join_nullsafe(df: DataFrame, other: DataFrame, on: list[str], how: str = "left",
                  max_broadcast_rows: int = 100_000, broadcast: bool | None = None) -> DataFrame:
    """Equi-join on ``on`` where NULL matches NULL; ``other`` is broadcast only
    after ``provably_small`` says so, otherwise a shuffle join
    (with AQE skew handling) is planned."""
    clash = (set(df.columns) & set(other.columns)) - set(on)
    if clash:
        raise ValueError(f"non-key columns on both sides: {sorted(clash)}; project first (P9)")
    renamed = other.select(*[F.col(k).alias(f"__other_{k}") for k in on],
                           *[c for c in other.columns if c not in on])
    if broadcast is None:
        renamed = broadcast_if_small(renamed, max_broadcast_rows)
    elif broadcast:
        renamed = F.broadcast(renamed)
    cond = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__other_{k}")) for k in on])
    return df.join(renamed, cond, how).drop(*[f"__other_{k}" for k in on])


def enrich(df: DataFrame, reference: DataFrame, on: list[str] | str, how: str = "left",
           dedupe_reference: bool = True, max_broadcast_rows: int = 100_000) -> DataFrame:
    """J4 (+U2): attach reference columns by key.  Identical duplicate reference
    rows are removed first; different rows for one key still fan out, as a
    left join does."""
    keys = [on] if isinstance(on, str) else list(on)
    # the raw reference bounds its de-duplicated form: probe the cheap scan,
    # not the distinct (which would need its shuffle just for the check)
    small = provably_small(reference, max_broadcast_rows)
    ref = distinct_rows(reference) if dedupe_reference else reference
    return join_nullsafe(df, ref, keys, how=how, broadcast=small)
