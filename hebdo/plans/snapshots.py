"""Comparing two published snapshots of a series.

Both snapshots are put under each other and reduced to one row a key by one
aggregate: keys compare null-safe, a hot key is combined map-side, and no join
pairs exist.  A key that a snapshot holds more than once has no single value
there; it is reported as ``repeated`` with its row counts instead of being
compared with an arbitrary one of its rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT_KEYS = ("country", "epiweek")
SNAPSHOT_FIELDS = ("new_hospitalization", "new_icu")


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _field_class(field: str, number: bool) -> Column:
    old, new = F.col(f"old_{field}"), F.col(f"new_{field}")
    moved = F.when(new > old, "up").otherwise("down") if number else F.lit("changed")
    return (F.when(old.eqNullSafe(new), "equal").when(old.isNull(), "filled").when(new.isNull(), "cleared")
            .otherwise(moved))


def compare_snapshots(old: DataFrame, new: DataFrame, keys: Iterable[str] = SNAPSHOT_KEYS,
                      fields: Iterable[str] = SNAPSHOT_FIELDS) -> DataFrame:
    """One row a key of either snapshot.

    ``revision``: added, removed, equal, revised or repeated; per field ``old_``, ``new_`` and
    ``class_`` (equal, up, down, filled, cleared; changed for what is not a number; NULL where the
    key is not on both sides once) and, for numbers, ``change_`` = new - old; ``n_old`` and ``n_new``
    count the key's rows."""
    keys, fields = list(keys), list(fields)
    for f in fields:
        if old.schema[f].dataType != new.schema[f].dataType:
            raise TypeError(f"field {f!r} is {old.schema[f].dataType.simpleString()} in the old snapshot and "
                            f"{new.schema[f].dataType.simpleString()} in the new one")
    numbers = {f for f in fields if _is_number(old.schema[f].dataType)}
    side = lambda df, n: df.select(*keys, F.lit(n).alias("__side"), *fields)
    both = side(old, 0).unionByName(side(new, 1))
    at = F.col("__side")
    aggs = [F.count_if(at == 0).alias("n_old"), F.count_if(at == 1).alias("n_new")]
    for f in fields:                        # a side with one row has that row's value as its minimum
        aggs += [F.min(F.when(at == 0, F.col(f))).alias(f"old_{f}"), F.min(F.when(at == 1, F.col(f))).alias(f"new_{f}")]
    out = both.groupBy(*keys).agg(*aggs)
    once = (F.col("n_old") == 1) & (F.col("n_new") == 1)
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f"old_{f}").eqNullSafe(F.col(f"new_{f}"))
    revision = (F.when((F.col("n_old") > 1) | (F.col("n_new") > 1), "repeated").when(F.col("n_old") == 0, "added")
                .when(F.col("n_new") == 0, "removed").when(same, "equal").otherwise("revised"))
    columns = [revision.alias("revision"), "n_old", "n_new"]
    single_old, single_new = F.col("n_old") == 1, F.col("n_new") == 1
    for f in fields:
        columns += [F.when(single_old, F.col(f"old_{f}")).alias(f"old_{f}"),
                    F.when(single_new, F.col(f"new_{f}")).alias(f"new_{f}"),
                    F.when(once, _field_class(f, f in numbers)).alias(f"class_{f}")]
        if f in numbers:
            columns.append(F.when(once, F.col(f"new_{f}") - F.col(f"old_{f}")).alias(f"change_{f}"))
    return out.select(*keys, *columns)


def revision_summary(compared: DataFrame, fields: Iterable[str] = SNAPSHOT_FIELDS,
                     by: Iterable[str] = ()) -> DataFrame:
    """(by, field, class, n_keys, total_change): one row a field and class; keys that are not on both
    sides once count under their revision (added, removed, repeated)."""
    items = []
    for f in fields:
        change = F.col(f"change_{f}").cast("double") if f"change_{f}" in compared.columns else F.lit(None).cast("double")
        items.append(F.struct(F.lit(f).alias("field"), F.coalesce(f"class_{f}", "revision").alias("class"),
                              change.alias("change")))
    rows = compared.select(*by, F.inline(F.array(*items)))
    return rows.groupBy(*by, "field", "class").agg(F.count(F.lit(1)).alias("n_keys"),
                                                   F.sum("change").alias("total_change"))
