"""Column names that don't meet the caller's."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def check_free(keep: Iterable[str], made: Iterable[str]) -> None:
    """Kept columns may not have the names of the columns an operator makes."""
    clash = sorted({c.lower() for c in keep} & {c.lower() for c in made})
    if clash:
        raise ValueError(f"kept columns have the names of result columns: {clash}; rename them first")
