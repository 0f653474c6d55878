"""Projection, renaming, constants, typed NULLs, derived columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.functions.names import clean_names


def select_renamed(df: DataFrame, columns: Mapping[str, str] | list[str]) -> DataFrame:
    """P1 + P2: keep (and order) columns; a mapping renames ``{new: old}``."""
    if isinstance(columns, Mapping):
        return df.select(*[F.col(old).alias(new) for new, old in columns.items()])
    return df.select(*columns)


def clean_column_names(df: DataFrame) -> DataFrame:
    """Snake-case every top-level column name (``toDF`` renames positionally)."""
    return df.toDF(*clean_names(df.columns))


def typed_null(data_type: str = "bigint") -> Column:
    """A NULL with a real type, so unions keep a usable schema."""
    return F.lit(None).cast(data_type)


def with_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Constant columns (country, region, ISO code ...); ``None`` needs a typed_null."""
    cols = {name: value if isinstance(value, Column) else F.lit(value) for name, value in constants.items()}
    return df.withColumns(cols)


def sum_of_columns(*cols: Column | str) -> Column:
    """Element-wise sum (NULL if any part is NULL -- fill first when 0 is meant)."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def project_for_join(df: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """Project to the key and the needed measures before a join so that no
    same-named non-key column can collide (no ``.x`` / ``.y`` suffixes)."""
    return df.select(*keys, *[c for c in keep if c not in keys])


def computed_once(df: DataFrame, *cols: Column | str) -> DataFrame:
    """A projection whose expressions are evaluated once a row, whatever reads
    them.  Catalyst pushes a filter below a plain projection and inlines the
    filtered expression there, so an expensive one (a parsed date) would run
    again for every reference.  A one-element ``inline`` is where that stops;
    filters that need no computed column belong before it."""
    return df.select(F.inline(F.array(F.struct(*cols))))
