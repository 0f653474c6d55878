"""Whole-frame missing-value replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def fill_missing(df: DataFrame, value: int = 0, subset: list[str] | None = None) -> DataFrame:
    """Replace NULL by ``value`` in numeric columns and by its text in string
    columns (R's ``replace(is.na(.), 0)`` turns NA text into "0")."""
    fields = [f for f in df.schema.fields if subset is None or f.name in subset]
    numeric = [f.name for f in fields if isinstance(f.dataType, _NUMERIC)]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    if numeric:
        df = df.fillna(value, subset=numeric)
    if text:
        df = df.fillna(str(value), subset=text)
    return df
