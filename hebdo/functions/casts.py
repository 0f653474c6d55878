"""ANSI-safe casts.  Bad text becomes NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    """Text -> double; unparsable text -> NULL (surrounding spaces allowed)."""
    return _col(c).try_cast("double")


def to_int_truncating(c: Column | str, target: str = "int") -> Column:
    """text/number -> integer, truncating toward zero ("12.7" -> 12).

    Going through double keeps fractional text valid; the second try_cast turns
    out-of-range values (``1e20``) into NULL rather than an overflow error.
    """
    return _col(c).try_cast("double").try_cast(target)


def to_count(c: Column | str) -> Column:
    """Measure text -> bigint count (the tidy schema's count type)."""
    return to_int_truncating(c, "bigint")


def to_text(c: Column | str) -> Column:
    """Any value -> its text form."""
    return _col(c).cast("string")
