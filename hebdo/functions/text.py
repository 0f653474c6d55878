"""String helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from hebdo.functions.casts import _col


def trim_all(c: Column | str) -> Column:
    """Strip leading/trailing whitespace of any kind (tabs, newlines, Unicode spaces)."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def normalize_label(c: Column | str) -> Column:
    """T1 + T2: lower-case and trimmed, for comparing free-text labels."""
    return F.lower(trim_all(c))


def recode(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """T5: replace listed values, pass every other value (and NULL) through.

    Meant for short literal maps (a handful of names); a long map belongs in a
    table joined with ``operators.combine.enrich``.
    """
    source = _col(c)
    if not mapping:
        return source
    pairs = []
    for key, value in mapping.items():
        pairs += [F.lit(key), F.lit(value)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), source), source)


def bytes_to_text(c: Column | str, charset: str = "UTF-8") -> Column:
    """Binary payload -> text."""
    return F.decode(_col(c), charset)
