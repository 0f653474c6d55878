"""Snake-case column names (a pure function over the schema, not the data)."""

from __future__ import annotations

import re
import unicodedata

_CAMEL_LOWER_UPPER = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_CAMEL_ACRONYM_END = re.compile(r"(?<=[A-Z])(?=[A-Z][a-z])")
_NON_WORD = re.compile(r"[^0-9a-zÀ-￿]+")


def clean_name(name: str) -> str:
    """One name in snake case: ``Total Price (%)`` -> ``total_price_percent``."""
    text = name.replace("%", "_percent_").replace("#", "_number_").replace("'", "")
    text = unicodedata.normalize("NFKD", text)
    text = "".join(ch for ch in text if not unicodedata.combining(ch))
    text = _CAMEL_ACRONYM_END.sub("_", _CAMEL_LOWER_UPPER.sub("_", text))
    text = _NON_WORD.sub("_", text.lower()).strip("_")
    if not text:
        return "x"
    return "x" + text if text[0].isdigit() else text


def clean_names(names: list[str]) -> list[str]:
    """Clean every name; repeated results get ``_2``, ``_3`` ... in order, the
    first of them that no other column has.  Letters without a base letter in
    Unicode (``\u00e6``, ``\u00f8``, ``\u00df``, other scripts) stay as they are."""
    seen: dict[str, int] = {}
    out: list[str] = []
    for name in names:
        base = clean_name(name)
        seen[base] = seen.get(base, 0) + 1
        unique = base if seen[base] == 1 else f"{base}_{seen[base]}"
        while unique in out:
            seen[base] += 1
            unique = f"{base}_{seen[base]}"
        out.append(unique)
    return out
