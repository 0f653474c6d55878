"""Registered queries over the driver's tables, each with its DuckDB oracle.

Every query reads whole tables (no key subsets, no row caps) and is built
only from the library's operators.  ``ORACLE_SQL[name]`` states the same
result in plain SQL for DuckDB, where the tables are views; column names and
types are aligned (``CAST(... AS BIGINT)`` etc.) so results hash equal.

Modules register their queries on import; the import order below is the
order of ``queries()``.
"""

from __future__ import annotations

from hebdo.plans.catalog import rollups  # noqa: F401  (first: weekly rollups)
from hebdo.plans.catalog import dates  # noqa: F401
from hebdo.plans.catalog import text  # noqa: F401
from hebdo.plans.catalog import slices  # noqa: F401
from hebdo.plans.catalog import merges  # noqa: F401
from hebdo.plans.catalog import documents  # noqa: F401
from hebdo.plans.catalog import spec_feeds  # noqa: F401
from hebdo.plans.catalog import releases  # noqa: F401
from hebdo.plans.catalog import national  # noqa: F401
from hebdo.plans.catalog import inference  # noqa: F401
from hebdo.plans.catalog import revisions  # noqa: F401
from hebdo.plans.catalog import publishing  # noqa: F401
from hebdo.plans.catalog import arrivals  # noqa: F401
from hebdo.plans.catalog.registry import ORACLE_SQL, QUERIES, register


__all__ = ["ORACLE_SQL", "QUERIES", "register"]
