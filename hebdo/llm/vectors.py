"""Vector columns: which rows hold a usable vector, and an Arrow list column as a matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F


def finite(vector: str):
    """Condition: the vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column without nulls, all of one length, as a float matrix (float64 unless float32)."""
    flat = column.flatten()
    if not pa.types.is_float32(flat.type):
        flat = pc.cast(flat, pa.float64(), safe=False)
    values = flat.to_numpy(zero_copy_only=False)
    return values.reshape(len(column), len(values) // len(column) if len(column) else 0)
