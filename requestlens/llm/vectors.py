"""Vectors as Spark columns and as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """True where the vector is there and all its components are finite numbers; false otherwise, never null."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """The rows of a list column whose lists all have ``length`` entries and no nulls."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
