"""Tables of vectors: which rows take part, and how they become matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, identifier: str, vector: str, most: float) -> tuple[DataFrame, int]:
    """vec_id and vector, as doubles, of the rows that take part, and the length of the vectors, 0 without any.

    Left out are null and empty vectors, those with null entries, with NaN or with
    entries of `most` or more, and those of another length than most rows have; of
    equally frequent lengths the longest counts.
    """
    rows = vectors.select(F.col(identifier).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0)).where(
        F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < most))
    )
    widths = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if widths is None:
        return rows.limit(0), 0
    return rows.where(F.size("vector") == widths["width"]), widths["width"]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A row of doubles per vector."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, width)
