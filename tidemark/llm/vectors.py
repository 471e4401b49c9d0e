"""What the two vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str | Column) -> Column:
    """Not null, not empty, all components there and finite, and not all zero."""
    v = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def common_length(vectors: DataFrame, column: str = "embedding") -> int:
    """The commonest vector length; vectors of another length can't be compared with it."""
    row = vectors.groupBy(F.size(column).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return row["d"] if row else 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of equally long vectors as double-precision rows."""
    flat = column.flatten() if len(column) else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
