"""Vector columns: which rows hold usable vectors, and their numbers as arrays inside Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """The vector is there, and so are all of its components, as finite numbers."""
    number = lambda v: F.coalesce(~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))), F.lit(False))
    return F.coalesce(F.forall(vector, number), F.lit(False))


def not_zero(vector: str) -> Column:
    return F.coalesce(F.exists(vector, lambda v: v != 0), F.lit(False))


def padded(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """All vectors as long as the longest, shorter ones with zeros behind; and that length."""
    low, high = df.agg(F.min(F.size(vector)), F.max(F.size(vector))).first()
    if low == high:
        return df, high or 0
    kind = df.schema[vector].dataType.elementType.simpleString()
    return df.withColumn(vector, F.concat(vector, F.array_repeat(F.lit(0).cast(kind), F.lit(high) - F.size(vector)))), high


def matrix(column: pa.Array, width: int, kind: type = np.float64) -> np.ndarray:
    """A column of lists of one length as rows of numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), width)
