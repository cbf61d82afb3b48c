"""Vectors as whole numbers: what the operators that need exact sums and distances share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scaled components lie within this, so that squared distances and inner products of up to 1,024 components are
#: exact in 64 bits. Others raise an error: their results would not fit a long.
LIMIT = 2**26


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as array<int>; NULL for a vector that is null or has a component that is
    null or not finite."""
    x = vector.cast("array<double>")
    fault = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))

    def component(c: Column) -> Column:
        y = F.floor(c * float(scale))
        error = F.raise_error(F.concat(F.lit("component out of range: "), c.cast("string")))
        return F.when(F.abs(c * float(scale)) <= LIMIT, y).otherwise(error.cast("long")).cast("int")

    return F.when(~fault, F.transform(x, component))


def common_length(rows: DataFrame, vector: str = "v") -> int | None:
    """The length that most vectors have, of equally frequent ones the least; None without rows."""
    sizes = rows.groupBy(F.size(vector).alias("size")).agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.desc("n"), "size").first()
    return None if first is None else first["size"]


def matrix(column: pa.Array | pa.ChunkedArray, length: int) -> np.ndarray:
    """A list column of one length as rows of 64-bit whole numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), length)
