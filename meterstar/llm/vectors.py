"""Vectors of whole numbers, as the vector operators compare them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.llm.inputs import picked

LIMIT = 1 << 27  # sums of a few thousand squares or products of such numbers stay exact in 64 bits


def whole_vectors(df: DataFrame, scale: int, components: int | None = None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, vector``: each component x as the integer floor(scale * x), x taken as a double.

    Rows whose vector is NULL or empty, holds a NULL, NaN or infinite component or one that is ``LIMIT`` or more after scaling, or
    has another number of components than asked for are left out.
    """
    rows = picked(df, vec_id=key, vector=vector).select(
        "vec_id", F.transform("vector", lambda x: x.cast("double") * F.lit(float(scale))).alias("vector"))
    usable = F.forall("vector", lambda x: F.coalesce(F.abs(x) < F.lit(float(LIMIT)), F.lit(False)))  # NaN is above all numbers
    usable &= F.size("vector") > 0
    if components is not None:
        usable &= F.size("vector") == components
    return rows.where(F.col("vector").isNotNull() & usable).select(
        "vec_id", F.transform("vector", lambda x: F.floor(x).cast("int")).alias("vector"))


def matrix(column: pa.Array, components: int) -> np.ndarray:
    """A column of vectors with ``components`` numbers each as rows of 64-bit integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), components)
