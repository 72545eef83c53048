"""Least squares for many groups: product sums in one aggregate, small systems solved row by row."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.session import ship_package

_NUMBERS = T.ArrayType(T.DoubleType())


def normal_equations(df: DataFrame, ids: Sequence[str], xs: Sequence[Column], y: Column,
                     extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Sums of products of (xs, y) per group as ``sums`` (upper triangle by rows), ``n``, and any extra aggregates.

    The products are one vector per row, summed as such: one aggregate, however
    many regressors there are.
    """
    size = len(xs) + 1
    staged = df.withColumn("_v", F.array(*[x.cast("double") for x in xs], y.cast("double")))
    products = F.flatten(F.transform(
        F.sequence(F.lit(1), F.lit(size)),
        lambda i: F.transform(F.slice("_v", i, F.lit(size + 1) - i), lambda v: v * F.element_at("_v", i)),
    ))
    return staged.withColumn("_p", array_to_vector(products)).groupBy(*ids).agg(
        Summarizer.sum(F.col("_p")).alias("_sums"),
        F.count(F.lit(1)).alias("n"),
        *[c.alias(name) for name, c in (extra or {}).items()],
    ).withColumn("sums", vector_to_array("_sums")).drop("_sums")


def system(upper: Sequence[float]) -> tuple[np.ndarray, np.ndarray, float]:
    """Product matrix of the regressors, their products with y, and y's square."""
    size = int((math.sqrt(8 * len(upper) + 1) - 1) / 2)
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = upper
    full += np.triu(full, 1).T
    return full[:-1, :-1], full[:-1, -1], float(full[-1, -1])


def solve(gram: np.ndarray, xy: np.ndarray, yy: float) -> tuple[np.ndarray, float]:
    """Coefficients and residual sum of squares; a redundant column gets weight 0 or shares it."""
    scale = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    beta = np.linalg.lstsq(gram / np.outer(scale, scale), xy / scale, rcond=1e-11)[0] / scale
    return beta, max(float(yy - beta @ xy), 0.0)


@F.pandas_udf(T.StructType().add("beta", _NUMBERS).add("sse", T.DoubleType()))
def _solve_systems(sums: pd.Series) -> pd.DataFrame:
    rows = []
    for upper in sums:
        beta, sse = solve(*system(upper))
        rows.append((beta.tolist(), sse))
    return pd.DataFrame(rows, columns=["beta", "sse"])


def grouped_ols(df: DataFrame, ids: Sequence[str], xs: Sequence[Column], y: Column) -> DataFrame:
    """Least squares per group: ``beta``, ``sse`` and ``n``."""
    ship_package(df.sparkSession)
    return normal_equations(df, ids, xs, y).withColumn("_fit", _solve_systems("sums")).select(*ids, "n", "_fit.beta", "_fit.sse")
