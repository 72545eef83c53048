"""Registry of the queries and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.functions import columns as C
from meterstar.session import task_parts
from meterstar.sources import samples

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def round_half_up(c: Column, digits: int) -> Column:
    """Round a double by arithmetic, which stays in generated code."""
    scale = F.lit(10.0**digits)
    return F.signum(c) * F.floor(F.abs(c) * scale + 0.5).cast("double") / scale


def rounded(df: DataFrame, digits: int = 6, **by_column: int) -> DataFrame:
    """Round doubles, so that results do not depend on the order of summation."""
    return df.select(*[
        round_half_up(F.col(f"`{f.name}`"), by_column.get(f.name, digits)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def register(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        if name in QUERIES:
            raise KeyError(f"query {name} is registered twice")
        QUERIES[name] = query
        return query
    return add


def shipped(spark: SparkSession, sf_dir: str, *dimensions: str) -> DataFrame:
    """Line items as usage rows, joined to the named dimensions."""
    return samples.usage(spark, sf_dir, "shipments", *dimensions)


def requested(spark: SparkSession, sf_dir: str, *dimensions: str) -> DataFrame:
    """Events as usage rows, joined to the named dimensions."""
    return samples.usage(spark, sf_dir, "requests", *dimensions)


def item_parts(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for as many rows as there are line items."""
    return task_parts(spark, samples.fact_table(spark, sf_dir, "lineitem").count())


def with_efficiency(usage: DataFrame) -> DataFrame:
    """Add the token efficiency that the aggregates average."""
    efficiency = F.when(F.col("TokensInput") != 0, C.ratio("TokensOutput", "TokensInput")).otherwise(0.0)
    return usage.withColumn("TokenEfficiencyRatio", efficiency)
