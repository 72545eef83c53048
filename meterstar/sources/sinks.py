"""Writers: the enriched master, reporting tables and the quality report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Write a table as it is partitioned."""
    writer = df.write.mode("overwrite")
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(path)


def write_by_month(df: DataFrame, path: str, column: str = "Month") -> None:
    """Write partitioned by month.

    Rebalancing by month gives few files per month, and adaptive execution
    splits a month that is far larger than the others.
    """
    df.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(path)


def write_tables(tables: Mapping[str, DataFrame], folder: str, file_format: str = "parquet") -> None:
    """Write several small tables, one folder each."""
    for name, df in tables.items():
        write_table(df, f"{folder.rstrip('/')}/{name}", file_format)


def write_report(report: DataFrame, path: str) -> None:
    """Write the one-row quality report as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_text(df: DataFrame, path: str) -> None:
    """Write a one-row frame with one text column as a text file."""
    df.coalesce(1).write.mode("overwrite").text(path)
