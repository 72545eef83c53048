"""Small helpers the operators share: choosing input columns, folders, files, partitions."""

from __future__ import annotations

import uuid

from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.session import shared_folder


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the given names, so that other columns can never clash."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def carried(df: DataFrame, key: str, text: str) -> DataFrame:
    """``_row`` (all columns as one struct, so that no name can clash), ``_own_key`` and ``_own_mark``; ``select("_row.*")`` undoes it."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{key}`").cast("bigint").alias("_own_key"),
                     text_mark(text).alias("_own_mark"))


def text_mark(text: str) -> Column:
    """Tells the texts of rows apart that share a key."""
    return F.xxhash64(F.col(f"`{text}`"))


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder that the driver and all executors reach; ``drop_materialised`` removes it."""
    return f"{shared_folder(spark)}/meterstar/{spark.sparkContext.applicationId}/{kind}-{uuid.uuid4().hex}"


def file_system(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path or URI, and the path inside it."""
    if uri.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" in uri:
        return arrow_fs.FileSystem.from_uri(uri)
    return arrow_fs.LocalFileSystem(), uri


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
