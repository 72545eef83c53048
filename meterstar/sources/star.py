"""Readers for the star schema and for the enriched master."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.sources.contracts import DIMENSION_KEYS, FACT, FILES, contract


MASTER_DATES = ("Date", "OnboardingDate")


class MissingFilesError(FileNotFoundError):
    """One or more of the seven table files are absent."""


class MissingColumnsError(ValueError):
    """A table lacks columns that the next step needs."""


class StarTables(Mapping[str, DataFrame]):
    """The fact table and its six dimensions, by short name."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        absent = sorted(set(FILES) - set(tables))
        if absent:
            raise KeyError(f"star schema lacks tables: {absent}")
        self._tables = dict(tables)

    def __getitem__(self, name: str) -> DataFrame:
        return self._tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    @property
    def fact(self) -> DataFrame:
        return self._tables[FACT]

    @property
    def dimensions(self) -> dict[str, DataFrame]:
        return {name: self._tables[name] for name in DIMENSION_KEYS}

    def replace(self, **tables: DataFrame) -> "StarTables":
        """A copy with some tables exchanged."""
        return StarTables({**self._tables, **tables})

    def register_views(self) -> None:
        """Expose every table to SQL under its file name."""
        for name, df in self._tables.items():
            df.createOrReplaceTempView(FILES[name])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "table") -> DataFrame:
    """Return ``df`` unchanged, or name every column it lacks."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise MissingColumnsError(f"{what} is missing required columns: {missing}")
    return df


def load_star(spark: SparkSession, folder: str, file_format: str = "csv") -> StarTables:
    """Read all seven tables; name every missing file in one error.

    CSV columns stay strings, so that a bad value is counted by the quality
    checks instead of failing the job. ``typed`` casts them afterwards.
    """
    paths = {name: f"{folder.rstrip('/')}/{stem}.{file_format}" for name, stem in FILES.items()}
    missing = [path.rsplit("/", 1)[1] for path in paths.values() if not path_exists(spark, path)]
    if missing:
        raise MissingFilesError(f"Missing required {file_format} files in {folder}: {missing}")
    reader = spark.read
    if file_format == "csv":
        reader = reader.option("header", True)
    return StarTables({name: reader.format(file_format).load(path) for name, path in paths.items()})


def _as_type(name: str, source: T.DataType, target: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(source, T.StringType) and not isinstance(target, T.StringType):
        if isinstance(target, T.IntegralType):
            # A whole number may be written as 4.0 when its column has blanks.
            column = F.coalesce(column.try_cast(target), column.try_cast("double").try_cast(target))
        else:
            column = column.try_cast(target)
    elif isinstance(target, T.DoubleType) and isinstance(source, T.DecimalType):
        return column
    elif source != target:
        column = column.cast(target)
    if isinstance(target, T.DoubleType):
        column = F.when(~F.isnan(column), column)
    return column.alias(name)


def typed_table(df: DataFrame, table: str) -> DataFrame:
    """Cast contract columns to their types; NaN becomes NULL, extra columns stay."""
    targets = {f.name: f.dataType for f in contract(table).schema}
    return df.select(
        *[
            _as_type(f.name, f.dataType, targets[f.name]) if f.name in targets else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def typed(tables: StarTables) -> StarTables:
    """Cast every table of the star."""
    return StarTables({name: typed_table(df, name) for name, df in tables.items()})


def load_master(spark: SparkSession, path: str, columns: Iterable[str], file_format: str = "parquet") -> DataFrame:
    """Read the enriched master and check the columns the caller needs."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"enriched master was not found: {path}")
    df = spark.read.format(file_format).option("header", True).load(path)
    texts = [f.name for f in df.schema if f.name in MASTER_DATES and isinstance(f.dataType, T.StringType)]
    df = df.withColumns({c: F.col(c).try_cast("date") for c in texts})
    return require_columns(df, columns, "enriched master")


def reject_null_dates(df: DataFrame, column: str = "Date") -> DataFrame:
    """Fail if any date is missing; stops at the first one found."""
    if not df.where(F.col(column).isNull()).isEmpty():
        raise ValueError(f"the {column} column contains missing values")
    return df
