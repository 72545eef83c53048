"""Tables by month whose readers follow a manifest.

Each refresh writes the months it changes to folders of their own and then publishes a
manifest: which version of which month belongs to each table. Nothing that
an earlier manifest names is overwritten, so a run that breaks before it publishes changes nothing for readers,
and a reader that started before goes on with its months.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from meterstar.sources.star import path_exists

PART = "PartMonth"
NO_MONTH = "none"
_MANIFEST = "table string, month string, version string, columns string"


class Snapshot:
    """The tables of one folder as their latest manifest names them; ``number`` is 0 before the first refresh."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.number = self._latest()
        self._versions: dict[str, dict[str, str]] = {}
        self._schemas: dict[str, StructType] = {}
        if self.number:
            # One row per table and month.
            for row in spark.read.schema(_MANIFEST).json(self._manifest(self.number)).collect():
                months = self._versions.setdefault(row["table"], {})
                if row["month"] is None:
                    self._schemas[row["table"]] = StructType.fromJson(json.loads(row["columns"]))
                else:
                    months[row["month"]] = row["version"]

    def _manifest(self, number: int) -> str:
        return f"{self.folder}/manifests/{number:08d}"

    def _latest(self) -> int:
        """The highest number whose manifest is complete."""
        folder = f"{self.folder}/manifests"
        if not path_exists(self.spark, folder):
            return 0
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        listed = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
        numbers = sorted((int(s.getPath().getName()) for s in listed), reverse=True)
        return next((n for n in numbers if path_exists(self.spark, f"{self._manifest(n)}/_SUCCESS")), 0)

    def months(self, name: str) -> list[str]:
        return sorted(self._versions.get(name, {}))

    def tables(self) -> list[str]:
        return sorted(self._schemas)

    def read(self, name: str) -> DataFrame:
        """One table; the manifest's versions become partition filters, so no other folder is read."""
        if name not in self._schemas:
            raise KeyError(f"no table {name} in the snapshot of {self.folder}")
        schema = self._schemas[name]
        by_version: dict[str, list[str]] = {}
        for month, version in self._versions[name].items():
            by_version.setdefault(version, []).append(month)
        if not by_version:
            return self.spark.createDataFrame([], schema)
        live = [(F.col("version") == v) & F.col(PART).isin(months) for v, months in by_version.items()]
        stored = StructType(list(schema.fields)).add("version", StringType()).add(PART, StringType())
        return self.spark.read.schema(stored).parquet(f"{self.folder}/{name}").where(reduce(or_, live)).select(*schema.names)

    def stage(self, name: str, df: DataFrame, month: str = "Month") -> "Staged":
        """Write a table's changed months under a new version; no reader sees it until it is published."""
        version = f"v{uuid.uuid4().hex}"
        path = f"{self.folder}/{name}/version={version}"
        parted = df.withColumn(PART, F.coalesce(F.col(month), F.lit(NO_MONTH)))
        parted.hint("rebalance", PART).write.partitionBy(PART).parquet(path)
        return Staged(name, version, df.schema, path)

    def publish(self, staged: Iterable["Staged"], changed: Iterable[str]) -> "Snapshot":
        """Make the staged tables current for the months ``changed``; other months stay as they are.

        A changed month without staged rows is gone. A second refresh that started from the same manifest fails here.
        """
        changed, staged = set(changed), list(staged)
        left = set(self._schemas) - {one.name for one in staged}
        if left:
            raise ValueError(f"tables would keep old months: {sorted(left)}")
        versions = {name: dict(months) for name, months in self._versions.items()}
        schemas = dict(self._schemas)
        for one in staged:
            if one.name in schemas and schemas[one.name].names != one.schema.names:
                raise ValueError(f"columns of {one.name} changed; refresh all months into a new folder")
            schemas[one.name] = one.schema
            kept = {m: v for m, v in versions.get(one.name, {}).items() if m not in changed}
            versions[one.name] = {**kept, **{m: one.version for m in one.months(self.spark) if m in changed}}
        rows = [(name, None, None, schema.json()) for name, schema in schemas.items()]
        rows += [(name, m, v, None) for name, months in versions.items() for m, v in months.items()]
        manifest = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        manifest.write.mode("error").json(self._manifest(self.number + 1))
        return Snapshot(self.spark, self.folder)


class Staged:
    """A table's months written under a version that no manifest names yet."""

    def __init__(self, name: str, version: str, schema: StructType, path: str):
        self.name, self.version, self.schema, self.path = name, version, schema, path

    def read(self, spark: SparkSession) -> DataFrame:
        stored = StructType(list(self.schema.fields)).add(PART, StringType())
        return spark.read.schema(stored).parquet(self.path).select(*self.schema.names)

    def months(self, spark: SparkSession) -> list[str]:
        """The months written; reads folder names only."""
        stored = StructType(list(self.schema.fields)).add(PART, StringType())
        return [r[0] for r in spark.read.schema(stored).parquet(self.path).select(PART).distinct().collect()]
